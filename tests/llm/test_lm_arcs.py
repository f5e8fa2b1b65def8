"""The backoff automaton: its states and arcs, and that rare n-grams are arcs however large the corpus."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyfold.llm import lm, tokens

PRIORS = (3.0, 2.0)


def plain(taught):
    """An automaton of dictionaries: contexts of up to two words, what follows each, and probabilities by recursion."""
    texts = [[*t.split(), None] for t in taught]
    n = Counter(tuple(t[k - size + 1 : k + 1]) for t in texts for size in (1, 2, 3) for k in range(size - 1, len(t)))
    total, types = sum(v for g, v in n.items() if len(g) == 1), sum(len(g) == 1 for g in n)

    def probability(context, word):
        if not context:
            return (n[(word,)] + lm.RAISED) / (total + lm.RAISED * (types + 1))
        prior = PRIORS[len(context) - 1]
        return (n[(*context, word)] + prior * probability(context[1:], word)) / (n[context] + prior)

    def walk(text):
        context, score, seen = (), 0.0, []
        for word in [*text.split(), None]:
            # by way of failure arcs, until an arc fits
            while context and not n[(*context, word)]:
                score += math.log10(PRIORS[len(context) - 1] / (n[context] + PRIORS[len(context) - 1]))
                context = context[1:]
            score += math.log10(probability(context, word))
            context = (*context, word)[-2:]
            while context and not n[context]:
                context = context[1:]
            seen.append(context)
        return score, seen

    return walk, n, total, types


@pytest.mark.parametrize("segment", [1, 2, 3, 512])
def test_states_and_scores_are_those_of_plain_dictionaries(segment):
    r = random.Random(4)
    texts = [" ".join(r.choice("abcde") for _ in range(r.randrange(0, 14))) for _ in range(40)] + ["", "z", "z a z", "a b c z d", "q q q a b"]
    learned = [k < 25 for k in range(len(texts))]
    walk, n, total, types = plain([t for t, l in zip(texts, learned, strict=True) if l])

    import pyarrow as pa

    w = tokens.words(*tokens.buffers(pa.array(texts)))
    hashes, first = lm.with_end(w)
    words, ids = np.unique(hashes, return_inverse=True)
    part = lm.Part(words, ids, first, np.repeat(learned, np.diff(first)))
    pair_key, triple_key = part.keys()
    _, n2, pair = part.grams(pair_key, np.flatnonzero(part.two))
    _, n3, triple = part.grams(triple_key, np.flatnonzero(part.three))
    a = lm.Automaton.of(part, part.counts().astype(float), (n2.astype(float), pair), (n3.astype(float), triple), total, types, PRIORS)
    scores, states = a.walk(part.ids, part.first, segment)

    name, contexts = {}, {}
    for d, t in enumerate(texts):
        score, seen = walk(t)
        own = slice(int(first[d]), int(first[d + 1]))
        assert scores[own].sum() == pytest.approx(score, abs=1e-9)
        for state, context in zip(states[own].tolist(), seen, strict=True):
            assert name.setdefault(state, context) == context and contexts.setdefault(context, state) == state
    assert contexts[()] == 0
    # as many states as contexts were taught, and an arc for each n-gram that was; the empty context knows all words
    assert len(a.fail) == 1 + sum(len(g) <= 2 for g in n) and len(a.arcs) == len(words) + sum(len(g) > 1 for g in n)
    for state, context in name.items():
        if context:
            assert a.fail[state] == contexts.get(context[1:], a.fail[state])


def test_what_leaves_a_state_adds_up_to_one():
    import pyarrow as pa

    texts = ["a b a c", "b a", "c c c a b", "a"]
    hashes, first = lm.with_end(tokens.words(*tokens.buffers(pa.array(texts))))
    words, ids = np.unique(hashes, return_inverse=True)
    part = lm.Part(words, ids, first, np.ones(len(ids), bool))
    pair_key, triple_key = part.keys()
    grams = [part.grams(k, np.flatnonzero(has)) for k, has in ((pair_key, part.two), (triple_key, part.three))]
    a = lm.Automaton.of(part, part.counts().astype(float), *[(n.astype(float), which) for _, n, which in grams], len(ids), len(words), PRIORS)
    unknown = lm.RAISED / (len(ids) + lm.RAISED * (len(words) + 1))
    for state in range(len(a.fail)):
        every = 10 ** a.step(np.full(len(words), state), np.arange(len(words)))[0]
        way, at = 1.0, state
        while at:
            way, at = way * 10 ** a.fail_weight[at], int(a.fail[at])
        ends = state and not any(a.arcs // a.words == state)
        assert ends or every.sum() + way * unknown == pytest.approx(1.0)


def test_rare_ngrams_stay_arcs_in_a_large_corpus(spark):
    rows = [(0, "left right"), (1, "left right"), (2, " ".join(["filler"] * 600_000)), (5, "left right"), (6, "right left")]
    got = lm.score(spark.createDataFrame(rows, "doc_id long, text string"), F.col("doc_id") < 5).collect()
    score = {r["doc_id"]: r["score"] for r in got}
    assert score[5] > score[6] + 2
