"""Passages that don't keep to lines."""

import random

import numpy as np
import pyarrow as pa

from tallyfold.llm import passages, tokens

from test_minhash import brute


def unique(seed: int, n: int) -> list[str]:
    r = random.Random(seed)
    return [f"u{seed}n{r.randrange(10**9)}" for _ in range(n)]


def folded(words, width):
    return "\n".join(" ".join(words[k : k + width]) for k in range(0, len(words), width))


def test_passages_inside_lines_and_over_several(spark, table):
    inside, short = unique(1, 60), unique(2, 60)
    before, after = unique(10, 200), unique(11, 200)
    head, tail = folded(unique(12, 31), 6), folded(unique(13, 31), 8)
    rows = [
        (1, " ".join(unique(3, 150) + inside + unique(4, 150))),
        (2, " ".join(before + inside + after)),  # inside a longer line
        (3, folded(unique(5, 20) + inside + unique(6, 20), 13)),  # line breaks elsewhere
        (4, folded(short, 9)),
        (5, head + "\n" + folded(short, 7) + "\n" + tail),  # in lines that are all short
        (6, " ".join(unique(7, 80) + inside[:30] + unique(8, 80))),  # too short a run
        (3, " ".join(unique(9, 40) + inside)),  # another row of the same id
        (None, " ".join(inside)),
    ]
    got = {(r["doc_id"], r["text"]): r for r in passages.cut(table(rows)).collect()}
    assert len(got) == len(rows)
    for k in (0, 3, 5, 7):
        assert got[rows[k]]["cut_spans"] == [] and got[rows[k]]["kept_in"] == []
    two = got[2, " ".join(before + after)]
    assert two["cut_spans"] == [[200, 260]] and two["kept_in"] == [1]
    three = {r["text"]: r for (i, t), r in got.items() if i == 3}
    assert {tuple(t.split()) for t in three} == {tuple(unique(5, 20) + unique(6, 20)), tuple(unique(9, 40))}
    assert all(r["kept_in"] == [1] for r in three.values())
    five = next(r for (i, _), r in got.items() if i == 5)
    # a paragraph that is nearly the same goes whole, with the few words around the passage that are in it
    (a, z), = five["cut_spans"]
    assert five["kept_in"] == [4] and 25 <= a <= 31 and 91 <= z <= 97


def test_every_run_of_47_words_is_found(spark, table):
    """Runs of 47 to 90 words at any place, to their ends, against a window that goes word by word."""
    r = random.Random(4)
    rows = []
    for k in range(40):
        run = unique(100 + k, 47 + k)
        for side in (0, 1):
            rows.append((2 * k + side, " ".join(unique(1000 + 2 * k + side, r.randrange(0, 60)) + run + unique(3000 + 2 * k + side, r.randrange(0, 60)))))
    got = {x["doc_id"]: x for x in passages.cut(table(rows)).collect()}
    for k in range(40):
        whole = dict(rows)[2 * k + 1].split()
        run = set(unique(100 + k, 47 + k))
        assert got[2 * k]["text"] == dict(rows)[2 * k]
        left = got[2 * k + 1]["text"].split()
        # some words around it may be in a paragraph that is nearly the same
        assert not run & set(left) and len(whole) - len(left) <= len(run) / 0.75


def bounded(text: str) -> list[tuple[int, int]]:
    """The paragraphs of a text, word by word."""
    buf, off = tokens.buffers(pa.array([text]))
    h = [int(x) for x in tokens.words(buf, off).hash]
    mixed = [int(tokens.mix64(np.array([(a * int(tokens._BASE) + b) % 2**64], np.uint64))[0]) for a, b in zip(h, h[1:], strict=False)]
    at = passages.AROUND
    cuts = [0] + [k for k in range(1, len(mixed)) if all(mixed[k] < x for x in mixed[max(0, k - at) : k]) and all(mixed[k] <= x for x in mixed[k + 1 : k + at + 1])]
    return list(zip(cuts, [*cuts[1:], len(h)], strict=True))


def test_near_paragraphs_and_runs_equal_brute_force(spark, table):
    """Passages with some words changed, inside lines of other words: all pairs of paragraphs, and all common runs."""
    r = random.Random(6)
    shared = [unique(k, 260) for k in range(3)]
    rows = []
    for i in range(24):
        own = list(shared[i % 3])
        for _ in range(r.randrange(4)):
            own[r.randrange(260)] = f"changed{i}x{r.randrange(10**6)}"
        words = unique(500 + i, r.randrange(10, 80)) + own + unique(700 + i, r.randrange(10, 80))
        rows.append((i, folded(words, r.randrange(5, 400)) if i % 4 else " ".join(words)))
    rows += [(50, ""), (51, None), (52, "\n\n"), (None, rows[0][1]), (53, " ".join(unique(9, 400)))]
    docs = {i: t for i, t in rows if i is not None and t and t.strip()}
    sets = [((i, a, z), frozenset(zip(*(t.split()[a + k : z] for k in range(5)), strict=False))) for i, t in docs.items() for a, z in bounded(t) if z - a >= passages.LEAST_WORDS]
    group = brute(sets)
    first = {}
    for place, g in group.items():
        first[g] = min(first.get(g, place[0]), place[0])
    gone = {i: [False] * len(t.split()) for i, t in docs.items()}
    may = {i: [False] * len(t.split()) for i, t in docs.items()}
    for (i, a, z), g in group.items():
        if i > first[g]:
            gone[i][a:z] = may[i][a:z] = [True] * (z - a)
    for i, t in docs.items():
        w = t.split()
        for j, u in docs.items():
            if j < i:
                v = u.split()
                at = {x: k for k, x in enumerate(v)}
                k = 0
                while k < len(w):
                    n = 0
                    while w[k] in at and k + n < len(w) and at[w[k]] + n < len(v) and w[k + n] == v[at[w[k]] + n]:
                        n += 1
                    if n >= passages.WINDOW + passages.WITHIN - 1:
                        # up to 15 words at an end may stay where a document before both has other words there
                        edge = passages.WITHIN - 1
                        gone[i][k + edge : k + n - edge] = [True] * (n - 2 * edge)
                        may[i][k : k + n] = [True] * n
                    k += max(1, n)
    got = passages.cut(table(rows), part_bytes=3000).collect()
    assert len(got) == len(rows)
    nearly = 0
    for x in got:
        i = x["doc_id"]
        if i not in docs:
            assert x["cut_spans"] == [] and x["text"] in ("", None, "\n\n", rows[0][1])
            continue
        w = docs[i].split()
        cut = [any(a <= k < z for a, z in x["cut_spans"]) for k in range(len(w))]
        assert all(c for c, g in zip(cut, gone[i], strict=True) if g)
        # runs of 32 to 46 words that hold a mark may go besides, but no word that is in no other text
        assert not any(c and y.startswith(("u5", "u7")) and not g for c, y, g in zip(cut, w, may[i], strict=True))
        assert x["text"].split() == [y for y, c in zip(w, cut, strict=True) if not c]
        nearly += sum(y.startswith("changed") and c for y, c in zip(w, cut, strict=True))
    assert nearly > 5
    assert sum(len(x["cut_spans"]) == 0 for x in got if x["doc_id"] in docs) >= 4
