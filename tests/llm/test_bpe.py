import base64
import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyfold.llm import bpe

P = pytest.importorskip("public_tokenizers")
FILE = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(FILE, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(open(FILE, "rb").read(), P.PATTERN)


ODD = ["", "a", "a  b", "a \n b", " lead", "trail ", "\n\n x", "don't we'll", "<|endoftext|>", "é ü", "🏀" * 40, "ab" * 3000, "a" * 2001, "=" * 999, "\x1c \x1c", "日本語 テキスト"]


@pytest.mark.parametrize("by_space", [False, True])
def test_odd_texts(codec, reference, by_space):
    for text, ids in zip(ODD, codec.encode_texts(ODD, by_space), strict=True):
        assert ids.tolist() == reference.encode_ordinary(text) and codec.decode(ids.tolist()) == text.encode()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("abeinst  \n\t'é1.!ß x"), max_size=200), max_size=5))
def test_any_texts(codec, reference, texts):
    for text, ids in zip(texts, codec.encode_texts(texts, True), strict=True):
        assert ids.tolist() == reference.encode_ordinary(text)


def test_small_merge_batches(codec, reference, monkeypatch):
    monkeypatch.setattr(bpe, "MERGE_BYTES", 7)
    text = "the internationalisation of unbelievable things"
    assert next(codec.encode_texts([text])).tolist() == reference.encode_ordinary(text)


@pytest.mark.parametrize("text", ["the" * 20_000, "thethea" * 3000 + " x " * 30, "ab" * 5000 + " hello " + "q" * 9000 + " " + "the" * 2000])
def test_long_pre_tokens(codec, reference, text):
    assert next(codec.encode_texts([text, text])).tolist() == reference.encode_ordinary(text)


def test_a_pre_token_of_a_megabyte_takes_time_in_proportion(codec):
    import time

    began = time.time()
    ids = next(codec.encode_texts(["the" * 349_525]))
    assert codec.decode(ids.tolist()) == b"the" * 349_525 and time.time() - began < 20


def test_rank_queue_finds_the_least():
    import numpy as np

    q = bpe.RankQueue(50_000)
    for r in (4096, 49_999, 0, 64, 63, 4096):
        q.push(r, np.array([r]))
    assert [q.pop()[0] for _ in range(5)] == [0, 63, 64, 4096, 49_999] and q.pop() is None


def test_frames(spark, table, reference):
    rows = [(1, "the cat sat"), (1, "the cat sat"), (2, ""), (3, None), (None, "x y"), (4, "word " * 20_000)]
    docs = table(rows)
    got = bpe.encode(docs, FILE, P.PATTERN, break_at_space=True, digests=True)
    assert got.count() == 6
    for r in got.collect():
        text = next(t for i, t in rows if i == r["doc_id"]) or ""
        ids = reference.encode_ordinary(text)
        assert list(r["ids"]) == ids and r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert {bytes(r["decoded"]).decode() for r in bpe.decode(got, FILE).collect()} == {t or "" for _, t in rows}
    assert bpe.encode(table([]), FILE, P.PATTERN).count() == 0
