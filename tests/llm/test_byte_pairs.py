"""Byte-level BPE against the tiktoken library."""

import base64
import hashlib
import random

import numpy as np
import pytest

from tests.harness import TESTDATA
from tramline.llm import byte_pairs, queries

tiktoken = pytest.importorskip("tiktoken")
tokenizers = pytest.importorskip("public_tokenizers")
RANKS, PATTERN = tokenizers.path("byte_bpe_multi_50k.tiktoken"), tokenizers.PATTERN

ODD = ["a", "b", "aa", "\n", " ", "  ", "é", "日", "\U0001F600", "'s", "the", "123", "\u0085", "\x1c", "᠎", " ", "x" * 50, "...", "_", "ß", "́", "ab" * 40, " " * 30, "\0", "<|endoftext|>"]


@pytest.fixture(scope="module")
def both():
    own = byte_pairs.Encoder(byte_pairs.merges(RANKS), PATTERN)
    return own, tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=own.merges.ranks, special_tokens={})


def blocks(own, texts):
    ids, ends = own.block(texts)
    return [part.tolist() for part in np.split(ids, ends[:-1])] if texts else []


def odd_texts(seed, n):
    r = random.Random(seed)
    return ["", "a" * 5000, " " * 5000, "ab" * 3000, "\n" * 99] + ["".join(r.choice(ODD) for _ in range(r.randint(0, 60))) for _ in range(n)]


def test_equals_library(both):
    own, library = both
    texts = odd_texts(1, 2000)
    assert blocks(own, texts) == [library.encode_ordinary(t) for t in texts]


def test_every_code_point(both):
    own, library = both
    points = [*range(0xD800), *range(0xE000, 0x33500), *range(0x3CFF0, 0x3FC50), 0x40000, 0xE0001, 0xF0000, 0x10FFFF]
    texts = [f"a{chr(c)}a {chr(c)}1{chr(c)}1" for c in points]
    found, ends = own.block(texts)
    expected = library.encode_ordinary_batch(texts, num_threads=8)
    assert found.tolist() == [i for ids in expected for i in ids]
    assert np.diff(ends, prepend=0).tolist() == [len(ids) for ids in expected]


def test_forgetting_and_piecewise_splitting_change_nothing(both, monkeypatch):
    own, library = both
    monkeypatch.setattr(byte_pairs, "REMEMBERED", 50)
    monkeypatch.setattr(byte_pairs, "_LONG", 10)
    for k in range(5):
        texts = odd_texts(k, 20)
        assert blocks(own, texts) == [library.encode_ordinary(t) for t in texts]


def test_ranks_out_of_order():
    """Rank files whose merges make pairs that were due before: equal to one merge at a time."""
    r = random.Random(3)
    for _ in range(60):
        tokens = {bytes([b]) for b in range(256)}
        while len(tokens) < 256 + 25:
            tokens.add(bytes(r.choice(b"abc") for _ in range(r.randint(2, 5))))
        listed = sorted(t for t in tokens if len(t) == 1) + r.sample(sorted(t for t in tokens if len(t) > 1), 25)
        m = byte_pairs.Merges({t: k for k, t in enumerate(listed)})
        words = [bytes(r.choice(b"abc") for _ in range(r.randint(1, 30))) for _ in range(200)]
        ids, counts = m.replay(words)
        assert [p.tolist() for p in np.split(ids, np.cumsum(counts)[:-1])] == [slow(m.ranks, w) for w in words] == [m.plain(w) for w in words]


def slow(ranks, word):
    """Always the leftmost pair of lowest rank."""
    parts = [word[i : i + 1] for i in range(len(word))]
    while True:
        found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not found:
            return [ranks[p] for p in parts]
        _, i = min(found)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def test_frames(spark, both):
    texts = [None, "", "a" * 200_000, *odd_texts(5, 40), "x", "x"]
    rows = [(k if k % 3 else None, t, "clash") for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = byte_pairs.decode(byte_pairs.encode(docs, RANKS, PATTERN), RANKS).collect()
    assert out[0].asDict().keys() == {"doc_id", "text", "ids", "decoded"}
    by_text = {r["text"]: r for r in out}
    assert by_text[None]["ids"] is None and by_text[None]["decoded"] is None
    for r in out[1:]:
        assert r["ids"] == both[1].encode_ordinary(r["text"]) and r["decoded"] == r["text"].encode()
    assert len(out) == len(texts)
    empty = docs.limit(0)
    assert byte_pairs.digests(empty, RANKS, PATTERN).collect() == []
    assert byte_pairs.decode(byte_pairs.encode(empty, RANKS, PATTERN), RANKS).collect() == []


def test_ids_outside_the_file(spark):
    frame = spark.createDataFrame([([70_000],)], "ids array<int>")
    with pytest.raises(Exception, match="not in the rank file"):
        byte_pairs.decode(frame, RANKS).collect()


def test_missing_bytes():
    with pytest.raises(ValueError, match="lacks"):
        byte_pairs.Merges({b"a": 0})


def test_query(spark, both):
    import pyarrow.parquet as pq

    folder = f"{TESTDATA}/sf0.01"
    got = {r["doc_id"]: r for r in queries.op11_byte_bpe(spark, folder).collect()}
    docs = pq.read_table(f"{folder}/documents.parquet").to_pylist()
    assert len(got) == len(docs)
    for d in docs:
        text = d["text"] or ""
        ids = both[1].encode_ordinary(text)
        r = got[d["doc_id"]]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_rank_file():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    assert byte_pairs.merges(RANKS).ranks == ranks
