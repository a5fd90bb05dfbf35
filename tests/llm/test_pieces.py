"""SentencePiece transducers against the library."""

import os
import random

import pytest

from tests.harness import TESTDATA
from tramline.llm import pieces, queries

MODEL = f"{queries.TOKENIZERS}/piece_bpe_32k.model"
pytestmark = pytest.mark.skipif(not os.path.exists(MODEL), reason="vocabulary file not available")
spm = pytest.importorskip("sentencepiece")


@pytest.fixture(scope="module")
def both():
    return pieces.Transducer(MODEL), spm.SentencePieceProcessor(model_file=MODEL)


def odd_texts(seed, n):
    r = random.Random(seed)
    parts = ["aaaa", "the", "ing", "\n\n", "  ", " ", "€", "日本", "x", "\t", "<s>", "<0x0A>", "▁", "ſ", "\U0001F600", "--", "0000", "     ", "Hello", "'s", "abab", "\0"]
    out = ["", " ", "a", " a", "▁▁a", "a▁b", " " * 40, "word" * 3000, "\0"]
    return out + ["".join(r.choice(parts) for _ in range(r.randint(1, 14))) for _ in range(n)] + ["".join(r.choice("aeinst ") for _ in range(r.randint(1, 40))) for _ in range(n)]


def test_equals_library(both):
    own, library = both
    for text in odd_texts(1, 1500):
        ids = own.encode(text)
        assert ids == library.encode(text), text
        assert own.decode(ids) == library.decode(ids)


def test_decode_any_ids(both):
    own, library = both
    r = random.Random(2)
    for _ in range(500):
        ids = [r.choice([r.randrange(3, 259), r.randrange(259, 32000)]) for _ in range(r.randint(0, 9))]
        assert own.decode(ids) == library.decode(ids)


def test_forgetting_changes_nothing(both, monkeypatch):
    own, library = both
    monkeypatch.setattr(pieces, "_REMEMBERED", 3)
    for text in odd_texts(3, 100):
        assert own.encode(text) == library.encode(text)


def model_file(tmp_path, kind, byte_fallback=False, strip=True):
    """A small hand-made model; nothing is trained."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = pb.ModelProto()
    m.ParseFromString(spm.SentencePieceNormalizer(rule_name="nmt_nfkc").serialized_model_proto())
    del m.pieces[:]
    words = ["▁", "a", "b", "c", "ab", "bc", "abc", "▁a", "▁ab", "ca", "▁b", "f", "i", "fi"]
    for piece, score, type_ in [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3), *[(w, -1.0 - 0.37 * k, 1) for k, w in enumerate(words)], ("<user>", 0.0, 4)]:
        m.pieces.add(piece=piece, score=score, type=type_)
    if byte_fallback:
        for b in range(256):
            m.pieces.add(piece=f"<0x{b:02X}>", score=0.0, type=6)
    m.trainer_spec.model_type, m.trainer_spec.byte_fallback = kind, byte_fallback
    m.trainer_spec.vocab_size = len(m.pieces)
    m.normalizer_spec.add_dummy_prefix, m.normalizer_spec.remove_extra_whitespaces, m.normalizer_spec.escape_whitespaces = True, strip, True
    path = tmp_path / f"{kind}{byte_fallback}{strip}.model"
    path.write_bytes(m.SerializeToString())
    return str(path)


@pytest.mark.parametrize("byte_fallback", [False, True])
@pytest.mark.parametrize("strip", [False, True])
def test_unigram_and_normaliser(tmp_path, byte_fallback, strip):
    path = model_file(tmp_path, 1, byte_fallback, strip)
    own, library = pieces.Transducer(path), spm.SentencePieceProcessor(model_file=path)
    r = random.Random(5)
    parts = ["a", "b", "c", "ab", "  ", " ", "ﬁ", "Ａ", "ａ", "é", "\t", "x", "zz", "<user>", "½", "　", "\U0001F600"]
    for text in ["", " ", "  a  b "] + ["".join(r.choice(parts) for _ in range(r.randint(1, 12))) for _ in range(600)]:
        score = lambda ids: sum(own.model.pieces[i][1] for i in ids)
        a, b = own.encode(text), library.encode(text)
        assert a == b or (len(b"".join(bytes([0]) for _ in a)) and score(a) == pytest.approx(score(b))), text


def test_columns(spark):
    rows = [(1, "Hello world", 5), (1, "Hello world", 5), (2, None, 5), (3, "", 5), (4, "long " * 40_000, 5)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, ids bigint")
    got = pieces.decode(pieces.encode(table, MODEL), MODEL).collect()
    assert [r.decoded for r in got] == [r[1] for r in rows] and [r.ids for r in got][2:4] == [None, []]
    assert pieces.encode(table.filter("false"), MODEL).collect() == []


def test_query_round_trips(spark):
    library = spm.SentencePieceProcessor(model_file=MODEL)
    folder = f"{TESTDATA}/sf0.001"
    got = {r.doc_id: r for r in queries.op1_sentencepiece(spark, folder).collect()}
    for d in spark.read.parquet(f"{folder}/documents.parquet").collect():
        assert got[d.doc_id].ids == library.encode(d.text) and got[d.doc_id].round_trip and got[d.doc_id].n_ids == len(got[d.doc_id].ids)


def test_one_pass_equals_two(spark):
    texts = [None, "", *odd_texts(8, 60)]
    docs = spark.createDataFrame([(t, "clash", 1) for t in texts], "text string, ids string, __x int")
    two = pieces.decode(pieces.encode(docs, MODEL), MODEL)
    one = pieces.read_back(docs, MODEL)
    assert sorted(one.columns) == sorted(two.columns)
    key = lambda r: (r["text"] or "", r["text"] is None)
    assert sorted(one.select(*two.columns).collect(), key=key) == sorted(two.collect(), key=key)
    assert pieces.read_back(docs.limit(0), MODEL).collect() == []
    told = {(r["text"], tuple(r["ids"] or ()), r["round_trip"]) for r in pieces.round_trips(docs, MODEL).collect()}
    assert told == {(r["text"], tuple(r["ids"] or ()), r["decoded"] == r["text"]) for r in one.collect()}
    assert pieces.round_trips(docs.limit(0), MODEL).collect() == []


def test_parts_do_not_depend_on_the_strip(monkeypatch):
    t = pieces.Transducer(MODEL)
    for text in ("", "\0", "a\0b c", "x" * 9_000, "ab " * 3_000 + "é" * 7_000 + " z", *odd_texts(5, 90)):
        whole = [p for strip in t._cuts.parts(text) for p in strip]
        assert "".join(whole) == text
        monkeypatch.setattr(pieces, "_STRIP", 3)
        assert [p for strip in t._cuts.parts(text) for p in strip] == whole
        monkeypatch.undo()
