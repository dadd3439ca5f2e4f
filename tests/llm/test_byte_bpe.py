import base64
import hashlib
import random

import pytest
import tiktoken

from eventloom.llm import byte_bpe as bb


@pytest.fixture(scope="module")
def ranks():
    return bb.vocabulary()


@pytest.fixture(scope="module")
def library(ranks):
    content, pattern = ranks
    lines = (line.split() for line in content.splitlines())
    table = {base64.b64decode(t): int(i) for t, i in lines}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table, special_tokens={})


def awkward():
    rng = random.Random(11)
    some = ["the", "he", " ", "  ", "\n", "\t", "a", "th", "É", "1", "234", "'s", "'", "—", "中", "🙂", ".", " ", "\x1c", " ", "q"]
    texts = ["".join(rng.choice(some) for _ in range(rng.randrange(1, 40))) for _ in range(400)]
    texts += [" a", "a ", " ", "", "  a", "a  b", "a \n b", "it's 'll", "\x00a a", "a\x85b", "<|endoftext|>", "�"]
    return texts


def long_words():
    rng = random.Random(12)
    return [
        "a" * 5_001, "=" * 3_000 + " " * 2_001 + "x", "".join(rng.choice("0123456789") for _ in range(1_500)),
        "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(4_000)),
        "".join(rng.choice(["the", "he", "th", "e"]) for _ in range(300)), "é" * 400, "word " * 30_000,
    ]


def test_codec_equals_the_library(ranks, library):
    codec = bb.Codec(*ranks)
    texts = awkward() + long_words()
    got = codec.pieces([t.encode() for t in texts])
    packed = [b"".join(pieces) for pieces in got]
    for text, ids in zip(texts, packed):
        wanted = library.encode_ordinary(text)
        assert ids == b"".join(i.to_bytes(4, "little") for i in wanted), text[:60]
    assert codec.decode(got) == [t.encode() for t in texts]
    assert codec.decode([codec.runs(p) for p in packed]) == [t.encode() for t in texts]
    # What is remembered or cut into other slices changes nothing.
    codec.coded = bb.Remembered(3)
    assert [codec.pieces([t.encode()])[0] for t in texts[::8]] == got[::8]


def test_both_statements_give_the_same(ranks):
    codec = bb.Codec(*ranks)
    rng = random.Random(13)
    words = ["".join(rng.choice("thenadrio") for _ in range(rng.randrange(2, 60))).encode() for _ in range(300)]
    words = sorted({*words, b"aaaaaaa", b"thththth", b"\xff\x00\xfe" * 20})
    assert codec.contracted(words, bb.CONTRACT) == codec.contracted(words, bb.CONTRACT_LONG)


def test_rows_nulls_and_unknown_ids(spark, ranks):
    rows = [(1, None, "x"), (1, None, "x"), (None, "the cat", "y"), (2, "", "z"), (3, "the cat", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = bb.encode(docs, ranks, decoded=True).collect()
    assert sorted((r.n_tokens, bytes(r.decoded)) for r in got) == [(0, b"")] * 3 + [(2, b"the cat")] * 2
    again = bb.decode(bb.encode(docs, ranks), ranks)
    assert sorted(bytes(r.decoded) for r in again.collect()) == sorted(bytes(r.decoded) for r in got)
    none = bb.encode(docs.limit(0), ranks)
    assert none.columns == ["doc_id", "n_tokens", "ids"] and none.count() == 0
    odd = [(1, 1, bytearray(b"\xff\xff\xff\xff")), (2, 0, None), (3, 1, bytearray(b"\x01\x00")), (4, 1, bytearray(b"\x01\x00\x00\x00"))]
    told = spark.createDataFrame(odd, "doc_id string, n_tokens long, ids binary")
    out = {r.doc_id: r.decoded for r in bb.decode(told, ranks).collect()}
    assert out["1"] is None and out["3"] is None and out["2"] == b"" and out["4"] == b'"'


def test_query_round_trip(spark, library):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = bb.op11_byte_bpe(spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode_ordinary(texts[r.doc_id])
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(packed).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
