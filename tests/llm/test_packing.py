import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from eventloom.llm import packing as pk

SF = "/root/testdata/sf0.001"


def check(spark, rows, padding=None):
    """Every id in one piece, digests right, sequences gapless and not too long."""
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, n int, piece string")
    got = pk.pack(docs, pk.word_vocabulary()).collect()
    tokenizer = Tokenizer.from_str(pk.word_vocabulary())
    wanted = defaultdict(list)
    for d, t in rows:
        wanted[d].append([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1])
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert set(by_doc) == set(wanted)
    for d, lists in wanted.items():
        pieces = sorted((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in by_doc[d])
        if len(lists) > 1:  # rows that repeat an id: as many pieces, told apart by digest
            assert sum(p[1] for p in pieces) == sum(map(len, lists))
            continue
        at = 0
        for start, length, crc, total in pieces:
            assert start == at and total == len(lists[0])
            ids = np.array(lists[0][start : start + length], "<u4")
            assert crc == zlib.crc32(ids.tobytes())
            at += length
        assert at == len(lists[0])
    total = padded = 0
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= 2048
        total += at
        padded += 0 if at & (at - 1) == 0 else 2048 - at
    if padding is not None:
        assert padded <= padding * total
    return got


def test_sample(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    check(spark, [tuple(r) for r in rows], padding=0.001)


def test_edge_cases(spark, monkeypatch):
    monkeypatch.setattr(pk, "REMEMBERED", 50)
    rows = [(1, None), (2, ""), (3, " \t"), (4, "word " * 9_000), (5, "word " * 2047), (6, "word " * 2048)]
    rows += [(7, "Ünïcode space É é ΑΣ ΑΣ."), (8, "don't 12345 ###a1b2|c"), (None, "no id")]
    rows += [(9, "copy of a row"), (9, "copy of a row"), (10, "\x1c\x85 a\x0bb 世界\U0001f600")]
    check(spark, rows, padding=0.001)
    assert pk.pack(spark.createDataFrame([], "doc_id long, text string"), pk.word_vocabulary()).count() == 0


@pytest.mark.parametrize("lengths", [[700] * 50, [1024] * 9 + [1] * 5, list(range(1, 2048)), [1500] * 7 + [548] * 3])
def test_plan_places_every_piece(lengths):
    histogram = np.bincount(lengths, minlength=pk.WINDOW + 1)
    plan = pk.Plan(histogram)
    seen = defaultdict(list)
    for length in np.flatnonzero(histogram):
        number = np.arange(histogram[length])
        rows, start, size, sequence, offset = plan.place(np.full(len(number), length), number)
        assert np.bincount(rows, size).tolist() == [length] * len(number)
        for s, o, n in zip(sequence, offset, size):
            seen[s].append((o, n))
    for parts in seen.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at == pk.WINDOW or at & (at - 1) == 0


def test_least_squares_is_not_negative_and_near():
    columns = np.array([[1000, 1, 1048, 1, 0, 0], [512, 4, 0, 0, 0, 0], [1000, 2, 48, 1, 0, 0]])
    wanted = np.zeros(2049)
    wanted[[1000, 1048, 512, 48]] = 30, 10, 40, 10
    x = pk.least_squares(columns, wanted)
    assert (x >= 0).all() and np.allclose(x, [10, 10, 10], atol=0.05)
