import math
from collections import defaultdict

import numpy as np
import pytest

from eventloom.llm import mixing as mx

SCHEMA = "doc_id long, text string, source string, row int, target string"


def plain_targets(sizes):
    """sizes: {source: words} -> {source: target} by dealing the excess anew until none is left."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    total, stopped = 1.5 * sum(sizes.values()), {}
    while True:
        left = {s: weight[s] for s in order if s not in stopped}
        if not left:
            return stopped
        share = (total - sum(stopped.values())) / sum(left.values())
        over = [s for s in left if share * weight[s] > 2 * sizes[s]]
        if not over:
            return {**stopped, **{s: share * weight[s] for s in left}}
        stopped.update({s: 2.0 * sizes[s] for s in over})


def check(spark, rows):
    """rows: [(doc_id, text, source)]"""
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    got = mx.mix(docs).collect()
    assert len(got) == len(rows)
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len((t or "").encode().split())
    targets = plain_targets(dict(sizes)) if rows else {}
    by_source, source_of = defaultdict(int), {r[0]: r[2] for r in rows}
    for r in got:
        s = source_of[r.doc_id]
        assert r.source_size == sizes[s]
        assert r.target == pytest.approx(targets[s])
        assert 0 <= r.taken <= 2 * r.size
        by_source[s] += r.taken
    for s, t in targets.items():
        assert abs(by_source[s] - t) <= 3
    return sorted(tuple(r) for r in got if r.doc_id is not None)


def test_sample(spark, monkeypatch):
    monkeypatch.setattr(mx, "BLOCK", 7)
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "source")
    rows = [tuple(r) for r in rows.collect()]
    assert check(spark, rows) == check(spark, rows[::-1])


def test_edge_cases(spark):
    rows = [(k, "w " * (k % 5 + 1), "big") for k in range(60)] + [(100, None, "b"), (101, "", "b")]
    rows += [(102, "a b c", None), (103, "a\x0bb", "é"), (104, "x " * 30_000, "z"), (105, "one", "Z")]
    rows += [(106, "same size", "t"), (107, "same size", "t"), (107, "same size", "t"), (None, "no id", "t")]
    docs_sources = {r[0]: r[2] for r in rows}
    assert len(docs_sources) == len(rows) - 1
    check(spark, rows)
    check(spark, [])
    check(spark, [(1, None, None)])


def test_mixture_holds_what_was_taken(spark):
    rows = [(k, f"first{k} " + "w\n" * (k % 6), "ab"[k % 2]) for k in range(40)] + [(50, "", "c"), (51, None, None)]
    docs = spark.createDataFrame([(*r, 7, "x") for r in rows], SCHEMA)
    taken = {r.doc_id: r.taken for r in mx.mix(docs).collect()}
    out = mx.mix_documents(docs)
    assert out.columns == docs.columns
    words, texts = defaultdict(int), dict((r[0], r[1]) for r in rows)
    for r in out.collect():
        words[r.doc_id] += len((r.text or "").split())
        assert (texts[r.doc_id] or "").startswith(r.text or "")
    assert {d: n for d, n in words.items() if n} == {d: n for d, n in taken.items() if n}
    assert mx.mix_documents(docs.limit(0)).count() == 0


def test_flight_keeps_both_totals():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 50, 400):
        p, size = rng.uniform(0, 1, n), rng.integers(1, 30, n)
        out = mx.flight(p, size)
        assert ((out > 0) & (out < 1)).sum() <= 2
        assert out.sum() == pytest.approx(p.sum())
        assert (out * size).sum() == pytest.approx((p * size).sum())
        assert math.isclose(out.min(), 0, abs_tol=1) and out.max() <= 1 and out.min() >= 0
