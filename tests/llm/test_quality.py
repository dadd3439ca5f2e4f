import zlib

import numpy as np

from eventloom.llm import quality as q

SF = "/root/testdata/sf0.01"


def fold(d):
    return zlib.crc32(("" if d is None else str(d)).encode()) % 5


def test_held_out_documents_are_told_apart(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in q.quality(docs, labels).collect()}
    told = {r.doc_id: r.quality for r in labels.collect()}
    assert len(got) == docs.count()
    for d, r in got.items():
        assert r.held_out == (fold(d) == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    held = [d for d in told if fold(d) == 0]
    assert len(held) > 50
    assert sum(got[d].predicted == told[d] for d in held) >= 0.97 * len(held)
    # The same, step by step in one process.
    texts = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    taught = sorted(d for d in told if fold(d) != 0)
    x = np.stack([q.features(texts[d]) for d in taught])
    model = q.Model(x, np.array([told[d] for d in taught]))
    ids = sorted(got)
    wanted = model.score(np.stack([q.features(texts[d]) for d in ids]))
    assert np.allclose([got[d].score for d in ids], wanted)


def test_labels_of_held_out_rows_are_not_learned(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(300)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    held = q.remainder("doc_id", 5) == 0
    turned = labels.withColumn("quality", q.F.when(held, 1 - q.F.col("quality")).otherwise(q.F.col("quality")))
    assert sorted(map(tuple, q.quality(docs, labels).collect())) == sorted(map(tuple, q.quality(docs, turned).collect()))


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (2, ""), (3, " \n"), (None, "no id"), (4, "long " * 100_000), (5, "###")]
    docs = spark.createDataFrame([(*r, 1, 2.0) for r in rows], "doc_id long, text string, quality int, score double")
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = q.quality(docs, none).collect()
    assert len(got) == len(rows) and all(abs(r.score - 0.3) < 1e-9 for r in got)
    labels = spark.createDataFrame(
        [(1, 0), (2, 1), (2, 0), (3, None), (None, 1), (4, 1), (5, 0), (99, 1)], "doc_id long, quality int"
    )
    assert q.quality(docs, labels).count() == len(rows)
    kept = q.keep_good(docs, none)
    assert kept.columns == docs.columns and kept.count() == len(rows)
    assert q.quality(docs.limit(0), labels).count() == 0


def test_preferences_order_the_scores():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 3))
    labels = (x[:, 0] - 0.5 * x[:, 1] > -0.7).astype(int)
    better, worse = q.pairs(labels)
    assert (labels[better] == 1).all() and (labels[worse] == 0).all()
    w = q.bradley_terry(x, better, worse)
    raw = x @ w
    assert (raw[better] > raw[worse]).mean() > 0.99
    assert abs(w[2]) < 0.1 * w[0] and w[1] < 0


def test_variety_of_every_window():
    rng = np.random.default_rng(3)
    junk = [f"w{k}" for k in range(20_000)]
    junk[7_100:7_150] = ["buy"] * 50  # between two of 24 places spread over the text
    texts = [junk, ["a"], ["a"] * 50, [f"v{k}" for k in rng.integers(0, 60, 3_000)], list("abcab") * 9]
    for words in texts:
        width = min(len(words), 50)
        wanted = [len(set(words[k : k + width])) / width for k in range(len(words) - width + 1)]
        x = q.features(" ".join(words).encode())
        assert np.isclose(x[8], min(wanted)) and np.isclose(x[9], np.mean(wanted))
    assert np.isclose(q.features(" ".join(junk).encode())[8], 1 / 50)
