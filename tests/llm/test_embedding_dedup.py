import math

import numpy as np
import pytest

from eventloom.llm import embedding_dedup as ed


def plain(rows, cosine=0.93):
    """[(vec_id, vector, label)] -> sorted result rows by comparing all pairs."""
    sound = []
    for _, v, label in rows:
        ok = label is not None and bool(v) and all(x is not None and math.isfinite(x) for x in v)
        sound.append(ok and any(v))
    n = len(rows)
    unit = [np.array(v, dtype=float) / np.linalg.norm(v) if s else None for (_, v, _), s in zip(rows, sound)]
    root, links = list(range(n)), [0] * n

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(n):
        for j in range(i):
            if not (sound[i] and sound[j]) or rows[i][2] != rows[j][2] or len(unit[i]) != len(unit[j]):
                continue
            if unit[i] @ unit[j] >= cosine:
                links[i] += 1
                links[j] += 1
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for k, r in enumerate(rows):
        if r[0] is not None:
            least[find(k)] = min(least.get(find(k), r[0]), r[0])
    out = []
    for k, r in enumerate(rows):
        c = least.get(find(k)) if sound[k] else r[0]
        out.append((r[0], links[k], c, r[0] is not None and r[0] == c))
    return out


def order(r):
    return (r[0] is None, r[0] or 0, r[1])


def check(spark, rows):
    frame = spark.createDataFrame(
        [(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, label int, c int, root string"
    )
    got = sorted((tuple(r) for r in ed.embedding_dedup(frame).collect()), key=order)
    narrow = [(i, v and [None if x is None else float(np.float32(x)) for x in v], l) for i, v, l in rows]
    assert got == sorted(plain(narrow), key=order)


def test_sample_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(ed, "CELL", 40)
    monkeypatch.setattr(ed, "BLOCK", 32)
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()
    check(spark, [(r.vec_id, list(r.embedding), r.label) for r in rows])


def test_clusters_over_many_cells_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(ed, "CELL", 10)
    monkeypatch.setattr(ed, "BLOCK", 8)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 5))
    rows = [(k, (centres[k % 6] + rng.normal(scale=0.22, size=5)).tolist(), k % 2) for k in range(160)]
    rows += [(200 + k, rows[0][1], 0) for k in range(20)]
    check(spark, rows)


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 0), (2, [], 0), (3, [0.0, 0.0], 0), (4, [1.0, None], 0), (5, [nan, 1.0], 0)]
    rows += [(6, [inf, 1.0], 0), (7, [1.0, 2.0], None), (8, [1.0, 2.0], None), (9, [1.0, 2.0], 0)]
    rows += [(10, [2.0, 4.0], 0), (10, [2.0, 4.0], 0), (None, [1.0, 2.1], 0), (11, [1.0, 2.0, 0.0], 0)]
    rows += [(12, [-0.0, 1.0], 5), (13, [0.0, 1.0], 5), (None, [0.5, -1.0], 6), (14, [1e38, 2e38], 0)]
    check(spark, rows)
    assert ed.embedding_dedup(
        spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    ).count() == 0


@pytest.mark.parametrize("cosine", [0.5, 0.93])
def test_visits_lose_no_pair(cosine):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 4))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    centres = x[:12]
    near = x @ centres.T
    home = near.argmax(axis=1)
    gap = np.sqrt(np.maximum(0, 2 - 2 * np.clip(centres @ centres.T, -1, 1)))
    visits = near[np.arange(300), home][:, None] - near <= gap[home] * math.sqrt(2 - 2 * cosine) + 1e-9
    i, j = np.nonzero(x @ x.T >= cosine)
    assert visits[i, home[j]].all()
