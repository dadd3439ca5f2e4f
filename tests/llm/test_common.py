import random

import pyarrow as pa

from eventloom.llm.blocks import merge, units, whole_groups
from eventloom.llm.common import components, fresh, stored


def plain(edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for u, v in edges:
        a, b = find(u), find(v)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


def test_components_of_chains_stars_and_random_links(spark):
    rng = random.Random(2)
    edges = [(k, k + 1) for k in range(40)] + [(1000, k) for k in range(900, 960)]
    edges += [(rng.randrange(-200, -100), rng.randrange(-200, -100)) for _ in range(60)]
    edges += [(7, 7), (5, 6), (6, 5)]
    rng.shuffle(edges)
    got = components(spark.createDataFrame(edges, "u long, v long"), "test").collect()
    found = {r.node: r.root for r in got}
    assert len(found) == len(got)
    assert found == {x: r for x, r in plain([e for e in edges if e[0] != e[1]]).items()}
    assert components(spark.createDataFrame([], "u long, v long"), "none").count() == 0


def test_units_meet_every_pair_of_a_bucket(spark):
    rows = [(1, k) for k in range(23)] + [(2, 50)] + [(3, k) for k in range(100, 104)]
    keyed = spark.createDataFrame(rows, "key long, item long")
    met = {}
    for r in units(keyed, "key", "item", 5, "test").collect():
        met.setdefault((r.key, r.unit_a, r.unit_b), set()).add(r.item)
    assert 2 not in {k for k, _, _ in met}
    for key in (1, 3):
        items = [i for k, i in rows if k == key]
        for a in items:
            for b in items:
                assert any(k == key and {a, b} <= m for (k, _, _), m in met.items())


def test_whole_groups_and_merge():
    batches = [pa.RecordBatch.from_pydict({"k": k}) for k in ([1, 1, 2], [2, 2], [], [2, 3], [4])]
    assert [t.column("k").to_pylist() for t in whole_groups(batches, ["k"])] == [[1, 1], [2, 2, 2, 2], [3], [4]]
    import numpy as np

    labels = np.arange(6)
    merge(labels, np.array([5, 3, 1]), np.array([3, 4, 0]))
    assert labels.tolist() == [0, 0, 2, 3, 3, 3]


def test_stored_rows_and_names(spark):
    df = spark.range(10).withColumnRenamed("id", "Row")
    assert fresh(df, "row") != "row" and fresh(df, "other") == "other"
    kept = stored(df, "test")
    assert kept.dtypes == df.dtypes and kept.count() == 10
