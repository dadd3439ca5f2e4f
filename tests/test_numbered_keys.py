"""Rows are sorted by numbers before texts that begin alike; a log is folded with its base at once."""

from datetime import datetime

from pyspark.sql import functions as F

from eventloom.functions import join_numbered
from eventloom.operators import hierarchy
from eventloom.streaming import state


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def change(op, day, subject, title=None, graph=None):
    seq = None if day is None else (datetime(2024, 1, day), f"e{day}", 0)
    return (op, seq, graph, subject, "title" if title else None, title, None, None, None)


def test_join_numbered_gives_the_rows_of_the_plain_join_and_sorts_by_number(spark):
    left = spark.createDataFrame([("u/1", 1), ("u/1", 2), ("u/2", 3), (None, 4)], "uri string, n int")
    right = spark.createDataFrame([("u/1", "a"), ("u/1", "b"), ("u/3", "c"), (None, "d")], "uri string, t string")
    for how in ("inner", "left", "left_semi", "left_anti"):
        got, plain = join_numbered(left, right, "uri", how), left.join(right, "uri", how)
        assert got.columns == plain.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))
    joined = join_numbered(left, right.hint("merge"), "uri")
    assert "SortMergeJoin [_number" in plan_of(joined)


def test_base_and_log_are_folded_in_one_pass_however_large_the_log_is(spark, tmp_path):
    base = [
        change("add", None, "a", "old"), change("add", 2, "b", "kept"), change("purge", 2, "b"),
        change("add", 3, "c", "same"), change("purge", 3, "c"), change("add", None, "d", "untouched"),
        change("add", 5, "g", "mine", "graph"),
    ]
    log = [
        change("purge", 4, "a"), change("add", 4, "a", "new"), change("purge", 1, "b"), change("add", 1, "b", "late"),
        change("purge", 4, "c"), change("add", 4, "c", "same"), change("purge", 6, "g"),
    ]
    parts = []
    for name, rows in (("base", base), ("log", log)):
        spark.createDataFrame(rows, state.TRIPLE_CHANGE).write.parquet(f"{tmp_path}/{name}")
        parts.append(spark.read.schema(state.TRIPLE_CHANGE).parquet(f"{tmp_path}/{name}"))
    merged = state._merged_triples(*parts)
    days = merged.select("op", F.dayofmonth("seq.ts"), "graph", "subject", "object").collect()
    assert sorted(map(tuple, days), key=repr) == sorted([
        ("add", 4, None, "a", "new"), ("add", 2, None, "b", "kept"), ("add", 4, None, "c", "same"),
        ("add", None, None, "d", "untouched"), ("add", 5, "graph", "g", "mine"),
        ("purge", 4, None, "a", None), ("purge", 2, None, "b", None), ("purge", 4, None, "c", None),
        ("purge", 6, None, "g", None),
    ], key=repr)
    # Additions once, purges twice: for the fold and as rows of the new base.
    assert plan_of(merged).count("FileScan") <= 6


def test_a_level_of_the_walk_collects_its_sets_by_number(spark):
    links = spark.createDataFrame([("u/1", "u/3"), ("u/2", "u/3"), ("u/2", "u/4")], "parent string, child string")
    frontier = spark.createDataFrame([("u/1", [1]), ("u/2", [1, 2])], "uri string, roots array<long>")
    reached = hierarchy._Walk(spark, 4).reached(links, frontier)
    assert reached.columns == ["bucket", "uri", "roots"]
    assert {r.uri: sorted(r.roots) for r in reached.collect()} == {"u/3": [1, 2], "u/4": [1, 2]}
    assert "ObjectHashAggregate(keys=[_number" in plan_of(reached)
