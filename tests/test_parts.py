from pyspark.sql import functions as F

from eventloom.operators.parts import with_part


def test_groups_are_dealt_by_a_stated_size_without_a_job(spark):
    rows = [("big", f"line {n}") for n in range(200)] + [("big", "line 0")] + [("small", "x"), (None, "y")]
    df = spark.createDataFrame(rows, "k string, line string")
    before = spark.sparkContext.statusTracker().getJobIdsForGroup()
    dealt = with_part(df, "k", "line", 20)
    assert spark.sparkContext.statusTracker().getJobIdsForGroup() == before
    found = dealt.collect()
    big = [r for r in found if r.k == "big"]
    assert len(found) == len(rows) and {r.parts for r in big} == {11}
    assert min(r.part for r in big) == 0 and len({r.part for r in big}) > 8
    assert len({r.part for r in big if r.line == "line 0"}) == 1
    assert {(r.part, r.parts) for r in found if r.k != "big"} == {(0, 1)}
    assert with_part(df.filter(F.lit(False)), "k", "line", 20).count() == 0
