"""Helpers that the operators share: shared storage, reading tables, connected components."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.session import work_dir

# White space of all contracts: space and the five ASCII control spaces.
SPACES = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Paths of what ``stored`` has written, while ``recorded`` asks for them.
_RECORDS: list = []


@contextmanager
def recorded():
    """The paths that ``stored`` writes to meanwhile, as a list that fills."""
    paths: list = []
    _RECORDS.append(paths)
    try:
        yield paths
    finally:
        _RECORDS.remove(paths)


def removed(spark: SparkSession, paths: list) -> None:
    """Remove stored rows that nobody reads any more, and empty the list."""
    while paths:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(paths.pop())
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written once to the cluster's shared folder and read back.

    This cuts the lineage with files that outlive executors, and what would differ between
    two evaluations (row numbers, random order) is fixed from here on. The files go when the
    session ends.
    """
    spark = df.sparkSession
    path = work_dir(spark, f"llm-{name}")
    df.write.parquet(path)
    for paths in _RECORDS:
        paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, base: str) -> str:
    """A column name that no column of the input bears (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name = f"{base}_{uuid.uuid4().hex[:6]}"
    return name


def whole_text(column: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def remainder(column: str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, root): the smallest node that links reach, for every node of ``edges(u, v)``.

    Alternates large-star and small-star steps (Kiveris et al. 2014). A node's smallest
    neighbour is a map-side minimum; the join that hands it out runs on stored tables, so that
    adaptive execution can split a hub. Each step is written to the shared folder. An edge
    list holds no more rows after a step than before it.
    """
    u, v = F.col("u"), F.col("v")
    state = stored(
        edges.where(u != v).select(F.least(u, v).alias("p"), F.greatest(u, v).alias("c")).distinct(),
        f"{name}-edges",
    )
    before = None
    while True:
        # Large star: every larger neighbour of x hangs on x's smallest neighbour (or x).
        both = state.select(F.col("p").alias("x"), F.col("c").alias("y")).unionByName(
            state.select(F.col("c").alias("x"), F.col("p").alias("y"))
        )
        least = stored(
            both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m")), f"{name}-least"
        )
        # A row (p, c) gives (c, m(p)); the row (c, p) gives nothing as p < c.
        large = stored(
            state.join(least.select(F.col("x").alias("p"), "m"), "p")
            .select(F.col("m").alias("p"), "c")
            .where(F.col("p") != F.col("c"))
            .distinct(),
            f"{name}-large",
        )
        # Small star: x and its smaller neighbours hang on the smallest of them.
        smaller = stored(large.groupBy("c").agg(F.min("p").alias("m")), f"{name}-smaller")
        small = stored(
            large.join(smaller, "c")
            .select(F.inline(F.array(
                F.struct(F.col("m").alias("p"), F.col("c").alias("c")),
                F.struct(F.col("m").alias("p"), F.col("p").alias("c")),
            )))
            .where(F.col("p") != F.col("c"))
            .distinct(),
            f"{name}-small",
        )
        mark = small.agg(
            F.count("*").alias("n"),
            F.bit_xor(F.xxhash64("p", "c")).alias("h"),
            F.sum(F.xxhash64("p", "c").cast("decimal(38,0)")).alias("s"),
        ).first()
        state = small
        if tuple(mark) == before:
            break
        before = tuple(mark)
    # At the fixed point every edge joins a node to its root.
    return state.select(F.col("c").alias("node"), F.col("p").alias("root")).unionByName(
        state.select(F.col("p").alias("node"), F.col("p").alias("root")).distinct()
    )
