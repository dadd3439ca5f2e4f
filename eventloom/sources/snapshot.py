"""Stored descriptions and edges, laid out so that a small batch reads a small part."""

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from eventloom import schemas

BUCKETS = 1_024
_LAYOUT = "buckets int, version string, made_at timestamp"
EDGE = T.StructType([T.StructField(c, T.StringType()) for c in ("parent", "child")])


def _bucket(uri, buckets):
    return F.pmod(F.xxhash64(uri), F.lit(buckets)).cast("int")


def _write(rows: DataFrame, path: str, key: str, order: list, buckets: int, files: int | None):
    """A new version beside the old one; readers move to it when its layout row is there."""
    spark = rows.sparkSession
    by = ["bucket", key, *order]
    version = uuid.uuid4().hex
    dealt = rows.withColumn("bucket", _bucket(key, buckets)).repartitionByRange(
        files or int(spark.conf.get("spark.sql.shuffle.partitions")), *by
    )
    dealt.sortWithinPartitions(*by).write.partitionBy("bucket").parquet(f"{path}/version={version}")
    layout = spark.range(1).select(
        F.lit(buckets).alias("buckets"), F.lit(version).alias("version"),
        F.current_timestamp().alias("made_at"),
    )
    layout.coalesce(1).write.mode("append").parquet(f"{path}/layout")


def _read(spark, path: str, schema, uris: DataFrame | None, buckets: int | None) -> DataFrame:
    layout = spark.read.schema(_LAYOUT).parquet(f"{path}/layout").orderBy(F.desc("made_at")).first()
    if buckets is not None and buckets != layout.buckets:
        raise ValueError(f"{path} has {layout.buckets} buckets, not {buckets}")
    schema = T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])
    rows = spark.read.schema(schema).parquet(f"{path}/version={layout.version}")
    if uris is not None:
        touched = uris.select(_bucket(F.col(uris.columns[0]), layout.buckets).alias("b")).distinct()
        rows = rows.filter(F.col("bucket").isin([r.b for r in touched.collect()]))
    return rows.drop("bucket")


def write_triples(triples: DataFrame, path: str, buckets: int = BUCKETS, files: int | None = None):
    """Store triples partitioned by a hash bucket of their document and sorted by document.

    Rows are cut into files by range, so a bucket or document of any size takes as many files
    as it needs. ``files`` is the number of tasks; by default the session's shuffle setting.
    The number of buckets is stored with the table. Batches that still read the version before
    are not disturbed.
    """
    _write(triples, path, "doc", ["ord", "object"], buckets, files)


def read_triples(
    spark: SparkSession, path: str, uris: DataFrame | None = None, buckets: int | None = None
) -> DataFrame:
    """Stored triples; with ``uris`` (one column) only the buckets their documents can be in.

    What reaches the driver is a list of at most as many numbers as the table has buckets.
    Other documents of the same buckets come along: the callers join on the document anyway.
    ``buckets``, if given, must be what the table was written with.
    """
    return _read(spark, path, schemas.TRIPLE, uris, buckets)


def write_edges(edges: DataFrame, path: str, buckets: int = BUCKETS, files: int | None = None):
    """Store (parent, child) once, without repeats, by bucket of the parent."""
    rows = edges.select("parent", "child").filter(F.col("child").isNotNull()).distinct()
    _write(rows, path, "parent", ["child"], buckets, files)


def read_edges(spark: SparkSession, path: str, parents: DataFrame | None = None) -> DataFrame:
    """Stored edges; with ``parents`` (one column) only the buckets these can be in."""
    return _read(spark, path, EDGE, parents, None)
