"""Exact duplicates: frequent digests leave map-side, the others meet in one ordinary shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eventloom.llm.common import SPACES, stored, table, whole_text

#: Digests a sketch keeps track of, and how many of them may be handled as frequent.
TRACKED = 16_384
FREQUENT = 2_048
#: Groups in which the tasks' sketches meet before the last merge.
MERGES = 64


def digested(docs: DataFrame) -> DataFrame:
    """(doc_id, text_sha256, row): the digest of each normalised text, the row's number fixed."""
    text = F.regexp_replace(whole_text(), SPACES, " ")
    rows = docs.select("doc_id", F.sha2(text.cast("binary"), 256).alias("text_sha256"))
    return stored(rows.withColumn("row", F.monotonically_increasing_id()), "digests")


def frequent_digests(digests: DataFrame) -> DataFrame:
    """Candidates of a Misra-Gries sketch: at most ``FREQUENT`` digests, whatever the input.

    Spark's frequent-items sketch is of the Misra-Gries family: a bounded table of counters
    that are lowered together when it is full. A digest with more than about rows / FREQUENT
    rows is among the candidates; sketches merge in two levels.
    """
    part = digests.select("text_sha256", (F.spark_partition_id() % MERGES).alias("m"))
    sketches = part.groupBy("m").agg(
        F.expr(f"approx_top_k_accumulate(text_sha256, {TRACKED})").alias("s")
    )
    # Grouped by a constant, as a task without rows would hand on a sketch without a type.
    merged = sketches.groupBy(F.lit("all")).agg(
        F.expr(f"approx_top_k_combine(s, {TRACKED})").alias("s")
    )
    top = merged.select(F.inline(F.expr(f"approx_top_k_estimate(s, {FREQUENT})")))
    return top.where("item is not null and count > 1").select(F.col("item").alias("text_sha256"))


def exact_dedup(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical after each run of ASCII white space became one
    space; a null text is empty. The row with the smallest doc_id stays (a null id comes last);
    of rows that repeat this id exactly one stays. Each row of a group has the same keep_id,
    and only one has ``kept``. An empty table gives no rows; further columns are not read.

    Frequent digests are counted in a second pass that only they take part in (partial sums,
    a row per digest and task); those that are verified to repeat are broadcast, at most
    ``FREQUENT`` rows of about 100 bytes, and their rows are settled where they lie. A digest
    that is left has at most about rows / FREQUENT rows, so the window's groups stay small.
    """
    digests = digested(docs)
    first = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id"), F.col("row"))
    winners = (
        digests.join(F.broadcast(frequent_digests(digests)), "text_sha256")
        .groupBy("text_sha256")
        .agg(F.min(first).alias("first"), F.count("*").alias("group_size"))
        .where("group_size > 1")
    )
    winners = stored(winners, "frequent")
    marked = digests.join(F.broadcast(winners), "text_sha256", "left")
    settled = marked.where("group_size is not null")
    rest = marked.where("group_size is null").select("doc_id", "row", "text_sha256")
    same = W.partitionBy("text_sha256")
    rest = rest.select(
        "*",
        F.min(first).over(same).alias("first"),
        F.count("*").over(same).alias("group_size"),
    )
    return settled.unionByName(rest).select(
        "doc_id",
        F.col("first.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("first.row")).alias("kept"),
        "text_sha256",
    )


def op1_exact_dedup(spark, sf_dir):
    return exact_dedup(table(spark, sf_dir, "documents"))


OP1_SQL = r"""
with t as (
    select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as text_sha256
    from documents
)
select doc_id,
       min(doc_id) over (partition by text_sha256) as keep_id,
       count(*) over (partition by text_sha256) as group_size,
       doc_id = min(doc_id) over (partition by text_sha256) as kept,
       text_sha256
from t
"""
