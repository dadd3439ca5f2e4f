"""The last action of each resource, kept by a running query in Spark's state store."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventloom.operators.routing import latest_per_uri
from eventloom.streaming import changelog
from eventloom.streaming.state import stamped

LATEST = "uri string, event_id string, ts timestamp, action string"


def keep_latest(
    actions: DataFrame, target: str, checkpoint: str, available_now: bool = False, writer: str = "main"
):
    """Start a query over a stream of actions (event_id, uri, ts, action).

    The state holds one row a resource: its last action by event time, whatever the order in which
    files, batches and events arrive, so a late event changes nothing that came after it. There is
    no watermark, as a resource never stops counting; state grows with the resources, one row
    each (choose the RocksDB state store for very many). A batch writes the resources that it
    changed to the table at ``target``; a replayed batch replaces itself.
    """
    columns = [F.col(name).cast(kind).alias(name) for name, kind in map(str.split, LATEST.split(", "))]
    last = latest_per_uri(stamped(actions).select(*columns))

    def write(rows: DataFrame, batch_id: int):
        changelog.write_batch(rows, target, batch_id, writer)

    query = last.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write)
    if available_now:
        query = query.trigger(availableNow=True)
    return query.start()


def current_latest(spark: SparkSession, target: str) -> DataFrame:
    """(uri, event_id, ts, action): the last action of each resource, as its latest batch said."""
    schema = spark.createDataFrame([], LATEST).schema
    rows = changelog.read_changes(spark, target, schema)
    return latest_per_uri(rows)


def compact_latest(spark: SparkSession, target: str, keep: int = 2) -> None:
    """One row a resource in a new base; the batches before are removed."""
    schema = spark.createDataFrame([], LATEST).schema
    changelog.rebase(
        spark, target, lambda b: latest_per_uri(changelog.read_changes(spark, target, schema, b)).select(schema.fieldNames())
    )
    changelog.expire(spark, target, keep)
