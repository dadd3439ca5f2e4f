"""Delivery with redelivery, dead letters, and the plain sinks."""

import base64
import hashlib
import http.client
import re
import time
import urllib.parse
import uuid
from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from eventloom import schemas, vocab
from eventloom.streaming import changelog

Transport = Callable[[str], None]

_OUTCOME = (
    T.StructField("attempts", T.IntegerType()),
    T.StructField("error", T.StringType()),
)

# Name of a file that a FileDrop has made.
_DROPPED = re.compile("[0-9a-f]{16}-[0-9a-f]{32}")


class HttpPost:
    """Transport that posts each payload; raises on any failure. Sent to executors whole.

    A task keeps its connection between payloads and opens a new one after a failure.
    """

    def __init__(self, url, username=None, password=None, content_type="application/json"):
        self.url = url
        self.connection = None
        self.headers = {"Content-Type": content_type}
        if username and username.strip():
            pair = f"{username}:{password or ''}".encode()
            self.headers["Authorization"] = "Basic " + base64.b64encode(pair).decode()

    def __getstate__(self):
        return {**self.__dict__, "connection": None}

    def _connected(self):
        if self.connection is None:
            parts = urllib.parse.urlsplit(self.url)
            kind = http.client.HTTPSConnection if parts.scheme == "https" else http.client.HTTPConnection
            self.connection = kind(parts.netloc, timeout=60)
        return self.connection

    def __call__(self, payload: str) -> None:
        parts = urllib.parse.urlsplit(self.url)
        path = urllib.parse.urlunsplit(("", "", parts.path or "/", parts.query, ""))
        try:
            connection = self._connected()
            connection.request("POST", path, payload.encode(), self.headers)
            answer = connection.getresponse()
            answer.read()
        except Exception:
            self.close()
            raise
        if not 200 <= answer.status < 300:
            raise OSError(f"{answer.status} {answer.reason}")

    def close(self) -> None:
        if self.connection is not None:
            self.connection.close()
            self.connection = None


#: Shelves of a drop of very many payloads.
SHELVES = 4_096


class FileDrop:
    """Transport that puts each payload into a file of its own in a folder that must be there,
    in any store that pyarrow opens (a plain path is a mounted one).

    With ``shelves`` the files are dealt at random over so many subfolders, repeats of a payload too:
    a folder of very many files can be read by many tasks, and removed bit by bit (see ``dropped``).
    """

    def __init__(self, folder, shelves: int | None = None):
        self.folder = folder
        self.shelves = shelves

    def opened(self):
        """(store, path) of the folder."""
        from pyarrow import fs

        store, path = fs.FileSystem.from_uri(self.folder)
        if store.get_file_info(path).type != fs.FileType.Directory:
            raise FileNotFoundError("no such folder")
        return store, path

    def shelf(self, number: int) -> str:
        return f"/{number:06x}" if self.shelves else ""

    def __call__(self, payload: str) -> None:
        store, path = self.opened()
        data, own = payload.encode(), uuid.uuid4()
        shelf = path + self.shelf(own.int % (self.shelves or 1))
        place = f"{shelf}/{hashlib.sha256(data).hexdigest()[:16]}-{own.hex}"
        try:
            out = store.open_output_stream(place)
        except FileNotFoundError:
            if not self.shelves:
                raise
            store.create_dir(shelf, recursive=False)
            out = store.open_output_stream(place)
        with out:
            out.write(data)


def dropped(spark: SparkSession, drop: FileDrop) -> DataFrame:
    """(message): what lies in the folder of a ``FileDrop``, a row for each file.

    Each task lists and reads shelves of its own; no list of files passes through the driver.
    """
    shelves = drop.shelves or 1

    def read(batches):
        from pyarrow import fs

        store, path = drop.opened()
        texts, size = [], 0
        for batch in batches:
            for number in batch.column(0).to_pylist():
                for file in store.get_file_info(fs.FileSelector(path + drop.shelf(number), allow_not_found=True)):
                    if not _DROPPED.fullmatch(file.base_name):
                        continue
                    with store.open_input_stream(file.path) as lines:
                        texts.append(lines.read().decode(errors="replace"))
                    size += len(texts[-1])
                    if len(texts) == 10_000 or size > 4_000_000:
                        yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["message"])
                        texts, size = [], 0
        yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["message"])

    tasks = min(shelves, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return spark.range(0, shelves, 1, tasks).mapInArrow(read, "message string")


def _attempt(transport, payload, max_redeliveries, delay):
    """(attempts made, last error or None)."""
    error = None
    for attempt in range(1, max_redeliveries + 2):
        try:
            transport(payload)
            return attempt, None
        except Exception as problem:  # any failure of the receiver counts
            error = f"{type(problem).__name__}: {problem}"
            if delay and attempt <= max_redeliveries:
                time.sleep(delay)
    return max_redeliveries + 1, error


def with_retry(
    df: DataFrame,
    transport: Transport,
    payload: str = "message",
    max_redeliveries: int = 10,
    delay: float = 0.0,
    group: str | None = None,
    order: str | None = None,
) -> DataFrame:
    """Hand every payload to the transport; adds ``attempts`` and ``error`` (null if sent).

    Rows of one ``group`` are sent by one task in ``order``; after one that fails for good the
    rest of its group is not sent (0 attempts), as it belongs to what came before.

    Each executor sends its own partitions. The frame sends when it is evaluated, so write it
    once and read the written outcome (see ``deliver``). A lost task is run again: delivery
    is at least once, receivers must accept repeats.
    """
    schema = T.StructType([*df.schema.fields, *_OUTCOME])

    def send(batches):
        failed = None
        for batch in batches:
            outcome = []
            names = batch[group] if group else [None] * len(batch)
            for text, name in zip(batch[payload], names):
                if group and failed is not None and name == failed:
                    outcome.append((0, "an earlier part failed"))
                    continue
                outcome.append(_attempt(transport, text, max_redeliveries, delay))
                failed = name if outcome[-1][1] is not None else None
            batch["attempts"] = pd.Series([o[0] for o in outcome], index=batch.index, dtype="int32")
            batch["error"] = pd.Series([o[1] for o in outcome], index=batch.index, dtype="object")
            yield batch

    if group:
        df = df.repartition(group).sortWithinPartitions(group, order)
    return df.mapInPandas(send, schema)


def dead_letters(outcome: DataFrame, service: str, payload: str = "message") -> DataFrame:
    """Payloads that ran out of attempts."""
    return outcome.filter(F.col("error").isNotNull()).select(
        F.col(payload).alias("payload"),
        F.lit(service).alias("service"),
        "attempts",
        "error",
        F.current_timestamp().alias("failed_at"),
    )


def write_dead_letters(letters: DataFrame, target: str, batch_id: int, writer: str = "main"):
    """One folder per batch, so a replayed batch replaces its own letters."""
    letters.write.mode("overwrite").json(f"{target}/writer={writer}/batch={batch_id}")


def read_dead_letters(spark: SparkSession, target: str) -> DataFrame:
    reader = spark.read.schema(schemas.DEAD_LETTER).option("recursiveFileLookup", "true")
    return reader.json(target)


@dataclass(frozen=True)
class Redelivery:
    """Later attempts: the first after ``pause`` seconds, each pause ``factor`` times the one
    before, ``limit`` of them before a message becomes a dead letter."""

    pause: float = 60.0
    factor: float = 2.0
    limit: int = 10


#: The queue's log: messages that failed, and groups of them that a newer message has overtaken.
QUEUE = T.StructType([
    T.StructField("op", T.StringType()), T.StructField("message", T.StringType()),
    T.StructField("grouped", T.StringType()), T.StructField("place", T.IntegerType()),
    T.StructField("attempts", T.IntegerType()), T.StructField("error", T.StringType()),
    T.StructField("due_at", T.TimestampType()), T.StructField("seq", T.LongType()),
])


def queued(spark: SparkSession, target: str, at=None, batches=None) -> DataFrame:
    """Messages that wait for another attempt. Of a group only the newest batch's count, and none
    if a newer one has been sent."""
    rows = changelog.read_changes(spark, f"{target}/queue", QUEUE, batches, at)
    failed, named = F.col("op") == "failed", F.col("grouped").isNotNull()
    newest = rows.filter(named).groupBy("grouped").agg(F.max("seq").alias("_newest"))
    kept = rows.filter(failed & named).join(newest, "grouped").filter(
        F.col("_newest").isNull() | (F.col("seq") == F.col("_newest"))
    )
    # Messages of no group meet no others: a join would bring them all to one task.
    alone = rows.filter(failed & ~named)
    return alone.unionByName(kept.select(QUEUE.fieldNames()))


def _after(now, seconds):
    return F.timestamp_micros((F.unix_micros(now) + F.round(seconds * 1_000_000)).cast("long"))


def _enqueue(outcome, target, redelivery, batch_id, writer) -> None:
    """A batch's failures join the queue; what it sent overtakes older messages of its group."""
    spark = outcome.sparkSession
    failed = outcome.filter(F.col("error").isNotNull()).select(
        F.lit("failed").alias("op"), "message", "grouped", "place", "attempts", "error",
        _after(F.current_timestamp(), F.lit(redelivery.pause)).alias("due_at"),
        F.lit(batch_id).cast("long").alias("seq"),
    )
    waiting = queued(spark, target).select("grouped").filter(F.col("grouped").isNotNull()).distinct()
    sent = outcome.filter(F.col("error").isNull()).select("grouped").join(waiting, "grouped", "left_semi").distinct()
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in QUEUE.fields if f.name not in ("op", "grouped", "seq")]
    sent = sent.select(
        F.lit("sent").alias("op"), "grouped", F.lit(batch_id).cast("long").alias("seq"), *none
    ).select(QUEUE.fieldNames())
    changelog.write_batch(failed.unionByName(sent), f"{target}/queue", batch_id, writer)


def redeliver(
    spark: SparkSession,
    target: str,
    transport: Transport,
    redelivery: Redelivery = Redelivery(),
    now=None,
    service: str = "forward",
    keep: int = 2,
) -> None:
    """Send what is due in the queue at ``target`` once more (``now``: a timestamp, by default the
    time of the call).

    What fails again waits longer, or becomes a dead letter at the limit; what is not due stays.
    The outcome is written before the queue moves on, and moving on is refused if somebody else
    did meanwhile: delivery is at least once. Parts of a group are sent in order by one task, and
    not after one that failed.
    """
    path = f"{target}/queue"
    before = changelog.manifest(spark, path)
    batches = changelog.finished_batches(spark, path, before)
    if not batches and not before.parts:
        return
    moment = spark.range(1).select(F.current_timestamp().alias("t")).first()["t"] if now is None else now
    at = F.lit(moment).cast("timestamp")
    waiting = queued(spark, target, before, batches).drop("op")
    due = waiting.filter(F.col("due_at") <= at).withColumnsRenamed({"attempts": "made", "error": "was"})
    single, grouped = due.filter(F.col("grouped").isNull()), due.filter(F.col("grouped").isNotNull())
    tried = with_retry(single, transport, "message", 0).unionByName(
        with_retry(grouped, transport, "message", 0, 0.0, "grouped", "place")
    )
    folder = f"{target}/redelivered/{changelog.new_base(before)}"
    tried.write.parquet(folder)
    tried = spark.read.schema(tried.schema).parquet(folder).withColumn("attempts", F.col("made") + F.col("attempts"))
    failed = tried.filter(F.col("error").isNotNull())
    over = F.col("attempts") > redelivery.limit
    number = before.generation + 1
    write_dead_letters(dead_letters(failed.filter(over), service), f"{target}/dead", number, "redelivery")
    pause = F.lit(redelivery.pause) * F.pow(F.lit(redelivery.factor), F.greatest(F.col("attempts") - 1, F.lit(0)))
    again = failed.filter(~over).withColumn("due_at", _after(at, pause))
    names = QUEUE.fieldNames()[1:]
    left = waiting.filter(F.col("due_at") > at).select(names).unionByName(again.select(names))
    rows = left.select(F.lit("failed").alias("op"), *names)
    changelog.rebase(spark, path, rows, batches, before)
    changelog.expire(spark, path, keep)


def redelivered(spark: SparkSession, target: str) -> DataFrame:
    """(message, attempts, error) of all later attempts so far."""
    rows = spark.read.schema("message string, made int, attempts int, error string").option("recursiveFileLookup", "true")
    return rows.parquet(f"{target}/redelivered").select(
        "message", (F.col("made") + F.col("attempts")).alias("attempts"), "error"
    )


def forward(
    messages: DataFrame,
    target: str,
    transport: Transport | None = None,
    endpoint: str | None = None,
    max_redeliveries: int = 10,
    delay: float = 0.0,
    batch_id: int = 0,
    writer: str = "main",
    service: str = "forward",
    group: str | None = None,
    order: str | None = None,
    redelivery: Redelivery | None = None,
) -> None:
    """Deliver the ``message`` column of a batch.

    With a transport each message is sent and its outcome kept under ``target/outcome``; with
    ``redelivery`` it is tried once and what fails waits in the queue for ``redeliver``.
    Without one, messages are appended as JSON lines to the folder ``endpoint``. With neither
    nothing is sent and every message becomes a dead letter under ``target/dead``.
    """
    here = f"writer={writer}/batch={batch_id}"
    rows = messages.select("message")
    if transport is not None:
        sent_rows = messages.select(
            "message",
            (F.col(group) if group else F.lit(None)).cast("string").alias("grouped"),
            (F.col(order) if order else F.lit(None)).cast("int").alias("place"),
        )
        outcome = with_retry(
            sent_rows, transport, "message", 0 if redelivery else max_redeliveries, delay,
            "grouped" if group else None, "place" if group else None,
        )
        outcome.write.mode("overwrite").parquet(f"{target}/outcome/{here}")
        sent = messages.sparkSession.read.schema(outcome.schema).parquet(f"{target}/outcome/{here}")
        if redelivery is not None:
            _enqueue(sent, target, redelivery, batch_id, writer)
            return
        letters = dead_letters(sent, service)
    elif endpoint:
        rows.write.mode("overwrite").text(f"{endpoint}/{here}")
        return
    else:
        unsent = rows.withColumns(
            {"attempts": F.lit(0), "error": F.lit(vocab.NO_ENDPOINT)}
        )
        letters = dead_letters(unsent, service)
    write_dead_letters(letters, f"{target}/dead", batch_id, writer)


def fixity_sinks(
    results: DataFrame,
    failures: str,
    on_success=None,
    on_failure=None,
    batch_id: int = 0,
    writer: str = "main",
) -> None:
    """Send results to the success sink (none by default) and the failure sink.

    Sinks are functions of (frame, batch id). By default failures go to a JSON-lines log.
    """
    from eventloom.operators.fixity import split_fixity

    good, bad = split_fixity(results)
    if on_success is not None:
        on_success(good, batch_id)
    if on_failure is not None:
        on_failure(bad, batch_id)
    else:
        bad.write.mode("overwrite").json(f"{failures}/writer={writer}/batch={batch_id}")
