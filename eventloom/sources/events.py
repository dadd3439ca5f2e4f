"""Change events, re-index hints and re-index requests."""

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from eventloom import schemas
from eventloom.functions import as_col, event_time, is_blank, with_value
from eventloom.operators.events import canonicalise

_CORRUPT = "_corrupt_record"


def _body_schema() -> T.StructType:
    """Both event forms in one schema, so that a body is parsed once."""
    fields = {f.name: f for f in schemas.LEGACY_BODY.fields}
    fields.update({f.name: f for f in schemas.ACTIVITY_BODY.fields})
    return T.StructType([*fields.values(), T.StructField(_CORRUPT, T.StringType())])


def _parsed(df: DataFrame, body: str) -> DataFrame:
    options = {"columnNameOfCorruptRecord": _CORRUPT, "mode": "PERMISSIVE"}
    return with_value(df, "_event", F.from_json(as_col(body), _body_schema(), options))


def _unusable():
    """No event: nothing could be read, or no resource is named."""
    event = F.col("_event")
    legacy = event["wasGeneratedBy"].isNotNull() & event["object"].isNull()
    uri = F.when(legacy, event["id"]).otherwise(event["object"]["id"])
    return event.isNull() | is_blank(F.coalesce(uri, F.lit("")))


def _types(parsed, body, path):
    """A type list; a single type may be written as a plain string, which the schema misses."""
    single = F.when(F.col("_event")[_CORRUPT].isNotNull(), F.get_json_object(body, path))
    return F.coalesce(parsed, F.when(single.isNotNull(), F.array(single)))


def parse_events(
    df: DataFrame, body: str = "value", jms_event_type=None, rejects: bool = False
) -> DataFrame:
    """Parse JSON bodies, current or legacy form, into canonical events.

    Works on batch and streaming frames. A body without an event, or whose event names no
    resource, is left to ``malformed_events``; with ``rejects`` it stays as a row of its own
    with the body in ``reject``, which is null for events, so that one parse gives both.
    ``jms_event_type`` is an optional column with the raw type header.
    """
    raw_type = (
        F.lit(None).cast("string") if jms_event_type is None else as_col(jms_event_type)
    )
    bad = F.coalesce(_unusable(), F.lit(True))
    rows = _parsed(df, body).withColumn("_raw_type", raw_type)
    rows = rows.filter(~bad | (F.lit(rejects) & ~F.coalesce(is_blank(body), F.lit(True))))
    reject = [F.when(bad, as_col(body)).alias("reject")] if rejects else []
    event = F.col("_event")
    legacy = event["wasGeneratedBy"].isNotNull() & event["object"].isNull()

    def pick(old, new):
        return F.when(legacy, old).otherwise(new)

    people = F.transform(event["actor"], lambda a: F.coalesce(a["id"], a["name"]))
    old_people = F.transform(event["wasAttributedTo"], lambda a: a["name"])
    agents = F.filter(pick(old_people, people), lambda a: a.isNotNull())
    text = as_col(body)
    top_types = _types(event["type"], text, "$.type")
    date = pick(event["wasGeneratedBy"]["atTime"], event["published"])
    return canonicalise(
        rows.select(
            pick(event["wasGeneratedBy"]["identifier"], event["id"]).alias("event_id"),
            pick(event["id"], event["object"]["id"]).alias("uri"),
            date.alias("date_time"),
            event_time(date).alias("ts"),
            pick(
                _types(event["wasGeneratedBy"]["type"], text, "$.wasGeneratedBy.type"), top_types
            ).alias("event_types"),
            pick(
                top_types, _types(event["object"]["type"], text, "$.object.type")
            ).alias("resource_types"),
            agents.alias("agents"),
            F.col("_raw_type").alias("jms_event_type"),
            pick(event["isPartOf"], event["object"]["isPartOf"]).alias("is_part_of"),
            *reject,
        )
    )


def malformed_events(df: DataFrame, body: str = "value", service: str = "events") -> DataFrame:
    """The bodies ``parse_events`` cannot read, as dead letters."""
    return (
        _parsed(df, body)
        .filter(F.coalesce(_unusable(), F.lit(True)) & ~is_blank(body))
        .select(
            as_col(body).alias("payload"),
            F.lit(service).alias("service"),
            F.lit(1).alias("attempts"),
            F.lit("unreadable event").alias("error"),
            F.current_timestamp().alias("failed_at"),
        )
    )


def _reader(spark: SparkSession, streaming: bool, options: dict):
    source = spark.readStream if streaming else spark.read
    return source.options(**options)


def read_events(
    spark: SparkSession,
    path: str,
    streaming: bool = False,
    one_per_file: bool = False,
    rejects: bool = False,
    **options,
) -> DataFrame:
    """Read events from text files: one JSON object per line, or one (pretty-printed) per file.

    With ``rejects`` unreadable bodies come along (see ``parse_events``). Extra options go to the file source, e.g. ``maxFilesPerTrigger`` as a throttle.
    """
    text = _reader(spark, streaming, options).text(path, wholetext=one_per_file)
    return parse_events(text, rejects=rejects)


def read_legacy_events(spark: SparkSession, path: str, **kwargs) -> DataFrame:
    """Legacy events are recognised by their shape; kept as a name of its own for callers."""
    return read_events(spark, path, **kwargs)


def read_hints(
    spark: SparkSession, path: str, streaming: bool = False, **options
) -> DataFrame:
    """Re-index hints: JSON lines with a uri, and recipients while a walk is under way."""
    return _reader(spark, streaming, options).schema(schemas.HINT).json(path)


def read_reindex_requests(
    spark: SparkSession, path: str, streaming: bool = False, **options
) -> DataFrame:
    """Re-index requests as JSON lines."""
    return _reader(spark, streaming, options).schema(schemas.REINDEX_REQUEST).json(path)
