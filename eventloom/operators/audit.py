"""Audit records: every change event becomes a small graph of its own."""

from pyspark.sql import DataFrame, Window, functions as F

from eventloom import vocab
from eventloom.functions import triple_line
from eventloom.operators.events import (
    exclude_containers,
    with_audit_event_type,
    with_audit_event_uri,
)
from eventloom.schemas import TRIPLE_KEY


def _with_record(events: DataFrame, base_uri: str) -> DataFrame:
    """Add the record as a list of triples. A record is a set, so agents are made distinct
    within the row and no shuffle is needed."""

    def entry(predicate, value, kind, datatype=None):
        value = F.lit(value) if isinstance(value, str) else value
        return F.struct(
            F.lit(predicate).alias("predicate"),
            value.alias("object"),
            F.lit(kind).alias("object_kind"),
            F.lit(datatype).cast("string").alias("datatype"),
        )

    fixed = [entry(vocab.RDF_TYPE, c, "uri") for c in vocab.AUDIT_CLASSES]
    fixed.append(
        entry(vocab.EVENT_DATE_TIME, F.col("date_time"), "literal", vocab.XSD_DATETIME)
    )
    fixed.append(entry(vocab.EVENT_OBJECT, F.col("uri"), "uri"))
    agents = F.transform(
        F.array_distinct("agents"),
        lambda a: entry(vocab.EVENT_AGENT, a, "literal", vocab.XSD_STRING),
    )
    typed = entry(vocab.EVENT_TYPE, F.col("audit_event_type"), "uri")
    kind = F.filter(F.array(typed), lambda t: t["object"].isNotNull())
    rows = with_audit_event_uri(with_audit_event_type(events), base_uri)
    return rows.withColumn("record", F.concat(F.array(*fixed), agents, kind))


def audit_triples(events: DataFrame, base_uri: str) -> DataFrame:
    """One row per triple of each event's audit record. Events without an id give none."""
    return _record_triples(_with_record(events.filter(F.col("event_id").isNotNull()), base_uri))


def _record_triples(record: DataFrame) -> DataFrame:
    missing = F.lit(None).cast("string")
    # The outer form, as no record is empty: the plain one would first test each record's
    # size and so build it twice.
    return record.select(
        "event_uri", F.posexplode_outer("record").alias("ord", "t")
    ).select(
        missing.alias("graph"),
        F.col("event_uri").alias("subject"),
        "t.predicate",
        "t.object",
        "t.object_kind",
        "t.datatype",
        missing.alias("lang"),
        F.col("event_uri").alias("doc"),
        F.col("ord").cast("long").alias("ord"),
    )


#: What a record is made of.
_SOURCE = ("event_id", "uri", "date_time", "event_types", "resource_types", "agents")


def audited_once(events: DataFrame, base_uri: str) -> DataFrame:
    """What the records of events are made of, once each, dealt by the record's subject: an event
    is some hundred bytes, its record many triples. ``versions`` counts a subject's rows."""
    rows = with_audit_event_uri(events.filter(F.col("event_id").isNotNull()), base_uri).select("event_uri", *_SOURCE)
    # Both aggregates find their rows dealt: there is one shuffle.
    once = rows.repartition("event_uri").distinct()
    return once.withColumn("versions", F.count(F.lit(1)).over(Window.partitionBy("event_uri")))


def audit_set(once: DataFrame, base_uri: str) -> DataFrame:
    """The triples of ``audited_once`` as a set. Only subjects of several versions can repeat a
    triple; of the others none is moved or compared."""

    def triples(rows):
        return _record_triples(_with_record(rows, base_uri)).select(*TRIPLE_KEY)

    # Kept rows are asked first: an empty branch would have the other one worked out twice.
    if once.filter(F.col("versions") > 1).isEmpty():
        return triples(once)
    own = triples(once.filter(F.col("versions") == 1))
    return own.unionByName(triples(once.filter(F.col("versions") > 1)).distinct())


def audit_insert_statement(events: DataFrame, base_uri: str) -> DataFrame:
    """One insert statement per event, lines in text order; built within the row."""
    record = _with_record(events.filter(F.col("event_id").isNotNull()), base_uri)
    lines = F.transform(
        "record",
        lambda t: triple_line(
            "event_uri",
            t["predicate"],
            t["object"],
            t["object_kind"],
            t["datatype"],
            F.lit(None).cast("string"),
        ),
    )
    body = F.array_join(F.array_sort(lines), "\n")
    return record.select(
        "event_uri", F.concat(F.lit("INSERT DATA { "), body, F.lit("\n}")).alias("statement")
    )


def audit_input(events: DataFrame, containers=()) -> DataFrame:
    """Events that get audited: the exclusion list holds for deletions too."""
    return exclude_containers(events, containers)


def unaudited_events(events: DataFrame, service: str = "audit") -> DataFrame:
    """Events without an id: they cannot be given a record and become dead letters."""
    return events.filter(F.col("event_id").isNull()).select(
        F.to_json(F.struct("uri", "date_time", "event_types")).alias("payload"),
        F.lit(service).alias("service"),
        F.lit(1).alias("attempts"),
        F.lit("event without id").alias("error"),
        F.current_timestamp().alias("failed_at"),
    )
