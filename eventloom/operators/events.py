"""Row-wise operators on change events; every one works on batch and streaming frames."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from eventloom import vocab
from eventloom.functions import as_col, blank_to, has_any, path_prefixes, strip, under


def canonicalise(df: DataFrame) -> DataFrame:
    """Fill what a message may lack: empty text, empty lists. A missing id stays missing."""
    none = F.array().cast("array<string>")
    return df.withColumns(
        {c: F.coalesce(F.col(c), F.lit("")) for c in ("uri", "date_time")}
        | {c: F.coalesce(F.col(c), none) for c in ("event_types", "resource_types", "agents")}
    )


def with_change_kind(df: DataFrame) -> DataFrame:
    """``delete`` as soon as a deletion is among the event types, else ``index``."""
    gone = has_any("event_types", vocab.DELETE)
    return df.withColumn("change_kind", F.when(gone, "delete").otherwise("index"))


def split_deletes(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(deletions, everything else); every row is in exactly one of them."""
    gone = has_any("event_types", vocab.DELETE)
    return df.filter(gone), df.filter(~gone)


def listed(containers) -> list[str]:
    """Container list from a comma-separated option or a Python list, blanks dropped."""
    if isinstance(containers, str):
        containers = containers.split(",")
    return [c.strip() for c in containers or () if c.strip()]


def exclude_containers(df: DataFrame, containers, uri: str = "uri") -> DataFrame:
    """Drop rows whose uri is one of the containers or lies below one.

    A list becomes a plain predicate that reaches the scan. A table of containers (any
    length, batch only) becomes an equi-join on the path prefixes of the distinct uris.
    """
    if isinstance(containers, DataFrame):
        return _exclude_by_table(df, containers, uri)
    tests = [under(uri, c) for c in listed(containers)]
    if not tests:
        return df
    return df.filter(as_col(uri).isNull() | ~reduce(lambda a, b: a | b, tests))


def _exclude_by_table(df: DataFrame, containers: DataFrame, uri: str) -> DataFrame:
    name = F.col(containers.columns[0])
    wanted = containers.select(strip(name).alias("_prefix")).filter(F.col("_prefix") != "")
    prefixes = (
        df.select(uri)
        .distinct()
        .select(uri, F.explode_outer(path_prefixes(F.col(uri))).alias("_prefix"))
    )
    # The upper prefixes are shared by all uris: adaptive execution splits them in the join.
    found = prefixes.join(wanted.distinct(), "_prefix", "left_semi")
    return df.join(found.select(uri).distinct(), uri, "left_anti")


def indexable_by_event(df: DataFrame) -> DataFrame:
    """Keep events whose own resource types mark the resource as indexable."""
    return df.filter(has_any("resource_types", [vocab.INDEXABLE]))


def with_audit_event_type(df: DataFrame) -> DataFrame:
    """Preservation event type: creation before deletion before update, else null."""
    binary = has_any("resource_types", [vocab.BINARY])
    kinds = (("create", vocab.CREATE), ("delete", vocab.DELETE), ("update", vocab.UPDATE))
    column = F.lit(None).cast("string")
    for kind, types in reversed(kinds):
        found = F.when(binary, vocab.AUDIT_TYPE[kind, True]).otherwise(
            vocab.AUDIT_TYPE[kind, False]
        )
        column = F.when(has_any("event_types", types), found).otherwise(column)
    return df.withColumn("audit_event_type", column)


def with_audit_event_uri(df: DataFrame, base_uri: str) -> DataFrame:
    """Subject of the audit record; null without an event id (such rows are dead letters)."""
    return df.withColumn("event_uri", F.concat(F.lit(base_uri + "/"), F.col("event_id")))


def with_forward_type(df: DataFrame) -> DataFrame:
    """Type to pass on: the raw header if there is one, otherwise an update."""
    return df.withColumn("forward_type", blank_to("jms_event_type", vocab.UPDATE[1]))


def resource_uri(df: DataFrame, base_url: str) -> DataFrame:
    """Uri of a requested path."""
    return df.withColumn("uri", F.concat(F.lit(base_url), F.col("path")))


def merge_live_and_hints(events: DataFrame, hints: DataFrame) -> DataFrame:
    """One input of live events and re-index hints; a hint has nothing but its uri.

    ``from_hint`` tells the two apart. A hint may bring an arrival time in ``ts``.
    """
    extra = [c for c in hints.columns if c not in events.columns]
    return (
        events.withColumn("from_hint", F.lit(False))
        .unionByName(
            hints.drop(*extra).withColumn("from_hint", F.lit(True)), allowMissingColumns=True
        )
    )
