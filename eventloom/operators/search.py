"""Search documents: built from descriptions, rendered as update commands."""

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from eventloom import vocab
from eventloom.functions import escape_xml

DEFAULT_TRANSFORM = "default"
Transform = Callable[[DataFrame], DataFrame]


def default_search_doc(triples: DataFrame) -> DataFrame:
    """One search document per described resource.

    ``id`` is the first subject; ``rdftype`` every type in document order; the others are the
    first value found, empty if there is none. First values are combined map-side, so a
    document with very many members is no hot spot; only its types are gathered.
    """
    position = F.coalesce("ord", F.lit(0))

    def is_a(predicate):
        return F.col("predicate") == predicate

    def first(column):
        return F.min_by(column, F.when(F.col(column).isNotNull(), F.struct("_position", column)))

    linked = F.col("object_kind") == "uri"
    types = F.struct(position.alias("ord"), F.col("object").alias("object"))
    value = F.col("object")
    # Narrow rows first: the aggregate sorts them, map-side too.
    rows = triples.select(
        "doc",
        "subject",
        position.alias("_position"),
        F.when(is_a(vocab.RDF_TYPE) & linked, types).alias("_type"),
        F.when(is_a(vocab.CONTAINS) & linked, value).alias("_contains"),
        F.when(is_a(vocab.LAST_MODIFIED) & ~linked, value).alias("_modified"),
        F.when(is_a(vocab.CREATED) & ~linked, value).alias("_created"),
    )
    empty = F.lit("")
    docs = rows.groupBy("doc").agg(
        F.min_by("subject", F.struct("_position", "subject")).alias("id"),
        F.array_sort(F.collect_list("_type")).alias("types"),
        first("_contains").alias("contains"),
        first("_modified").alias("lastmodified"),
        first("_created").alias("created"),
    )
    return docs.select(
        "doc",
        "id",
        F.transform("types", lambda t: t["object"]).alias("rdftype"),
        *[F.coalesce(c, empty).alias(c) for c in ("contains", "lastmodified", "created")],
    )


def search_add_command(docs: DataFrame) -> DataFrame:
    """XML add command of each document; one field element per type."""

    def field(name, value):
        return F.concat(F.lit(f'<field name="{name}">'), escape_xml(value), F.lit("</field>"))

    types = F.array_join(F.transform("rdftype", lambda t: field("rdftype", t)), "")
    single = [field(c, F.col(c)) for c in ("contains", "lastmodified", "created")]
    command = F.concat(
        F.lit("<add><doc>"), field("id", F.col("id")), types, *single, F.lit("</doc></add>")
    )
    return docs.withColumn("command", command)


def search_delete_command(df: DataFrame, uri: str = "uri") -> DataFrame:
    """JSON delete command of each uri."""
    inner = F.struct(F.col(uri).alias("id"))
    return df.withColumn("command", F.to_json(F.struct(inner.alias("delete"))))


def apply_transforms(
    updates: DataFrame,
    triples: DataFrame,
    registry: Mapping[str, Transform | Mapping[str, Column]] | None = None,
) -> DataFrame:
    """Build each resource's search document with the transform it names.

    ``updates`` is (uri, transformation), a uri once. ``registry`` maps a name to what changes
    in the default document, as columns by name, or to a function from triples to documents
    with the columns of ``default_search_doc``; the default is always there. All transforms of
    the first kind share one join and one aggregate; a function has a branch of its own.
    """
    registry = {DEFAULT_TRANSFORM: {}, **(registry or {})}
    wanted = updates.select(F.col("uri").alias("doc"), "transformation")
    columns = {n: c for n, c in registry.items() if not callable(c)}
    named = wanted.filter(F.col("transformation").isin(sorted(columns)))
    result = default_search_doc(triples.join(named.select("doc"), "doc", "left_semi"))
    result = result.join(named, "doc")
    for field in ("id", "rdftype", "contains", "lastmodified", "created"):
        value = F.col(field)
        for name, changes in columns.items():
            if field in changes:
                value = F.when(F.col("transformation") == name, changes[field]).otherwise(value)
        result = result.withColumn(field, value)
    result = result.select(
        "doc", "id", "rdftype", "contains", "lastmodified", "created", "transformation"
    )
    for name, build in registry.items():
        if callable(build):
            own = wanted.filter(F.col("transformation") == name).select("doc")
            part = build(triples.join(own, "doc", "left_semi"))
            part = part.select("doc", "id", "rdftype", "contains", "lastmodified", "created")
            result = result.unionByName(part.withColumn("transformation", F.lit(name)))
    return result


def unknown_transforms(updates: DataFrame, registry, service: str = "search") -> DataFrame:
    """Updates that name a transform nobody registered, as dead letters."""
    known = sorted({DEFAULT_TRANSFORM, *(registry or {})})
    return updates.filter(~F.col("transformation").isin(known)).select(
        F.to_json(F.struct("uri", "transformation")).alias("payload"),
        F.lit(service).alias("service"),
        F.lit(1).alias("attempts"),
        F.lit("unknown transformation").alias("error"),
        F.current_timestamp().alias("failed_at"),
    )
