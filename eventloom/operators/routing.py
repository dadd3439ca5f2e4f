"""Per-resource decisions: update, delete, or nothing to look at."""

from pyspark.sql import DataFrame, functions as F

from eventloom import vocab
from eventloom.functions import NUMBER, blank_to, has_any, join_numbered, number
from eventloom.operators.events import exclude_containers, merge_live_and_hints, split_deletes

UPDATE, DELETE, MISSING = "update", "delete", "missing"


def _type_is(wanted):
    return (
        (F.col("predicate") == vocab.RDF_TYPE)
        & (F.col("object_kind") == "uri")
        & (F.col("object") == wanted)
    )


def indexable_uris(triples: DataFrame) -> DataFrame:
    """Documents with an indexable node in them."""
    return triples.filter(_type_is(vocab.INDEXABLE)).select(F.col("doc").alias("uri")).distinct()


def indexable_by_rdf(df: DataFrame, triples: DataFrame) -> DataFrame:
    """Keep rows whose description marks the resource as indexable."""
    return df.join(indexable_uris(triples), "uri", "left_semi")


def first_transformation():
    """First transformation link in document order (an aggregate over ``_fact_rows``)."""
    order = F.struct(F.coalesce("ord", F.lit(0)), F.col("_link"))
    return F.min_by("_link", F.when(F.col("_link").isNotNull(), order))


def _fact_rows(triples: DataFrame) -> DataFrame:
    """(uri, ord, _indexable, _binary, _link): what the facts are folded from. Most rows hold no
    fact and are then little more than their uri; they are sorted to be folded, map-side too."""
    link = (F.col("predicate") == vocab.HAS_TRANSFORMATION) & (F.col("object_kind") == "uri")
    return triples.select(
        F.col("doc").alias("uri"),
        _type_is(vocab.INDEXABLE).alias("_indexable"),
        ((F.col("predicate") == vocab.RDF_TYPE) & (F.col("object") == vocab.BINARY)).alias("_binary"),
        F.when(link, F.col("object")).alias("_link"),
        F.when(link, F.col("ord")).alias("ord"),
    )


def resource_facts(triples: DataFrame) -> DataFrame:
    """What the decisions need to know of each described resource, one row per document.

    A single aggregate with map-side combine; only five columns of the table are read.
    """
    return _fact_rows(triples).groupBy(number("uri"), "uri").agg(
        F.max("_indexable").alias("rdf_indexable"),
        first_transformation().alias("own_transformation"),
    ).drop(NUMBER)


def known_facts(triples: DataFrame) -> DataFrame:
    """The same and whether it is a binary, as an index of facts keeps it (see ``schemas.FACTS``)."""
    return _fact_rows(triples).groupBy(number("uri"), "uri").agg(
        F.max("_indexable").alias("rdf_indexable"),
        first_transformation().alias("own_transformation"),
        F.max("_binary").alias("is_binary"),
    ).drop(NUMBER)


def with_transformation(resources: DataFrame, default: str) -> DataFrame:
    """Transformation to use for each resource: its own, or the default."""
    return resources.withColumn("transformation", blank_to("own_transformation", default))


def not_self_transform(df: DataFrame) -> DataFrame:
    """A resource that is its own transformation is left alone."""
    return df.filter(F.col("transformation") != F.col("uri"))


def has_transformation(df: DataFrame) -> DataFrame:
    """Without a transformation there is neither an update nor a delete."""
    return df.filter(F.coalesce("transformation", F.lit("")) != "")


def applicable(actions: DataFrame) -> DataFrame:
    """Search actions that do something: deletes, and updates that are not skipped."""
    deletes = actions.filter(F.col("action") == DELETE)
    updates = actions.filter(F.col("action") == UPDATE)
    return deletes.unionByName(not_self_transform(has_transformation(updates)))


_IDENTITY = ("event_id", "uri", "ts")


def _inputs(events, hints, containers):
    """(deletions before any exclusion, the rest after it)."""
    deletes, others = split_deletes(events)
    if hints is None:
        others = others.withColumn("from_hint", F.lit(False))
    else:
        others = merge_live_and_hints(others, hints)
    deletes = deletes.select(*_IDENTITY)
    return deletes, exclude_containers(others, containers)


def triplestore_actions(
    events: DataFrame,
    hints: DataFrame | None,
    triples: DataFrame,
    require_indexable: bool = False,
    containers=(),
    facts: DataFrame | None = None,
) -> DataFrame:
    """(event_id, uri, ts, action) for the triple index.

    Deletions pass before the exclusion list. With ``require_indexable`` off nothing is
    looked up. With it on, a resource that is not described at all cannot be judged: its
    action is ``missing`` and belongs to the dead letters. With ``facts`` (see
    ``state.current_facts``) these are looked up and no triples are read.
    """
    deletes, others = _inputs(events, hints, containers)
    deleted = deletes.withColumn("action", F.lit(DELETE))
    others = others.select(*_IDENTITY)
    if not require_indexable:
        return deleted.unionByName(others.withColumn("action", F.lit(UPDATE)))
    if facts is None:
        facts = triples.groupBy(F.col("doc").alias("uri")).agg(
            F.max(_type_is(vocab.INDEXABLE)).alias("rdf_indexable")
        )
    decided = join_numbered(others, facts, "uri", "left").select(
        *_IDENTITY,
        F.when(F.col("rdf_indexable").isNull(), MISSING)
        .when(F.col("rdf_indexable"), UPDATE)
        .otherwise(DELETE)
        .alias("action"),
    )
    return deleted.unionByName(decided)


def search_actions(
    events: DataFrame,
    hints: DataFrame | None,
    triples: DataFrame,
    default_transform: str,
    require_indexable: bool = False,
    check_transformation: bool = True,
    containers=(),
    facts: DataFrame | None = None,
) -> DataFrame:
    """(event_id, uri, ts, action, transformation) for the search index.

    Events are judged by their own resource types; hints carry none and are judged by the
    description. Only if neither option asks for it is the look-up skipped. With ``facts`` these
    are looked up and no triples are read.
    """
    deletes, others = _inputs(events, hints, containers)
    deleted = deletes.select(
        *_IDENTITY, F.lit(DELETE).alias("action"), F.lit(None).cast("string").alias("transformation")
    )
    if not require_indexable and not check_transformation:
        return deleted.unionByName(
            others.select(
                *_IDENTITY,
                F.lit(UPDATE).alias("action"),
                F.lit(default_transform).alias("transformation"),
            )
        )
    others = others.select(
        *_IDENTITY,
        "from_hint",
        has_any("resource_types", [vocab.INDEXABLE]).alias("event_indexable"),
    )
    joined = join_numbered(others, resource_facts(triples) if facts is None else facts, "uri", "left")
    wanted = (
        F.when(F.col("from_hint"), F.col("rdf_indexable")).otherwise(F.col("event_indexable"))
        if require_indexable
        else F.lit(True)
    )
    known = F.col("rdf_indexable").isNotNull()
    decided = with_transformation(joined, default_transform).select(
        *_IDENTITY,
        F.when(~known, MISSING).when(wanted, UPDATE).otherwise(DELETE).alias("action"),
        F.when(known, F.col("transformation")).alias("transformation"),
    )
    return deleted.unionByName(decided)


def sequence(arrival=None):
    """Order of actions on one uri: event time, then event id.

    An undated action counts from ``arrival`` (a time), as it would in a queue; without one it
    comes first.
    """
    ts = F.col("ts") if arrival is None else F.coalesce(F.col("ts"), F.lit(arrival).cast("timestamp"))
    return F.struct(ts.alias("ts"), F.col("event_id").alias("event_id"))


def latest_per_uri(actions: DataFrame, arrival=None) -> DataFrame:
    """The last action of each uri; combined map-side, so a busy uri costs no more."""
    rest = [c for c in actions.columns if c != "uri"]
    return (
        actions.groupBy("uri")
        .agg(F.max_by(F.struct(*rest), sequence(arrival)).alias("_last"))
        .select("uri", *[F.col("_last")[c].alias(c) for c in rest])
    )


def enrich_with_resource(actions: DataFrame, triples: DataFrame) -> DataFrame:
    """Current description of each acted-on uri: the triples of its document.

    ``actions`` holds a uri once (see ``latest_per_uri``). The triple side is the large one
    and may be dominated by one document, which adaptive execution splits.
    """
    wanted = actions.withColumnRenamed("uri", "doc")
    return triples.join(wanted, "doc", "inner").withColumn("uri", F.col("doc"))


def missing_resources(actions: DataFrame, triples: DataFrame, service: str) -> DataFrame:
    """Actions whose resource has no description, as dead letters; a uri is given once."""
    described = triples.select(F.col("doc").alias("uri")).distinct()
    return join_numbered(actions, described, "uri", "left_anti").select(
        F.to_json(F.struct("uri")).alias("payload"),
        F.lit(service).alias("service"),
        F.lit(1).alias("attempts"),
        F.lit("resource not found").alias("error"),
        F.current_timestamp().alias("failed_at"),
    )
