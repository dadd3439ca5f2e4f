"""The containment hierarchy kept current by changes, so that a walk never waits for a reload.

The edge table is an index of containment triples: a log of purges and additions by parent over a
base that lies by bucket of the parent, with the manifests, compaction and expiry of the triple
index. A batch writes what its resources contain now; nothing else is read or rewritten.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventloom import vocab
from eventloom.operators.triples import containment_edges
from eventloom.streaming import state


def edge_changes(actions: DataFrame, triples: DataFrame, batch_id: int = 0) -> DataFrame:
    """Actions as log rows: ``purge`` of a parent's edges, ``add`` of an edge it has now.

    An updated resource loses the edges it had and gets those its description holds; a deleted one
    loses them. Descriptions are taken as they are, whatever an indexer is told to leave out, and
    an edge that another resource's description states is only ever added.
    """
    changes = state.triple_changes(actions, triples, batch_id=batch_id)
    contained = (F.col("predicate") == vocab.CONTAINS) & (F.col("object_kind") == "uri")
    return changes.filter((F.col("op") == "purge") | contained)


def maintain_edges(
    actions: DataFrame, triples: DataFrame, target: str, batch_id: int = 0, writer: str = "main"
) -> None:
    """Apply one batch of actions to the edge table at ``target``."""
    changes = edge_changes(actions, triples, batch_id)
    state.write_slotted(changes, "subject", target, batch_id, writer)


def load_edges(edges: DataFrame, target: str, buckets: int = state.BUCKETS) -> None:
    """Start an edge table from (parent, child); any action is later than these."""
    none = [F.lit(None).cast("string").alias(c) for c in ("graph", "datatype", "lang")]
    rows = edges.filter(F.col("child").isNotNull() & F.col("parent").isNotNull()).select(
        F.col("parent").alias("subject"), F.lit(vocab.CONTAINS).alias("predicate"),
        F.col("child").alias("object"), F.lit("uri").alias("object_kind"), *none,
    )
    state.load_triples(rows, target, buckets)


def current_edges(spark: SparkSession, target: str, parents: DataFrame | None = None, at=None) -> DataFrame:
    """(parent, child) as things stand; with ``parents`` (one column) only of these, read from the
    buckets they can be in."""
    return containment_edges(state.current_triples(spark, target, parents, at))


def edges_of(spark: SparkSession, target: str) -> Callable[[DataFrame], DataFrame]:
    """The edge table as a function of asked-for parents, as the walk and the services take it."""
    return lambda parents: current_edges(spark, target, parents)


def compact_edges(spark: SparkSession, target: str, buckets: int = state.BUCKETS, keep: int = 2) -> None:
    """Fold the log into the buckets that it touches."""
    state.compact_triples(spark, target, buckets, keep)
