"""Near-duplicate vectors: spherical k-means cells, blocked cosine products inside them."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.blocks import group_starts, merge, whole_groups
from eventloom.llm.common import components, stored, table

COSINE = 0.93
#: Vectors of one label a cell should hold, the most cells (they travel with tasks), vectors
#: that k-means is fitted on at most (smallest hash first), its rounds, and vectors in a block.
CELL, MAX_CELLS, FIT_ROWS, ROUNDS, BLOCK = 2_048, 512, 100_000, 4, 1_024


def matrix(column, dim: int) -> np.ndarray:
    """Unit rows in double precision from an Arrow list column; shorter vectors end in zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(lengths), dim))
    rows = np.repeat(np.arange(len(lengths)), lengths)
    within = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[rows, within] = flat
    out /= np.abs(out).max(axis=1, keepdims=True)
    return out / np.sqrt((out * out).sum(axis=1, keepdims=True))


def distinct_vectors(vectors: DataFrame) -> DataFrame:
    """(c, label, embedding, least, n): usable vectors without copies, with their number."""
    sound = (
        F.col("label").isNotNull()
        & (F.size("embedding") > 0)
        & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("embedding", lambda x: x != 0)
    )
    groups = (
        vectors.where(F.coalesce(sound, F.lit(False)))
        .groupBy("label", "embedding")
        .agg(F.min("vec_id").alias("least"), F.count("*").alias("n"))
    )
    return stored(groups.withColumn("c", F.monotonically_increasing_id()), "vectors")


def cell_centres(vectors: DataFrame, rows: int, dim: int) -> np.ndarray:
    """Unit centres by spherical k-means on a bounded sample; sums are made in tasks.

    ``rows`` is the size of the largest set that is compared within itself.
    """
    k = max(1, min(MAX_CELLS, math.ceil(rows / CELL)))
    if k == 1 or not dim:
        return np.zeros((1, dim))
    sample = stored(
        vectors.orderBy(F.xxhash64("embedding"), "c").limit(FIT_ROWS).select("embedding", "c"),
        "kmeans-sample",
    )
    first = sample.orderBy(F.xxhash64("embedding"), "c").limit(k).select("embedding").toArrow()
    centres = matrix(first.column(0), dim)
    for _ in range(ROUNDS):
        sent = sample.sparkSession.sparkContext.broadcast(centres)

        def sums(batches, sent=sent):
            total = np.zeros(sent.value.shape)
            for batch in batches:
                x = matrix(batch.column(0), dim)
                np.add.at(total, (x @ sent.value.T).argmax(axis=1), x)
            cells = np.flatnonzero(np.abs(total).sum(axis=1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cells, pa.int32()), pa.array(list(total[cells]), pa.list_(pa.float64()))],
                names=["cell", "total"],
            )

        told = sample.select("embedding").mapInArrow(sums, "cell int, total array<double>").toArrow()
        total = np.zeros(centres.shape)
        for cell, row in zip(told.column(0).to_pylist(), told.column(1).to_pylist()):
            total[cell] += row
        norm = np.sqrt((total * total).sum(axis=1, keepdims=True))
        # A cell that lost its vectors keeps its centre.
        centres = np.where(norm > 0, total / np.where(norm > 0, norm, 1), centres)
        sent.unpersist()
    return centres


def placed(vectors: DataFrame, centres: np.ndarray, dim: int, cosine: float) -> DataFrame:
    """Each vector at home in its nearest cell, and visiting all cells that may hold a partner.

    Let x be at home in cell a and y in b, with cosine at least t. Then y is no nearer to a
    than to b, and |x - y| <= sqrt(2 - 2t), so x (a - b) <= |a - b| sqrt(2 - 2t). Cells where
    this fails hold no partner: no link is lost.
    """
    reach = math.sqrt(2 - 2 * cosine) + 1e-9
    sent = vectors.sparkSession.sparkContext.broadcast(centres)

    def run(batches):
        middle = sent.value
        gap = np.sqrt(np.maximum(0, 2 - 2 * np.clip(middle @ middle.T, -1, 1)))
        for batch in batches:
            near = matrix(batch.column("embedding"), dim) @ middle.T
            home = near.argmax(axis=1)
            rows = np.arange(len(home))
            visits = near[rows, home][:, None] - near <= gap[home] * reach + 1e-9
            visits[rows, home] = True
            r, cell = np.nonzero(visits)
            picked = batch.take(pa.array(r))
            yield pa.RecordBatch.from_arrays(
                [*picked.columns, pa.array(cell.astype(np.int32)), pa.array(home[r] == cell)],
                names=[*picked.schema.names, "cell", "home"],
            )

    kept = vectors.select(
        "c", "embedding", "n", F.xxhash64("label", F.size("embedding")).alias("kind"),
        F.xxhash64(F.lit("tag"), "label", F.size("embedding")).alias("tag"),
    )
    schema = kept.select("*", F.lit(0).alias("cell"), F.lit(True).alias("home")).schema
    return kept.mapInArrow(run, schema)


def compared(vectors: DataFrame, dim: int, cosine: float, centres: np.ndarray) -> DataFrame:
    """(c, links, root): from each unit, a vector's links in it and a member of its component.

    A unit is a block of a cell's own vectors against a block of all that live in or visit the
    cell, so each pair is met once from either side, and no unit exceeds two blocks.
    """
    rows = placed(vectors, centres, dim, cosine)
    rows = stored(rows.withColumn("bucket", F.xxhash64("kind", "cell")), "cells")
    sizes = stored(
        rows.groupBy("bucket").agg(
            F.ceil(F.count_if("home") / BLOCK).cast("int").alias("own_blocks"),
            F.ceil(F.count("*") / BLOCK).cast("int").alias("all_blocks"),
            F.count("*").alias("met"),
        ).where("own_blocks > 0 and met > 1"),
        "cell-sizes",
    )
    sized = rows.join(sizes, "bucket")

    def block(count):
        return F.pmod(F.xxhash64("c", F.lit(count)), F.col(count)).cast("int")

    def each(count):
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    own = sized.where("home").select(
        "bucket", "tag", "cell", "c", "embedding", "n",
        F.lit(0).alias("side"), block("own_blocks").alias("a"), each("all_blocks").alias("b"),
    )
    met = sized.select(
        "bucket", "tag", "cell", "c", "embedding", "n",
        F.lit(1).alias("side"), each("own_blocks").alias("a"), block("all_blocks").alias("b"),
    )
    by = ["bucket", "a", "b"]
    dealt = own.unionByName(met).repartition(*by).sortWithinPartitions(*by, "side")

    def run(batches):
        for rows in whole_groups(batches, by):
            starts = np.append(group_starts(rows, by), rows.num_rows)
            x = matrix(rows.column("embedding"), dim)
            ids, side = rows.column("c").to_numpy(), rows.column("side").to_numpy()
            tag, cell = rows.column("tag").to_numpy(), rows.column("cell").to_numpy()
            length = rows.column("embedding").combine_chunks().value_lengths().to_numpy()
            times = rows.column("n").to_numpy()
            out = []
            for s, e in zip(starts[:-1], starts[1:]):
                cut = s + int((side[s:e] == 0).sum())
                if cut == s or cut == e:
                    continue
                hit = x[s:cut] @ x[cut:e].T >= cosine
                hit &= ids[s:cut][:, None] != ids[cut:e][None, :]
                # Buckets are hashes: what only shares the hash is told apart here.
                for what in (tag, cell, length):
                    if what[s] != what[s:e].max() or what[s] != what[s:e].min():
                        hit &= what[s:cut][:, None] == what[cut:e][None, :]
                links = hit @ times[cut:e]
                named, where = np.unique(ids[s:e], return_inverse=True)
                labels = np.arange(len(named))
                i, j = np.nonzero(hit)
                merge(labels, where[: cut - s][i], where[cut - s :][j])
                out.append((ids[s:cut], links, named[labels[where[: cut - s]]]))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(v).astype(np.int64)) for v in zip(*out)],
                    names=["c", "links", "root"],
                )

    return stored(
        dealt.mapInArrow(run, "c long, links long, root long"), "cell-links"
    )


def embedding_dedup(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors of one label link if their cosine, in double precision, reaches ``cosine``; vectors
    of different length never do. A vector that is null, empty, zero or holds a null or
    non-finite number, or has no label, links with nothing: it is a component of its own.
    ``n_links`` counts other rows, copies included. A null vec_id names a component only if it
    has no other, and is never kept; rows that repeat a vec_id count as rows. An empty table
    gives no rows; further columns are not read.

    Copies of a vector are one row while links are searched; their number is added afterwards.
    """
    vectors = vectors.select("vec_id", "embedding", "label")
    classes = distinct_vectors(vectors)
    # Vectors meet within their label only, so the largest label tells how many cells it takes.
    told = classes.groupBy("label").agg(
        F.count("*").alias("n"), F.max(F.size("embedding")).alias("d")
    ).agg(F.coalesce(F.max("n"), F.lit(0)).alias("n"), F.max("d").alias("d")).first()
    dim = told.d or 0
    found = compared(classes, dim, cosine, cell_centres(classes, told.n, dim))
    links = found.groupBy("c").agg(F.sum("links").alias("links"))
    roots = components(
        found.where("c != root").select(F.col("c").alias("u"), F.col("root").alias("v")), "vectors"
    ).select(F.col("node").alias("c"), "root")
    named = stored(
        classes.join(links, "c", "left").join(roots, "c", "left").select(
            "label", "embedding", "least", F.coalesce("root", "c").alias("root"),
            (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        ),
        "vector-links",
    )
    smallest = stored(named.groupBy("root").agg(F.min("least").alias("component_id")), "least")
    known = stored(
        named.join(smallest, "root").select("label", "embedding", "n_links", "component_id"),
        "vector-classes",
    )
    row = vectors.join(known, ["label", "embedding"], "left")
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return row.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )


def op5_embedding_dedup(spark, sf_dir):
    return embedding_dedup(table(spark, sf_dir, "embeddings"))
