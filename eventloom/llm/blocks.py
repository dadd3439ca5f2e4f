"""Comparing rows that share a bucket, in bounded blocks, without giving out all pairs.

A bucket of any size is cut into blocks by hash; every two blocks of a bucket (and each block
with itself) meet in one unit of work of at most two blocks. Units are dealt by hash, so a
bucket that holds a third of all rows is spread over the cluster.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import stored


def units(keyed: DataFrame, key: str, spread: str, block: int, name: str) -> DataFrame:
    """Rows of ``keyed`` repeated for each unit they take part in, in units' order.

    Adds ``unit_a``, ``unit_b`` (blocks that meet) and ``unit_own`` (the row's block). Buckets
    of one row drop out: they have no pairs. Sizes are map-side counts; they are stored before
    the join, so that adaptive execution can split a large bucket there.
    """
    sizes = stored(
        keyed.groupBy(key).agg(F.count("*").alias("unit_n")).where("unit_n > 1"), f"{name}-sizes"
    )
    blocks = F.ceil(F.col("unit_n") / block).cast("int")
    own = F.pmod(F.xxhash64(spread), F.col("unit_blocks")).cast("int")
    met = (
        keyed.join(sizes, key)
        .withColumn("unit_blocks", blocks)
        .withColumn("unit_own", own)
        .withColumn("unit_other", F.explode(F.sequence(F.lit(0), F.col("unit_blocks") - 1)))
        .withColumn("unit_a", F.least("unit_own", "unit_other"))
        .withColumn("unit_b", F.greatest("unit_own", "unit_other"))
        .drop("unit_n", "unit_blocks", "unit_other")
    )
    by = [key, "unit_a", "unit_b"]
    return met.repartition(*by).sortWithinPartitions(*by)


def whole_groups(batches, columns):
    """Arrow tables that hold whole groups only; rows come sorted by ``columns``."""
    held = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        rows = pa.Table.from_batches([batch])
        held = rows if held is None else pa.concat_tables([held, rows])
        starts = group_starts(held, columns)
        if len(starts) > 1:
            cut = int(starts[-1])
            yield held.slice(0, cut).combine_chunks()
            held = held.slice(cut).combine_chunks()
    if held is not None:
        yield held.combine_chunks()


def group_starts(rows, columns):
    """Row numbers at which a new group begins."""
    change = np.zeros(rows.num_rows, dtype=bool)
    change[:1] = True
    for c in columns:
        values = rows.column(c).to_numpy()
        change[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(change)


def merge(labels, i, j):
    """Join the sets of ``i`` and ``j``; labels point at smaller members, roots at themselves."""
    while True:
        a, b = labels[i], labels[j]
        differ = a != b
        if not differ.any():
            return
        i, j, a, b = i[differ], j[differ], a[differ], b[differ]
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = labels[labels]
            if np.array_equal(up, labels):
                break
            labels[:] = up
