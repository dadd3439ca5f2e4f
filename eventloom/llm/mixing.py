"""Mixing sources to target weights by cube-method balanced sampling."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import WORD, fresh, stored, table, whole_text

WEIGHTS, SHARE, MOST = (5.0, 2.0, 1.0), 1.5, 2.0
#: Documents that one flight of the cube method takes at once.
BLOCK = 4_096


def ranked(keys: DataFrame, column: str) -> DataFrame:
    """``keys`` with ``position``: its place by code point, null last, from 0.

    Rows are dealt by range and numbered per part; the parts' sums (as many as partitions) give
    the rest, so that no task sees all keys.
    """
    order = [F.col(column).isNull(), F.col(column)]
    dealt = keys.repartitionByRange(*order).sortWithinPartitions(*order)
    # The number holds the partition above 33 bits and the row within it below.
    rows = stored(dealt.withColumn("n", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("n", 33)
    within = F.col("n").bitwiseAND((1 << 33) - 1)
    sums = rows.groupBy(part.alias("part")).agg(F.count("*").alias("size")).collect()
    before, at = {}, 0
    for r in sorted(sums, key=lambda r: r.part):
        before[r.part] = at
        at += r.size
    if not before:
        return rows.withColumn("position", F.lit(0).cast("long")).drop("n")
    offsets = keys.sparkSession.createDataFrame(list(before.items()), "part long, before long")
    return (
        rows.withColumn("part", part)
        .join(F.broadcast(offsets), "part")
        .withColumn("position", F.col("before") + within)
        .drop("n", "part", "before")
    )


def targets(sources: DataFrame) -> DataFrame:
    """``sources(source, source_size, ...)`` with ``target``.

    The share of all sizes is dealt by weight; a source stops at twice its size and the excess
    is dealt anew among the others, until none is above. Each round needs two sums.
    """
    position = ranked(sources.select("source"), "source")
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("position") % len(WEIGHTS) + 1).cast("int"))
    weighed = stored(
        sources.join(
            position.select(F.col("source").alias("s"), weight.alias("weight")),
            F.col("source").eqNullSafe(F.col("s")),
        ).drop("s"),
        "weights",
    )
    most = MOST * F.col("source_size")
    total = weighed.agg(F.sum("source_size").alias("t")).first().t or 0
    per_weight, full = None, -1
    while True:
        # ``full`` counts the sources that have stopped; they stay stopped.
        stopped = F.lit(False) if per_weight is None else per_weight * F.col("weight") > most
        told = weighed.agg(
            F.coalesce(F.sum(F.when(stopped, most)), F.lit(0.0)).alias("taken"),
            F.coalesce(F.sum(F.when(~stopped, F.col("weight"))), F.lit(0.0)).alias("weight"),
            F.count_if(stopped).alias("n"),
        ).first()
        if told.n == full or not told.weight:
            break
        full, per_weight = told.n, (SHARE * total - told.taken) / told.weight
    share = F.lit(0.0) if per_weight is None else F.least(per_weight * F.col("weight"), most)
    return stored(weighed.withColumn("target", share), "targets")


def flight(p: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Move inclusion probabilities to 0 or 1 while sums of p and of p * size stay as they are.

    At any three fractional units there is a direction in the null space of the two
    constraints; a step along it, to where the first of them becomes whole, settles one. At
    most two units stay fractional (fewer when sizes tie).
    """
    p = p.tolist()
    s = [float(x) for x in size]
    close, open_units = 1e-9, []
    for k in range(len(p)):
        if close < p[k] < 1 - close:
            open_units.append(k)
        while len(open_units) >= 2:
            if len(open_units) == 2:
                i, j = open_units
                if s[i] != s[j]:
                    break
                units, u = (i, j), (1.0, -1.0)
            else:
                i, j, m = units = tuple(open_units)
                u = (s[j] - s[m], s[m] - s[i], s[i] - s[j])
            # Of the two directions the shorter step is taken: it moves probabilities least.
            ahead = back = float("inf")
            for unit, d in zip(units, u):
                if d > 0:
                    ahead, back = min(ahead, (1 - p[unit]) / d), min(back, p[unit] / d)
                elif d < 0:
                    ahead, back = min(ahead, -p[unit] / d), min(back, (p[unit] - 1) / d)
            step = ahead if ahead <= back else -back
            for unit, d in zip(units, u):
                p[unit] += step * d
                if p[unit] <= close or p[unit] >= 1 - close:
                    p[unit] = round(p[unit])
            open_units = [x for x in open_units if 0 < p[x] < 1]
    return np.array(p)


def mixed(sized: DataFrame) -> DataFrame:
    """``sized(row, key, source, size)`` -> (row, source_size, target, taken).

    A document is taken whole as often as its source's ratio of target to size says; what is
    left of the ratio is its inclusion probability. Flights settle blocks of a source side by
    side; the few that stay fractional meet in the next round's blocks, until a source has one
    block. Its last two units are the landing: they are taken in part, so the source's words
    end within a word of the target. Blocks are dealt by hash: no task holds a whole source.
    """
    totals = stored(
        sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n")),
        "sources",
    )
    wanted = targets(totals).select(
        F.col("source").alias("s"), "source_size", "target", "n",
        F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0)).alias("ratio"),
    )
    rows = sized.join(wanted, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    copies = F.floor(F.col("ratio") + 1e-12)
    rows = stored(
        rows.withColumn("copies", copies).withColumn(
            "p", F.greatest(F.col("ratio") - F.col("copies"), F.lit(0.0))
        ),
        "mix",
    )
    group = F.xxhash64(F.coalesce("source", F.lit("")), F.col("source").isNull())
    open_rows = rows.where("size > 0").select("row", "key", group.alias("g"), "size", "p", "n")
    decided, level = [], 0
    while True:
        blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.lit(1))
        dealt = open_rows.withColumn("b", F.pmod(F.xxhash64("key", F.lit(level)), blocks))

        def settle(frame: pd.DataFrame) -> pd.DataFrame:
            frame = frame.sort_values(["key", "row"])
            frame["p"] = flight(frame["p"].to_numpy(), frame["size"].to_numpy())
            return frame[["row", "key", "g", "size", "p"]]

        flown = stored(
            dealt.groupBy("g", "b").applyInPandas(
                settle, "row long, key long, g long, size long, p double"
            ),
            "flight",
        )
        decided.append(flown.where("p = 0 or p = 1").select("row", "p"))
        rest = flown.where("p > 0 and p < 1")
        # At most two of a block are open; a source of one block is ready to land.
        sizes = rest.groupBy("g").agg(F.count("*").alias("n"))
        if (sizes.agg(F.max("n")).first()[0] or 0) <= 2:
            decided.append(rest.select("row", "p"))
            break
        open_rows, level = rest.join(sizes, "g"), level + 1
    chosen = decided[0]
    for more in decided[1:]:
        chosen = chosen.unionByName(more)
    extra = F.round(F.coalesce("p", F.lit(0.0)) * F.col("size"))
    return (
        rows.drop("p")
        .join(chosen, "row", "left")
        .select(
            "row", "source_size", "target",
            (F.col("copies") * F.col("size") + extra).cast("long").alias("taken"),
        )
    )


def mix(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken.

    Sizes count words (a null text has none). Sources in code point order, null last, weigh 5,
    2, 1 and so on again; targets share 150 % of all words, none above twice its source's.
    ``taken`` counts repeats and never exceeds twice the size. At most two documents of a
    source are taken in part. The result depends on ids and sizes only, so reruns agree; rows
    that repeat an id are rows of their own; a null id is one like any other; an empty table
    gives no rows; further columns are not read.
    """
    rows = stored(
        docs.select(
            "doc_id",
            F.col("source").cast("string").alias("source"),
            F.regexp_count(whole_text(), F.lit(WORD)).cast("long").alias("size"),
        ).withColumn("row", F.monotonically_increasing_id()),
        "sizes",
    )
    taken = mixed(rows.select("row", F.xxhash64("doc_id", "size").alias("key"), "source", "size"))
    return rows.join(taken, "row").select("doc_id", "size", "source_size", "target", "taken")


def mix_documents(docs: DataFrame) -> DataFrame:
    """The mixture itself, with the columns of ``docs``: a document appears as often as it is
    taken, a part of one (at most two in a source) as its first words. Documents without words
    stay as they are."""
    row, size = fresh(docs, "row"), fresh(docs, "size")
    times, text = fresh(docs, "times"), fresh(docs, "cut")
    kept = stored(
        docs.withColumn(size, F.regexp_count(whole_text(), F.lit(WORD)).cast("long")).withColumn(
            row, F.monotonically_increasing_id()
        ),
        "mix-documents",
    )
    taken = mixed(
        kept.select(
            F.col(row).alias("row"), F.xxhash64("doc_id", size).alias("key"),
            F.col("source").cast("string").alias("source"), F.col(size).alias("size"),
        )
    ).select(F.col("row").alias(row), F.col("taken").alias(times))
    whole = F.when(F.col(size) > 0, F.floor(F.col(times) / F.col(size))).otherwise(1).cast("int")
    part = F.when(F.col(size) > 0, F.col(times) % F.col(size)).otherwise(0)
    copies = F.concat(
        F.array_repeat(F.lit(None).cast("int"), whole),
        F.when(part > 0, F.array(part.cast("int"))).otherwise(F.array().cast("array<int>")),
    )
    # What is taken grows with the corpus: one plan for every size, by shuffle.
    out = kept.join(taken.hint("merge"), row).withColumn(text, F.explode(copies))
    words = F.regexp_extract_all("text", F.lit("[\\x20\\x09-\\x0D]*" + WORD), F.lit(0))
    first = F.when(F.col(text).isNull(), F.col("text")).otherwise(
        F.array_join(F.slice(words, 1, F.col(text)), "")
    )
    return out.withColumn("text", first).select(docs.columns)


def op2_cube_mixing(spark, sf_dir):
    return mix(table(spark, sf_dir, "documents"))
