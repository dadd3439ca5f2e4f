"""Repeated passages removed by pairwise alignment (patience diff) of overlapping documents."""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.blocks import group_starts, whole_groups
from eventloom.llm.common import WORD, fresh, stored, table, whole_text

#: Words an aligned block must have to count as repeated; fewer coincide by chance.
MIN_WORDS = 5


def patience(left: list, right: list) -> list:
    """Pairs of matching places of two sequences, increasing in both.

    ``left`` and ``right`` hold (place, line). Lines that occur once on each side anchor the
    alignment along their longest increasing run; between anchors the same is done again, and
    runs of equal lines around anchors are joined to them.
    """
    out, todo = [], [(0, len(left), 0, len(right))]
    while todo:
        a, b, c, d = todo.pop()
        while a < b and c < d and left[a][1] == right[c][1]:
            out.append((left[a][0], right[c][0]))
            a, c = a + 1, c + 1
        while a < b and c < d and left[b - 1][1] == right[d - 1][1]:
            b, d = b - 1, d - 1
            out.append((left[b][0], right[d][0]))
        if a >= b or c >= d:
            continue
        there: dict = {}
        for k in range(c, d):
            there[right[k][1]] = None if right[k][1] in there else k
        here: dict = {}
        for k in range(a, b):
            here[left[k][1]] = None if left[k][1] in here else k
        both = [(k, there[x]) for x, k in here.items() if k is not None and there.get(x) is not None]
        tops, ends, back = [], [], [-1] * len(both)
        for n, (_, j) in enumerate(both):
            at = bisect_left(tops, j)
            back[n] = ends[at - 1] if at else -1
            tops[at : at + 1], ends[at : at + 1] = [j], [n]
        n, anchors = ends[-1] if ends else -1, []
        while n >= 0:
            anchors.append(both[n])
            n = back[n]
        for i, j in anchors:  # from the last to the first
            todo.append((i + 1, b, j + 1, d))
            out.append((left[i][0], right[j][0]))
            b, d = i, j
        if anchors:
            todo.append((a, b, c, d))
    return sorted(out)


def aligned(later: list, earlier: list) -> set:
    """Places of ``later`` that alignment finds in ``earlier``.

    What an alignment leaves (passages in another order) is aligned again, until nothing more
    is found.
    """
    gone: set = set()
    while later:
        found = {i for i, _ in patience(later, earlier)}
        if not found:
            break
        gone |= found
        later = [x for x in later if x[0] not in found]
    return gone


def blocks(places: set, words: dict, least: int) -> list:
    """The places in runs of neighbouring lines that have ``least`` words together."""
    out, run = [], []
    for k in [*sorted(places), None]:
        if run and k != run[-1] + 1:
            if sum(words[i] for i in run) >= least:
                out += run
            run = []
        run.append(k)
    return out


def lined(rows: DataFrame, text: str, row: str) -> DataFrame:
    """(row, doc_id, h, words, places): the lines of each text that have words, stored.

    Lines are equal if they are identical without the ASCII white space around them; a line
    that repeats within its document is one row. Places count lines with words from 0.
    """
    filled = F.filter(
        F.transform(
            F.split(whole_text(text), "\n", -1),
            lambda x: F.regexp_replace(x, "^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$", ""),
        ),
        lambda x: x != "",
    )
    each = rows.select(F.col(row).alias("row"), "doc_id", F.posexplode(filled).alias("place", "line"))
    each = each.select(
        "row", "doc_id", "place", F.unhex(F.md5(F.col("line").cast("binary"))).alias("h"),
        F.regexp_count("line", F.lit(WORD)).alias("words"),
    )
    return stored(
        each.groupBy("row", "h").agg(
            F.first("doc_id").alias("doc_id"), F.first("words").alias("words"),
            F.sort_array(F.collect_list("place")).alias("places"),
        ),
        "lines",
    )


def shared_lines(lines: DataFrame) -> DataFrame:
    """(row, partner, h, words, places, there): what a document shares with an earlier one.

    A line that several documents hold leads each of them to the first, which keeps it. So a
    line gives one row for each holder, rare or common, and never the pairs of its holders;
    ``there`` has its places in the first.
    """
    first = lines.groupBy("h").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first"),
        F.min("row").alias("low"), F.max("row").alias("high"),
    )
    shared = stored(
        first.where("low < high").select("h", F.col("first.row").alias("partner")), "shared-lines"
    )
    held = stored(lines.join(shared, "h").drop("doc_id"), "held-lines")
    there = held.where("row = partner").select("h", F.col("places").alias("there"))
    return held.where("row != partner").join(there, "h")


def repeated_places(lines: DataFrame, least: int) -> DataFrame:
    """(row, gone): the places of each document that go, by alignment with earlier documents.

    All shared lines of one document meet in one place, however many partners it has; a
    partner that very many documents share is never gathered.
    """
    by = ["row", "partner"]
    dealt = shared_lines(lines).repartition("row").sortWithinPartitions(*by)

    def sequence(places, n):
        return sorted((p, k) for k, each in enumerate(places[:n]) for p in each)

    def run(batches):
        for rows in whole_groups(batches, ["row"]):
            starts = np.append(group_starts(rows, by), rows.num_rows)
            ids = rows.column("row").to_numpy()
            mine, there = rows.column("places").to_pylist(), rows.column("there").to_pylist()
            count = rows.column("words").to_numpy()
            found: dict = {}
            words: dict = {}
            for s, e in zip(starts[:-1].tolist(), starts[1:].tolist()):
                here = found.setdefault(int(ids[s]), set())
                each = words.setdefault(int(ids[s]), {})
                each.update((p, int(count[k])) for k in range(s, e) for p in mine[k])
                left, right = sequence(mine[s:e], e - s), sequence(there[s:e], e - s)
                here |= aligned(left, right)
            gone = {r: blocks(p, words[r], least) for r, p in found.items()}
            gone = {r: p for r, p in gone.items() if p}
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(gone), pa.int64()), pa.array(list(gone.values()), pa.list_(pa.int32())),
                 pa.array([sum(words[r][k] for k in p) for r, p in gone.items()], pa.int64())],
                names=["row", "gone", "gone_words"],
            )

    return stored(dealt.mapInArrow(run, "row long, gone array<int>, gone_words long"), "gone-lines")


def without(text: str | None, gone) -> tuple:
    """The text without the lines at these places, and how many lines with words it had."""
    lines = (text or "").split("\n")
    filled = [k for k, x in enumerate(lines) if x.strip(" \t\n\r\x0b\x0c")]
    if gone is None:
        return text, len(filled)
    drop = {filled[k] for k in gone}
    return "\n".join([x for k, x in enumerate(lines) if k not in drop]), len(filled)


def line_dedup(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """All columns, with ``text`` rid of passages that an earlier document holds too, and
    ``n_lines``, ``n_removed`` and ``removed_words`` (counted in lines with words and words).

    Documents are ordered by doc_id, null last, then as read; of rows that repeat, the later
    ones lose their text to the first. A passage is a run of lines, aligned with earlier
    documents, of at least ``min_words`` words together; shorter ones stay. Its first holder
    always keeps it, and repeats within one document stay. A null text stays null; texts
    without a repeated passage stay as they are; an empty table gives no rows. Columns of the
    input that bear one of the three names are replaced.
    """
    row = fresh(docs, "row")
    kept = stored(docs.withColumn(row, F.monotonically_increasing_id()), "line-documents")
    gone = repeated_places(lined(kept, "text", row), min_words)
    names = ["n_lines", "n_removed", "removed_words"]
    # The lists of lines grow with the corpus: one plan for every size, by shuffle.
    joined = kept.drop(*names).join(gone.withColumnRenamed("row", row).hint("merge"), row, "left")
    joined = joined.drop(row)
    carried = [c for c in joined.columns if c not in ("gone", "gone_words")]

    def run(batches):
        for batch in batches:
            told = [
                without(t, g)
                for t, g in zip(batch.column("text").to_pylist(), batch.column("gone").to_pylist())
            ]
            removed = [len(g or ()) for g in batch.column("gone").to_pylist()]
            columns = [
                pa.array([t for t, _ in told], pa.string()) if c == "text" else batch.column(c)
                for c in carried
            ]
            columns += [
                pa.array([n for _, n in told], pa.int64()), pa.array(removed, pa.int64()),
                batch.column("gone_words").fill_null(0),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[*carried, *names])

    added = [F.lit(0).cast("long").alias(n) for n in names]
    schema = joined.select(*carried, *added).schema
    return joined.mapInArrow(run, schema)


def without_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The documents without repeated passages, with their columns; a document that had nothing
    else goes, one that was empty before stays."""
    named = {n: fresh(docs, n) for n in ("n_lines", "n_removed", "removed_words")}
    back = {v: k for k, v in named.items()}
    clash = [c for c in docs.columns if c in named]
    aside = docs
    for c in clash:
        aside = aside.withColumnRenamed(c, named[c])
    out = line_dedup(aside, min_words).where("n_removed = 0 or n_removed < n_lines")
    out = out.drop(*named)
    for c in clash:
        out = out.withColumnRenamed(named[c], back[named[c]])
    return out.select(docs.columns)


def op3_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup(docs)
