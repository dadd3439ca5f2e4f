"""SimHash near-duplicates found by pigeonring filtering, and near-duplicates by similarity."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.blocks import group_starts, merge, units, whole_groups
from eventloom.llm.common import components, fresh, stored, table

SHINGLE, SEED, DISTANCE = 3, 42, 2
#: Ring of segments; a chain's first ``CLEAN`` segments have no budget and form the key.
SEGMENTS = 8
BITS = 64 // SEGMENTS
CLEAN = (SEGMENTS - 1) // DISTANCE
#: Fingerprints in a block: a unit of work compares at most two blocks.
BLOCK = 4_096
#: The general rule for near-copies: word shingles, and the Jaccard similarity of their sets.
NEAR_SHINGLE, SIMILARITY = 5, 0.8
#: Bands of minima that propose pairs: at similarity 0.8 a pair misses all with 3e-6.
BANDS, ROWS = 24, 4
_RANDOM = np.random.default_rng(SEED)
MIXERS = list(zip(*_RANDOM.integers(0, 2**64, (2, BANDS * ROWS), np.uint64) | np.array([[1], [0]], np.uint64)))
#: Sets in a block, as ``BLOCK``.
NEAR_BLOCK = 1_024


def shingle_hashes(text: bytes, shingle: int) -> np.ndarray:
    """Hashes of all runs of so many words; fewer words make one, a text without words none."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, "<u8")
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths) - 1
    starts = ends - lengths + 1
    last = shingle - 1
    if len(words) > last:
        starts, ends = starts[: len(words) - last], ends[last:]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends.tolist())], "<u8")


def fingerprint(text: bytes) -> int:
    """A bit is 1 if it is set in over half the hashes of the text's shingles."""
    hashes = shingle_hashes(text, SHINGLE)
    if not len(hashes):
        return 0
    counts = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 32_768):
        part = hashes[k : k + 32_768].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprinted(docs: DataFrame, text: str, fp: str, row: str) -> DataFrame:
    """The rows with ``fp`` (64 bits in a long) and ``row`` (a number of its own), stored."""
    carried = docs.columns
    schema = docs.select("*", F.lit(0).cast("long").alias(fp), F.lit(0).cast("long").alias(row)).schema

    def run(batches):
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            texts = batch.column(text).cast(pa.binary())
            prints = [fingerprint(t.as_py() or b"") for t in texts]
            columns = [batch.column(c) for c in carried]
            columns.append(pa.array(np.array(prints, np.uint64).view(np.int64)))
            columns.append(pa.array(np.arange(number, number + batch.num_rows)))
            number += batch.num_rows
            yield pa.RecordBatch.from_arrays(columns, names=[*carried, fp, row])

    return stored(docs.mapInArrow(run, schema), "fingerprints")


def links(prints: DataFrame) -> DataFrame:
    """Edges (u, v) that connect all distinct fingerprints within ``DISTANCE`` bits.

    Pigeonring: if two fingerprints differ in at most d bits, some chain of consecutive
    segments of the ring has, for each of its prefixes of k segments, at most k * d / m
    differing bits. Its first (m - 1) // d segments must agree entirely: they are the bucket's
    key. Within a bucket a pair has to keep the budgets of the chain up to the whole ring,
    which ends in the full distance. A unit gives a spanning forest of what it finds, never
    all pairs.
    """
    fp = F.col("fp")

    def turned(start):
        low = start * BITS
        if low == 0:
            return fp
        right = F.shiftrightunsigned(fp, low)
        return right.bitwiseOR(F.shiftleft(fp, 64 - low))

    mask = (1 << (CLEAN * BITS)) - 1
    keys = F.array(
        *[
            F.struct(
                F.lit(s).cast("long").bitwiseXOR(
                    F.shiftleft(turned(s).bitwiseAND(F.lit(mask)), SEGMENTS.bit_length())
                ).alias("bucket"),
                turned(s).alias("ring"),
            )
            for s in range(SEGMENTS)
        ]
    )
    keyed = prints.select("fp", F.inline(keys))
    met = units(keyed, "bucket", "fp", BLOCK, "pigeonring")
    # The chain is checked where the budget steps: after so many segments, so many bits.
    steps = [
        (k, k * DISTANCE // SEGMENTS)
        for k in range(CLEAN + 1, SEGMENTS + 1)
        if k == SEGMENTS or (k + 1) * DISTANCE // SEGMENTS > k * DISTANCE // SEGMENTS
    ]
    masks = [(np.uint64((1 << (k * BITS)) - 1), most) for k, most in steps]
    by = ["bucket", "unit_a", "unit_b"]

    def near(a, b):
        differ = a ^ b
        fits = np.bitwise_count(differ & masks[0][0]) <= masks[0][1]
        for m, most in masks[1:]:
            fits &= np.bitwise_count(differ & m) <= most
        return fits

    def run(batches):
        for rows in whole_groups(batches, by):
            n = rows.num_rows
            ring = rows.column("ring").to_numpy().view(np.uint64)
            prints = rows.column("fp").to_numpy()
            own = rows.column("unit_own").to_numpy()
            same_block = rows.column("unit_a").to_numpy() == rows.column("unit_b").to_numpy()
            starts = group_starts(rows, by)
            sizes = np.diff(np.append(starts, n))
            labels = np.arange(n)
            small = np.repeat(sizes <= 32, sizes)
            group = np.repeat(np.arange(len(starts)), sizes)
            for step in range(1, 32):
                here = np.flatnonzero(small[step:] & (group[step:] == group[:-step]))
                if not len(here):
                    break
                here = here[near(ring[here], ring[here + step])]
                merge(labels, here, here + step)
            for s, size in zip(starts[sizes > 32], sizes[sizes > 32]):
                mine = np.arange(s, s + size)
                left = mine if same_block[s] else mine[own[mine] == own[mine].min()]
                right = mine if same_block[s] else mine[own[mine] != own[mine].min()]
                for k in range(0, len(left), 256):
                    part = left[k : k + 256]
                    i, j = np.nonzero(near(ring[part][:, None], ring[right][None, :]))
                    merge(labels, part[i], right[j])
            hung = np.flatnonzero(labels != np.arange(n))
            yield pa.RecordBatch.from_arrays(
                [pa.array(prints[labels[hung]]), pa.array(prints[hung])], names=["u", "v"]
            )

    return met.mapInArrow(run, "u long, v long")


def rooted(rows: DataFrame) -> DataFrame:
    """(fp, least, root): each fingerprint of ``rows(doc_id, fp)``, its smallest doc_id and the
    fingerprint that names its component."""
    groups = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "fp-groups")
    roots = components(links(groups), "simhash").withColumnRenamed("node", "fp")
    joined = groups.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    return stored(joined, "fp-roots")


def simhash(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id.

    Documents whose fingerprints differ in at most two bits are linked; a component is named
    by the smallest doc_id that links reach. A text without words (or null) has fingerprint
    zero and links like any other; fewer than three words make one shingle. Rows that repeat a
    doc_id are rows of their own; a null doc_id names a component only if it has no other.
    An empty table gives no rows; further columns are not read.

    Equal fingerprints are one node from the start, so copies cost one row each.
    """
    rows = fingerprinted(docs.select("doc_id", "text"), "text", "fp", "row").select("doc_id", "fp")
    found = rooted(rows)
    smallest = stored(found.groupBy("root").agg(F.min("least").alias("component_id")), "fp-least")
    classes = stored(found.join(smallest, "root").select("fp", "component_id"), "fp-classes")
    named = rows.join(classes, "fp")
    return named.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def simhash_dedup(docs: DataFrame) -> DataFrame:
    """The documents without near-copies: of each component the smallest doc_id stays.

    Of rows that repeat it the first read stays; a component without ids keeps one row. All
    columns come through as they are.
    """
    fp, row = fresh(docs, "fp"), fresh(docs, "row")
    marked = fingerprinted(docs, "text", fp, row)
    ids = marked.select("doc_id", F.col(fp).alias("fp"), F.col(row).alias("row"))
    first = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    per_print = stored(ids.groupBy("fp").agg(F.min(first).alias("first")), "fp-first")
    kept = (
        rooted(ids).select("fp", "root").join(per_print, "fp")
        .groupBy("root").agg(F.min("first").alias("first"))
    )
    kept = kept.select(F.col("first.row").alias(row))
    # What stays grows with the corpus: one plan for every size, by shuffle.
    return marked.join(kept.hint("merge"), row, "left_semi").drop(fp, row)


def sketch(hashes: np.ndarray) -> list:
    """A key for each band: texts of similarity s share a band's key with probability
    s ** ``ROWS``, and miss all of them with (1 - s ** ROWS) ** BANDS."""
    least = np.array([(hashes * a + b).min() for a, b in MIXERS], "<u8").reshape(BANDS, ROWS)
    return [xxhash.xxh64_intdigest(row.tobytes(), band) for band, row in enumerate(least)]


def shingled(docs: DataFrame, shingle: int, digest: str, keys: str, row: str, fp: str) -> DataFrame:
    """The rows with ``digest`` (of the set of shingles), ``keys`` (a key for each band, none
    without words), ``row`` (a number of its own) and ``fp`` (the fingerprint), stored."""
    carried = docs.columns
    schema = docs.select(
        "*", F.lit(b"").alias(digest), F.array(F.lit(0).cast("long")).alias(keys),
        *[F.lit(0).cast("long").alias(c) for c in (row, fp)],
    ).schema

    def run(batches):
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            digests, sketches, prints = [], [], []
            for t in batch.column("text").cast(pa.binary()):
                prints.append(fingerprint(t.as_py() or b""))
                found = np.unique(shingle_hashes(t.as_py() or b"", shingle))
                digests.append(xxhash.xxh3_128_digest(found.tobytes()))
                sketches.append(np.array(sketch(found) if len(found) else [], np.uint64).view(np.int64))
            columns = [batch.column(c) for c in carried]
            columns.append(pa.array(digests, pa.binary()))
            columns.append(pa.array(sketches, pa.list_(pa.int64())))
            columns.append(pa.array(np.arange(number, number + batch.num_rows)))
            columns.append(pa.array(np.array(prints, np.uint64).view(np.int64)))
            number += batch.num_rows
            yield pa.RecordBatch.from_arrays(columns, names=[*carried, digest, keys, row, fp])

    return stored(docs.mapInArrow(run, schema), "sketches")


def similar(values: np.ndarray, starts: np.ndarray, left, right, similarity: float):
    """(i, j): pairs that connect what is similar enough between the sets ``left`` and ``right``.

    ``values`` holds the sets one after the other, each ascending. A set meets, by exact Jaccard,
    those that are not connected with it yet.
    """
    sizes = np.diff(starts)
    codes = np.unique(values, return_inverse=True)[1]
    marked = np.zeros(len(values), bool)
    labels, out = np.arange(len(sizes)), []
    for i in left:
        # A set is in no pair with one that is too small or too large.
        fits = (labels[right] != labels[i]) & (sizes[right] >= similarity * sizes[i] - 1) & (
            sizes[i] >= similarity * sizes[right] - 1
        )
        others = right[fits]
        if not len(others):
            continue
        mine = codes[starts[i] : starts[i + 1]]
        marked[mine] = True
        offsets = np.cumsum(sizes[others]) - sizes[others]
        places = np.repeat(starts[others] - offsets, sizes[others]) + np.arange(sizes[others].sum())
        both = np.add.reduceat(marked[codes[places]].astype(np.int64), offsets)
        marked[mine] = False
        near = others[both / (sizes[i] + sizes[others] - both) >= similarity]
        for j in near.tolist():
            if labels[i] != labels[j]:
                low, high = sorted((labels[i], labels[j]))
                labels[labels == high] = low
                out.append((i, j))
    return out


def similar_links(sets: DataFrame, docs: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """Edges (u, v) that connect all sets that share a band's key and are similar enough.

    ``sets(node, keys)``: ``node`` is a row of ``docs(row, text)``. Bands that bring the same
    sets together count once. A unit gives a spanning forest of what it finds, never all pairs.
    """
    keyed = sets.select("node", F.explode("keys").alias("bucket"))
    met = keyed.groupBy("bucket").agg(
        F.count("*").alias("n"),
        F.bit_xor(F.xxhash64("node")).alias("one"),
        F.bit_xor(F.xxhash64("node", F.lit(1))).alias("two"),
    )
    once = met.where("n > 1").groupBy("n", "one", "two").agg(F.min("bucket").alias("bucket"))
    held = stored(keyed.join(stored(once.select("bucket"), "near-buckets"), "bucket"), "near-held")

    def read(batches):
        for batch in batches:
            found = [np.unique(shingle_hashes(t.as_py() or b"", shingle)).view(np.int64) for t in batch.column("text").cast(pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(found, pa.list_(pa.int64()))], names=["node", "hashes"]
            )

    wanted = held.select(F.col("node").alias("row")).distinct()
    texts = docs.join(wanted.hint("merge"), "row", "left_semi").mapInArrow(read, "node long, hashes array<long>")
    hashes = stored(texts, "near-hashes")
    by = ["bucket", "unit_a", "unit_b"]
    dealt = units(held.join(hashes.hint("merge"), "node"), "bucket", "node", NEAR_BLOCK, "near")

    def run(batches):
        for rows in whole_groups(batches, by):
            nodes = rows.column("node").to_numpy()
            own = rows.column("unit_own").to_numpy()
            same_block = rows.column("unit_a").to_numpy() == rows.column("unit_b").to_numpy()
            first = rows.column("unit_a").to_numpy()
            starts = np.append(group_starts(rows, by), rows.num_rows)
            edges = []
            for s, e in zip(starts[:-1].tolist(), starts[1:].tolist()):
                part = rows.column("hashes").slice(s, e - s).combine_chunks()
                part = part.combine_chunks() if isinstance(part, pa.ChunkedArray) else part
                sizes = part.value_lengths().to_numpy()
                ends = np.concatenate([[0], np.cumsum(sizes)])
                values = part.flatten().to_numpy().view(np.uint64)
                every = np.arange(e - s)
                left = every if same_block[s] else every[own[s:e] == first[s]]
                right = every if same_block[s] else every[own[s:e] != first[s]]
                edges += [(nodes[s + i], nodes[s + j]) for i, j in similar(values, ends, left, right, similarity)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(x[k]) for x in edges], pa.int64()) for k in (0, 1)], names=["u", "v"]
            )

    return dealt.mapInArrow(run, "u long, v long")


def fingerprint_links(rows: DataFrame) -> DataFrame:
    """Edges (u, v) that connect rows whose fingerprints are within ``DISTANCE`` bits.

    ``rows`` is (node, row, fp). A fingerprint is named by its smallest row: every node hangs on
    the names of its fingerprints, and pigeonring (``links``) connects these names.
    """
    names = stored(rows.groupBy("fp").agg(F.min("row").alias("name")), "near-prints")
    held = rows.select("node", "fp").distinct().join(names.hint("merge"), "fp")
    held = held.where("node != name").select(F.col("name").alias("u"), F.col("node").alias("v"))
    found = stored(links(names), "near-rings")
    for end in ("u", "v"):
        named = names.select(F.col("fp").alias(end), F.col("name").alias(f"{end}_name"))
        found = found.join(named, end)
    return held.unionByName(found.select(F.col("u_name").alias("u"), F.col("v_name").alias("v")))


def near_dedup(docs: DataFrame, shingle: int = NEAR_SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """The documents without near-copies: of each component the smallest doc_id stays.

    Documents are linked if their SimHash fingerprints differ in at most ``DISTANCE`` bits, found
    by pigeonring as in ``simhash``; and, as two bits of 64 do not reach edits of some words, also
    if the sets of their shingles have a Jaccard similarity of at least ``similarity``, which is
    computed for every pair that shares a band's key and is not connected yet. Fewer words than
    ``shingle`` make one shingle; texts without words (or null) are alike. Of rows that repeat an
    id the first read stays; a component without ids keeps one row. All columns come through as
    they are.
    """
    digest, keys, row, fp = (fresh(docs, c) for c in ("digest", "keys", "row", "fp"))
    marked = shingled(docs, shingle, digest, keys, row, fp)
    first = F.struct(F.col("doc_id").isNull(), "doc_id", F.col(row).alias("row"))
    # Equal sets are one node from the start, so copies cost one row each.
    groups = marked.groupBy(F.col(digest).alias("digest")).agg(F.min(first).alias("first"))
    groups = stored(groups.select("digest", F.col("first.row").alias("node"), "first"), "near-groups")
    sets = marked.select(F.col(row).alias("node"), F.col(keys).alias("keys")).join(
        groups.select("node").hint("merge"), "node", "left_semi"
    )
    prints = marked.select(F.col(digest).alias("digest"), F.col(row).alias("row"), F.col(fp).alias("fp"))
    prints = stored(
        prints.join(groups.select("digest", "node").hint("merge"), "digest").drop("digest"), "near-nodes"
    )
    texts = marked.select(F.col(row).alias("row"), "text")
    alike = similar_links(stored(sets, "near-sets"), texts, shingle, similarity)
    roots = components(fingerprint_links(prints).unionByName(alike), "near")
    kept = (
        groups.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        .groupBy("root").agg(F.min("first").alias("first"))
    )
    kept = kept.select(F.col("first.row").alias(row))
    return marked.join(kept.hint("merge"), row, "left_semi").drop(digest, keys, row, fp)


def op8_simhash(spark, sf_dir):
    return simhash(table(spark, sf_dir, "documents"))
