"""Periodic runs of words: catchers over completed power-of-two blocks report squares online."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import WORD, table, whole_text

#: A run holds its period this many times, and this many words, at least.
TIMES, LEAST = 4, 6
#: Words of a text that are appended at a time.
APPENDED = 65_536


def first_difference(a, b):
    """Where two stretches of one length differ first; their length if they do not."""
    at, step = 0, 64
    while at < len(a):
        differs = a[at : at + step] != b[at : at + step]
        if differs.any():
            return at + int(differs.argmax())
        at, step = at + step, 2 * step
    return len(a)


class Level:
    """Hashes of the stretches of ``size`` words at each place from ``base`` on."""

    def __init__(self, size):
        self.size, self.base, self.hashes = size, 0, np.empty(0, np.uint64)

    def trim(self):
        """Catchers look back one block at most: what lies before the last two blocks goes."""
        first = max(0, (self.base + len(self.hashes)) // self.size - 2) * self.size
        if first > self.base:
            self.hashes = self.hashes[first - self.base :].copy()
            self.base = first


class Catchers:
    """Words are appended; what has been appended so far is searched for periodic stretches.

    A block is the ``size`` words from a multiple of ``size`` (a power of two) on. Once complete,
    it has a catcher for squares whose period q is over half its size and at most its size: it
    waits for a suffix of the text that equals the block and begins q words after it; at its
    completion it is itself the suffix and is compared with what began q words earlier. Either
    gives a square of period q, which is followed to the left at once and to the right for as long
    as appended words equal those q before; squares of one period that meet are one stretch.

    A run of period q and 4 q words or more holds the whole block of the smallest power of two
    not below q, with q words of the run before it or after its copy, so its catcher sees it. The
    catcher's nearest suffix is enough: inside the run nothing nearer equals the block.
    """

    def __init__(self):
        self.words = np.empty(0, np.int64)
        self.levels: list = []
        #: Period: first and last place (excluded) of the stretch that reaches the text's end.
        self.open: dict = {}
        #: Latest stretch of each period that has been followed, and all that have ended.
        self.latest: dict = {}
        self.ended: set = set()

    def append(self, words):
        before = len(self.words)
        self.words = np.concatenate([self.words, words]) if before else np.asarray(words, np.int64)
        n = len(self.words)
        for q, (start, end) in list(self.open.items()):
            self.follow(q, start, end)
        below = None
        for k in range(64):
            size = 1 << k
            if k >= len(self.levels):
                if n < TIMES * (size // 2 + 1):
                    break
                self.levels.append(Level(size))
            level = self.levels[k]
            known = level.base + len(level.hashes)
            if k == 0:
                more = self.words[known:].astype(np.uint64)
            else:
                # A new level takes the one below from its start, which has not been trimmed yet.
                have = below.hashes[known - below.base :]
                half = size // 2
                more = have[: max(0, len(have) - half)] * np.uint64(0x9E3779B97F4A7C15) + have[half:]
                more ^= more >> np.uint64(29)
                more *= np.uint64(0xBF58476D1CE4E5B9)
                more ^= more >> np.uint64(32)
            level.hashes = np.concatenate([level.hashes, more]) if known > level.base else more
            if len(more):
                for start, q in self.caught(level, known):
                    self.square(start, q, size)
            below = level
        for k, level in enumerate(self.levels):
            # The lowest levels stay whole while the next level may still have to be made.
            if k + 1 < len(self.levels):
                level.trim()

    def caught(self, level, known):
        """(start, period) for each catcher that a new suffix answers; the nearest one counts."""
        size, h, base = level.size, level.hashes, level.base
        half = size // 2
        found = []
        # Catchers that wait: suffixes that begin half to one block after a block.
        first = max(0, (known - 1) // size) * size - base
        for lo, hi in self.whole_and_rest(first, len(h) - 1, size):
            rows = h[lo + 1 : hi + 1].reshape(-1, min(size, hi - lo))[:, half:]
            if rows.shape[1]:
                same = rows == h[lo:hi:size, None]
                for r in np.flatnonzero(same.any(1)).tolist():
                    found.append((base + lo + r * size, half + 1 + int(same[r].argmax())))
        # Blocks completed now: what began half to one block before them.
        if size > 1:
            block = max(1, -(-known // size)) * size - base
            last = (base + len(h) - 1) // size * size - base
            if block <= last:
                rows = h[block - size : last].reshape(-1, size)[:, :half][:, ::-1]
                same = rows == h[block : last + 1 : size, None]
                for r in np.flatnonzero(same.any(1)).tolist():
                    q = half + 1 + int(same[r].argmax())
                    found.append((base + block + r * size - q, q))
        return sorted(found, key=lambda f: (f[1], f[0]))

    @staticmethod
    def whole_and_rest(first, end, size):
        """Whole blocks of ``first`` to ``end``, then the block that is not complete."""
        whole = first + max(0, end - first) // size * size
        return [(a, b) for a, b in ((first, whole), (whole, end)) if a < b]

    def square(self, start, q, size):
        """Follow a square to both sides, unless its stretch is known."""
        held = self.latest.get(q)
        if held and held[0] <= start < held[1]:
            return
        w = self.words
        if first_difference(w[start : start + size], w[start + q : start + q + size]) < size:
            return
        left = first_difference(w[:start][::-1], w[q : start + q][::-1])
        self.follow(q, start - left, start + size)

    def follow(self, q, start, end):
        """Advance the comparison of the text with itself q words on from ``end``."""
        w = self.words
        end += first_difference(w[end : len(w) - q], w[end + q :])
        if end >= self.latest.get(q, (0, 0))[1]:
            self.latest[q] = (start, end)
        if end + q == len(w):
            self.open[q] = (start, end)
            return
        if q in self.open and self.open[q][0] == start:
            del self.open[q]
        self.end(q, start, end)

    def end(self, q, start, end):
        if end - start + q >= max(LEAST, TIMES * q):
            self.ended.add((start, end - start + q, q))

    def runs(self):
        """(start, length, period) of all runs so far, by start, then period.

        A stretch also has the multiples of its smallest period; of one stretch the smallest counts.
        """
        whole = set(self.ended)
        for q, (start, end) in self.open.items():
            if end - start + q >= max(LEAST, TIMES * q):
                whole.add((start, end - start + q, q))
        smallest: dict = {}
        for start, length, q in whole:
            smallest[start, length] = min(q, smallest.get((start, length), q))
        return sorted(((s, n, q) for (s, n), q in smallest.items()), key=lambda r: (r[0], r[2]))


def runs_of(words: list) -> list:
    """Runs of a list of words."""
    if len(words) < LEAST:
        return []
    first: dict = {}
    numbers = np.fromiter(map(first.setdefault, words, range(len(words))), np.int64, len(words))
    catchers = Catchers()
    for k in range(0, len(numbers), APPENDED):
        catchers.append(numbers[k : k + APPENDED])
    return catchers.runs()


def without_repeats(words: list, runs: list) -> list:
    """Words without those that a run contains after its first period."""
    if not runs:
        return words
    keep = np.ones(len(words), bool)
    for start, length, q in runs:
        keep[start + q : start + length] = False
    return [words[i] for i in np.flatnonzero(keep).tolist()]


RUNS = "array<struct<start: long, length: long, period: long>>"


def collapse_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, runs, collapsed): periodic runs of a text's words and the text without
    their repetitions, kept words joined by one space.

    Words are separated by ASCII white space. A run has a smallest period q, at least 4 q and at
    least 6 words, and cannot be extended; runs stand in order of start and period, ``runs`` is
    never null. A null text is empty; a null id stays null; rows that repeat are answered each;
    an empty table gives no rows; other columns are not read. A text is read whole: its words are
    appended in pieces, and memory grows with the words of one text (their numbers, and two
    blocks of hashes for each power of two), not with the batch.

    No shuffle and no state across rows, so a hot source or a long text costs only its own words.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                count, found, kept = [], [], []
                for text in batch.column(1).slice(at, 256).to_pylist():
                    words = text.split()
                    runs = runs_of(words)
                    count.append(len(words))
                    found.append(runs)
                    kept.append(b" ".join(without_repeats(words, runs)).decode("utf-8", "replace"))
                start, length, period = (
                    pa.array([r[i] for runs in found for r in runs], pa.int64()) for i in range(3)
                )
                entries = pa.StructArray.from_arrays([start, length, period], ["start", "length", "period"])
                offsets = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(at, 256), pa.array(count, pa.int64()),
                    pa.ListArray.from_arrays(offsets, entries), pa.array(kept, pa.string()),
                ], ["doc_id", "n_words", "runs", "collapsed"])

    rows = docs.select("doc_id", whole_text().cast("binary").alias("text"))
    return rows.mapInArrow(run, f"doc_id {id_type}, n_words long, runs {RUNS}, collapsed string")


def repeated(text: Column, doc_id: Column) -> Column:
    """Of documents whose id's checksum divides by ten: the text with its end made periodic."""
    h = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    g = F.floor(h / 10)

    def made(words):
        n = F.size(words)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        tail = F.transform(F.sequence(a, n - 1), lambda i: F.get(words, a + (i - a) % p))
        whole = F.array_join(F.concat(F.slice(words, F.lit(1), a), tail), " ")
        return F.when(n > 0, whole).otherwise(text)

    # The words are a variable of an outer function, so that they are found once and not per word.
    words = F.array(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)))
    return F.when(h % 10 == 0, F.get(F.transform(words, made), F.lit(0))).otherwise(text)


def op13_periodic_runs(spark, sf_dir):
    """Run counts, the run of greatest exponent, and digests of the runs and the collapsed text."""
    docs = table(spark, sf_dir, "documents")
    docs = docs.select("doc_id", repeated(whole_text(), F.col("doc_id")).alias("text"))
    greatest = F.expr(
        "aggregate(slice(runs, 2, greatest(size(runs) - 1, 0)), get(runs, 0), (a, r) -> "
        "case when r.length * a.period > a.length * r.period then r else a end)"
    )
    lines = F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return collapse_runs(docs).withColumn("best", greatest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


#: Pairs of equal words at each distance up to a quarter of a text, joined to unbroken stretches.
OP13_SQL = r"""
with crc_table as (
    select list(c order by i) as entries from (
        select i, list_reduce(range(8), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, i) as c
        from range(256) as r(i)
    )
), hashed as (
    select row_number() over () as row, doc_id,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
           xor(list_reduce(list_transform(string_split(coalesce(doc_id::varchar, ''), ''), lambda x: ord(x)::bigint),
               lambda c, b: xor(c >> 8, entries[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) as h
    from documents, crc_table
), placed as (
    select *, len(w) as n, case when len(w) > 0 then (h // 10) % len(w) end as a from hashed
), periodic as (
    select row, doc_id, n,
           case when h % 10 = 0 and n > 0
                then list_transform(range(n), lambda i: case when i < a then w[i + 1]
                     else w[a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) + 1] end)
                else w end as w
    from placed
), words as (
    select row, n, unnest(range(n)) as i, unnest(w) as word from periodic
), equal as (
    select x.row, y.i - x.i as q, x.i from words x join words y
    on x.row = y.row and x.word = y.word and y.i > x.i and 4 * (y.i - x.i) <= x.n
), stretches as (
    select row, q, min(i) as start, count(*) + q as length
    from (select *, i - row_number() over (partition by row, q order by i) as island from equal)
    group by row, q, island having count(*) + q >= greatest(6, 4 * q)
), runs as (
    select row, start, length, min(q) as period from stretches group by row, start, length
), told as (
    select row, count(*) as n_runs,
           sha256(string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period)) as runs_sha256
    from runs group by row
), best as (
    select * from runs r where not exists (
        select 1 from runs s where s.row = r.row and (
            s.length * r.period > r.length * s.period
            or (s.length * r.period = r.length * s.period
                and (s.start < r.start or (s.start = r.start and s.period < r.period)))))
), kept as (
    select row, sha256(string_agg(word, ' ' order by i)) as collapsed_sha256
    from words w where not exists (
        select 1 from runs r where r.row = w.row and w.i >= r.start + r.period and w.i < r.start + r.length)
    group by row
)
select doc_id, coalesce(n_runs, 0) as n_runs, start, length, period,
       1000 * length // period as exponent_milli,
       coalesce(runs_sha256, sha256('')) as runs_sha256,
       coalesce(collapsed_sha256, sha256('')) as collapsed_sha256
from periodic left join told using (row) left join best using (row) left join kept using (row)
"""
