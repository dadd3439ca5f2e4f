"""Packing token sequences: repeat counts of length combinations by non-negative least squares."""

from __future__ import annotations

import os
import sys
import types
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eventloom.llm.common import stored, table, whole_text

WINDOW, END = 2_048, 1
#: Words a Python worker remembers the tokens of.
REMEMBERED = 600_000
#: Combinations listed for each length with a third one, and rounds of least squares.
THIRDS, ROUNDS = 24, 300


def worker_cache(vocabulary: str):
    """The tokenizer and the words seen so far; they outlive the task, as Python workers do."""
    from tokenizers import Tokenizer

    name = f"eventloom_worker_{zlib.crc32(vocabulary.encode()):08x}"
    if name not in sys.modules:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        module = types.ModuleType(name)
        module.tokenizer, module.words = Tokenizer.from_str(vocabulary), {}
        ends = np.zeros(module.tokenizer.get_vocab_size(), bool)
        ends[[i for w, i in module.tokenizer.get_vocab().items() if w.endswith("</w>")]] = True
        module.ends = ends
        sys.modules[name] = module
    return sys.modules[name]


def new_words(words: list[bytes], cache):
    """(word, ids) by the tokenizer. Words of letters alone go many at a time: each ends in the
    only token that closes a word. Where the count of these differs, as where lower case makes
    a mark of its own, they go one by one."""
    plain, other = [], []
    for word in words:
        text = word.decode("utf-8", "replace")
        (plain if text.isalpha() else other).append((word, text))
    for k in range(0, len(plain), 256):
        group = plain[k : k + 256]
        joined = cache.tokenizer.encode(" ".join([t for _, t in group]), add_special_tokens=False)
        ids = np.array(joined.ids, "<u2")
        last = 2 * (np.flatnonzero(cache.ends[ids]) + 1)
        if len(last) != len(group):
            other += group
            continue
        data, at = ids.tobytes(), 0
        for (word, _), end in zip(group, last.tolist()):
            yield word, data[at:end]
            at = end
    told = cache.tokenizer.encode_batch([t for _, t in other], add_special_tokens=False)
    for (word, _), encoding in zip(other, told):
        yield word, np.array(encoding.ids, "<u2").tobytes()


def token_bytes(texts: list[bytes], cache) -> list[bytes]:
    """Each text's ids as unsigned 16-bit numbers.

    The vocabulary is one of lower case and never joins characters across white space, so a
    text's ids are those of its words one after the other, and a word is tokenised when it is
    new. It also parts letters from signs: letters and a full stop or comma are two words.
    """
    split = [t.lower().split() for t in texts]
    known, new = cache.words, set()
    for words in split:
        new.update(set(words).difference(known))
    extra = {}
    if new:
        # Letters with a sign after them take over the ids of the letters alone.
        bases = {}
        for word in new:
            if word[-1:] in (b".", b",") and word[:-1].decode("utf-8", "replace").isalpha():
                bases[word] = word[:-1]
        missing = {*(new - bases.keys()), *(x for x in bases.values() if x not in known), b".", b","}
        extra = dict(new_words(sorted(missing), cache))
        for word, base in bases.items():
            extra[word] = (extra[base] if base in extra else known[base]) + extra[word[-1:]]
        if len(known) + len(extra) <= REMEMBERED:
            known.update(extra)
            extra = {}
    if not extra:
        return [b"".join(map(known.__getitem__, words)) for words in split]
    return [b"".join([known[w] if w in known else extra[w] for w in words]) for words in split]


def tokenised(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Pieces of at most a window, stored: whole windows first, then what remains.

    (piece, part, rank, doc_id, start, length, ids_crc32, doc_tokens, ids); ``rank`` numbers
    the pieces of a length within their task, ``ids`` is kept for pieces that may be cut.
    """
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"piece long, part int, rank long, doc_id {id_type}, start long, length int, "
        "ids_crc32 long, doc_tokens long, ids binary"
    )

    def run(batches):
        cache = worker_cache(sent.value)
        part = TaskContext.get().partitionId()
        piece, ranks = part << 40, np.zeros(WINDOW + 1, np.int64)
        end = np.array([END], "<u2").tobytes()
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                ids = batch.column(0).slice(k, 256)
                texts = batch.column(1).slice(k, 256).to_pylist()
                out, owner = [], []
                for row, short in enumerate(token_bytes(texts, cache)):
                    tokens = np.frombuffer(short + end, "<u2")
                    wide = tokens.astype("<u4")
                    n = len(tokens)
                    for start in range(0, n, WINDOW):
                        length = min(WINDOW, n - start)
                        cut = slice(start, start + length)
                        kept = tokens[cut].tobytes() if length < WINDOW else None
                        out.append(
                            (piece, int(ranks[length]), start, length,
                             zlib.crc32(wide[cut].tobytes()), n, kept)
                        )
                        owner.append(row)
                        piece += 1
                        ranks[length] += 1
                p, r, s, n, c, d, x = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(p, pa.int64()), pa.array([part] * len(p), pa.int32()),
                        pa.array(r, pa.int64()), ids.take(pa.array(owner)), pa.array(s, pa.int64()),
                        pa.array(n, pa.int32()), pa.array(c, pa.int64()), pa.array(d, pa.int64()),
                        pa.array(x, pa.binary()),
                    ],
                    names=["piece", "part", "rank", "doc_id", "start", "length", "ids_crc32",
                           "doc_tokens", "ids"],
                )

    rows = docs.select("doc_id", whole_text().cast("binary").alias("t"))
    return stored(rows.mapInArrow(run, schema), "pieces")


def combinations(histogram: np.ndarray) -> np.ndarray:
    """Shallow combinations that fill a window: rows of (length, times) for up to three lengths.

    A length taken several times, closed by nothing, by one length or by two.
    """
    there = np.flatnonzero(histogram)
    have = histogram > 0
    rows = set()
    for a in there.tolist():
        most = WINDOW // a
        for times in sorted({1, 2, 3, most - 1, most}):
            left = WINDOW - times * a
            if times < 1 or left < 0:
                continue
            if left == 0:
                rows.add(((a, times),))
            elif have[left]:
                rows.add(tuple(sorted(((a, times), (left, 1)))) if left != a else ((a, times + 1),))
            if times > 2 or left < 2:
                continue
            seconds = there[there <= left // 2]
            step = max(1, len(seconds) // THIRDS)
            for b in seconds[a % step :: step].tolist():
                c = left - b
                if have[c]:
                    times_of: dict[int, int] = {}
                    for length, m in ((a, times), (b, 1), (c, 1)):
                        times_of[length] = times_of.get(length, 0) + m
                    rows.add(tuple(sorted(times_of.items())))
    out = np.zeros((len(rows), 6), np.int64)
    for k, row in enumerate(sorted(rows)):
        out[k, : 2 * len(row)] = np.array(row).ravel()
    return out


def least_squares(columns: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """x >= 0 that brings ``columns`` x near ``wanted``: accelerated projected gradient."""
    index, times = columns[:, 0::2], columns[:, 1::2].astype(float)

    def forth(x):
        return np.bincount(index.ravel(), (times * x[:, None]).ravel(), len(wanted))

    def back(r):
        return (times * r[index]).sum(axis=1)

    x = np.ones(len(columns))
    for _ in range(20):
        x = back(forth(x))
        norm = np.linalg.norm(x)
        x /= norm or 1
    bound = 1.05 * norm
    x = y = np.zeros(len(columns))
    t = 1.0
    for _ in range(ROUNDS):
        step = np.maximum(0, y - back(forth(y) - wanted) / bound)
        grown = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y = step + (t - 1) / grown * (step - x)
        x, t = step, grown
    return x


class Plan:
    """Where the k-th piece of each length goes. Its size is bounded by the window.

    ``entries`` are ranges of pieces of one length: those of a combination's slot (``times``
    a sequence, from ``slot`` on), or a residual run that is laid end to end (times 0).
    """

    def __init__(self, histogram: np.ndarray):
        left = histogram.astype(object)
        used = np.zeros(WINDOW + 1, object)
        entries, sequence = [], 0

        def take(length, count, times, first, slot):
            entries.append((length, int(used[length]), times, first, slot))
            used[length] += count
            left[length] -= count

        if left[WINDOW]:
            count = int(left[WINDOW])
            take(WINDOW, count, 1, 0, 0)
            sequence = count
        short = histogram.copy()
        short[WINDOW] = 0
        columns = combinations(short)
        if len(columns):
            solved = np.floor(least_squares(columns, short.astype(float)) + 1e-6).astype(np.int64)
            free = short.astype(np.int64)
            counts = np.zeros(len(columns), np.int64)
            # First the solved counts, as far as pieces last, then what is left for any.
            for wanted in (solved, None):
                order = np.argsort(-solved, kind="stable")
                for c in order.tolist():
                    row = columns[c]
                    parts = [(int(row[k]), int(row[k + 1])) for k in (0, 2, 4) if row[k + 1]]
                    most = min(int(free[n]) // m for n, m in parts)
                    n_times = most if wanted is None else min(most, int(wanted[c]))
                    if n_times > 0:
                        counts[c] += n_times
                        for n, m in parts:
                            free[n] -= n_times * m
            for c in np.flatnonzero(counts).tolist():
                row, n_times, slot = columns[c], int(counts[c]), 0
                for k in (0, 2, 4):
                    n, m = int(row[k]), int(row[k + 1])
                    if m:
                        take(n, n_times * m, m, sequence, slot)
                        slot += n * m
                sequence += n_times
        # Greedy rest: longest first, end to end, cut where a window is full.
        self.residual, laid = sequence, 0
        for length in range(WINDOW - 1, 0, -1):
            if left[length]:
                count = int(left[length])
                take(length, count, 0, laid, 0)
                laid += count * length
        self.laid = laid
        # The last window ends in powers of two, which are not padded.
        self.tail, self.tail_cuts, rest = laid // WINDOW * WINDOW, [0], laid % WINDOW
        while rest:
            power = 1 << (rest.bit_length() - 1)
            self.tail_cuts.append(self.tail_cuts[-1] + power)
            rest -= power
        entries.sort()
        table = np.array(entries, np.int64).reshape(-1, 5)
        self.keys = (table[:, 0] << 48) + table[:, 1]
        self.length, self.start, self.times, self.first, self.slot = table.T

    def place(self, length: np.ndarray, number: np.ndarray):
        """(piece row, from, length, sequence, offset) of all parts, for arrays of pieces."""
        entry = np.searchsorted(self.keys, (length.astype(np.int64) << 48) + number, "right") - 1
        times, within = self.times[entry], number - self.start[entry]
        each = np.maximum(times, 1)
        sequence = self.first[entry] + within // each
        offset = self.slot[entry] + within % each * length
        rows = np.arange(len(length))
        start, size = np.zeros(len(rows), np.int64), length.astype(np.int64)
        loose = np.flatnonzero(times == 0)
        if len(loose):
            position = self.first[entry[loose]] + within[loose] * length[loose]
            parts = [
                (r, *part)
                for r, p, n in zip(loose.tolist(), position.tolist(), length[loose].tolist())
                for part in self.laid_out(p, n)
            ]
            extra = np.array(parts, np.int64).T
            firm = times != 0
            rows, start, size, sequence, offset = (
                np.concatenate([a[firm], b])
                for a, b in zip((rows, start, size, sequence, offset), extra)
            )
        return rows, start, size, sequence, offset

    def laid_out(self, position, length):
        """Parts of a piece laid at ``position`` of the residual run."""
        start = 0
        while start < length:
            at = position + start
            if at < self.tail:
                room, sequence = WINDOW - at % WINDOW, self.residual + at // WINDOW
                offset = at % WINDOW
            else:
                k = int(np.searchsorted(self.tail_cuts, at - self.tail, "right"))
                room = self.tail + self.tail_cuts[k] - at
                sequence = self.residual + self.tail // WINDOW + k - 1
                offset = at - self.tail - self.tail_cuts[k - 1]
            size = min(room, length - start)
            yield start, size, sequence, offset
            start += size


def pack(docs: DataFrame, vocabulary: str) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document's tokens end in id 1; a null or empty text is that id alone. Long documents
    give whole windows; what remains fills windows by combinations of up to three lengths
    whose repeat counts solve a non-negative least squares problem against the histogram of
    lengths. Pieces no combination takes are laid end to end and cut where a window is full.
    A table that is empty gives no rows; rows that repeat a document are packed as they come;
    further columns are not read.

    The driver sees the histogram (2,048 counts). The plan is arithmetic: the k-th piece of a
    length has a place, and k is the piece's rank in its task plus the tasks' sums before it.
    """
    pieces = tokenised(docs.select("doc_id", "text"), vocabulary)
    counts = stored(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "piece-counts")
    histogram = np.zeros(WINDOW + 1, np.int64)
    for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():
        histogram[r.length] = r.n
    plan = docs.sparkSession.sparkContext.broadcast(Plan(histogram))
    before = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(
        "part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")
    )
    numbered = pieces.drop("ids").join(offsets, ["part", "length"])
    rest = ["doc_id", "start", "ids_crc32", "doc_tokens"]

    def run(batches):
        for batch in batches:
            length = batch.column("length").to_numpy()
            number = batch.column("rank").to_numpy() + batch.column("before").to_numpy()
            row, start, size, sequence, offset = plan.value.place(length, number)
            took = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("piece").take(took),
                    *[batch.column(c).take(took) for c in rest],
                    pa.array(start), pa.array(size), pa.array(sequence), pa.array(offset),
                    pa.array(size != length[row]),
                ],
                names=["piece", *rest, "skip", "length", "sequence_id", "offset", "cut"],
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    kinds = (
        f"piece long, doc_id {id_type}, start long, ids_crc32 long, doc_tokens long, skip long, "
        "length long, sequence_id long, offset long, cut boolean"
    )
    placed = stored(
        numbered.select("piece", "length", "rank", "before", *rest).mapInArrow(run, kinds), "placed"
    )
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    parts = placed.where("cut").drop("ids_crc32").join(
        pieces.where(f"length < {WINDOW}").select("piece", "ids"), "piece"
    )

    def again(batches):
        for batch in batches:
            crc = [
                zlib.crc32(np.frombuffer(i, "<u2")[s : s + n].astype("<u4").tobytes())
                for i, s, n in zip(*(batch.column(c).to_pylist() for c in ("ids", "skip", "length")))
            ]
            start = batch.column("start").to_numpy() + batch.column("skip").to_numpy()
            new = {"start": pa.array(start), "ids_crc32": pa.array(crc, pa.int64())}
            yield pa.RecordBatch.from_arrays(
                [new[c] if c in new else batch.column(c) for c in columns], names=columns
            )

    final = placed.where("not cut").select(columns)
    return final.unionByName(parts.mapInArrow(again, final.schema))


def word_vocabulary() -> str:
    """The file of the contract's tokenizer, as text."""
    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        return file.read()


def op4_nnls_packing(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"), word_vocabulary())
