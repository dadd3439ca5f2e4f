"""Language-model scores: the marginal likelihood of a text over all subword segmentations."""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import remainder, stored, table, whole_text

FOLDS, HELD_OUT = 7, 2
#: Frequent words whose figures travel with the tasks; their number and length bound the size.
FREQUENT, FREQUENT_BYTES = 65_536, 64
#: Distinct words a task counts before it hands on what it has.
HELD_WORDS = 400_000
#: Rounds of expectation maximisation over the corpus, and each piece's count beforehand.
ROUNDS, PRIOR = 1, 0.1
LOG10 = math.log(10)


class Pieces:
    """A subword vocabulary with a natural log weight for each piece, byte and the end."""

    def __init__(self, names, weights, byte_weights, end):
        self.names, self.weights = names, weights
        self.byte_weights, self.end = byte_weights, end
        self._index()

    def _index(self):
        #: Weight of a piece; None for what only begins one.
        self.table = {n[:k]: None for n in self.names for k in range(1, len(n))}
        self.table.update(zip(self.names, self.weights))

    def __getstate__(self):
        return self.names, self.weights, self.byte_weights, self.end

    def __setstate__(self, state):
        self.names, self.weights, self.byte_weights, self.end = state
        self._index()

    @classmethod
    def existing(cls, path):
        """Weights from a vocabulary file. Its scores are read as ranks, best first, and a
        piece's weight follows Zipf's law; the end weighs as much as the best piece."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        names, scores = [], []
        for k in range(model.get_piece_size()):
            if model.is_control(k) or model.is_unknown(k) or model.is_byte(k) or model.is_unused(k):
                continue
            names.append(model.id_to_piece(k))
            scores.append(model.get_score(k))
        rank = np.empty(len(scores))
        rank[np.argsort(-np.array(scores), kind="stable")] = np.arange(len(scores))
        mass = 1 / (rank + 3)
        total = mass.sum() + mass.max() + 256 * mass.min()
        low = math.log(mass.min() / total)
        return cls(names, np.log(mass / total).tolist(), [low] * 256, math.log(mass.max() / total))

    def edges(self, word):
        """For each place of the word the pieces that start there: (end, weight, piece).

        A character that is no piece may be spelled by its bytes, so every word has a path.
        """
        find, n = self.table.get, len(word)
        out = []
        for i in range(n):
            here = []
            for j in range(i + 1, n + 1):
                part = word[i:j]
                weight = find(part, 1)
                if weight is None:
                    continue
                if weight == 1:
                    break
                here.append((j, weight, part))
            if not here or here[0][0] != i + 1:
                spelled = word[i].encode()
                here.append((i + 1, sum(self.byte_weights[b] for b in spelled), spelled))
            out.append(here)
        return out

    def likelihood(self, word):
        """Natural log of the summed weights of all segmentations (log-space forward pass)."""
        return self.forward(self.edges(word))[-1]

    @staticmethod
    def forward(edges):
        exp, log = math.exp, math.log
        n = len(edges)
        reach = [None] * (n + 1)
        alpha = [0.0] * (n + 1)
        a = 0.0
        for i in range(n):
            for j, weight, _ in edges[i]:
                t = a + weight
                other = reach[j]
                if other is None:
                    reach[j] = t
                elif other > t:
                    reach[j] = other + log(1.0 + exp(t - other))
                else:
                    reach[j] = t + log(1.0 + exp(other - t))
            alpha[i + 1] = a = reach[i + 1]
        return alpha

    def expect(self, word, times, counts):
        """Add to ``counts`` how often each piece is used in the word, over all segmentations."""
        exp, log = math.exp, math.log
        edges = self.edges(word)
        alpha = self.forward(edges)
        n = len(edges)
        whole = alpha[n]
        beta = [0.0] * (n + 1)
        for i in range(n - 1, -1, -1):
            a = alpha[i] - whole
            total = None
            for j, w, piece in edges[i]:
                t = w + beta[j]
                if total is None:
                    total = t
                elif total > t:
                    total += log(1.0 + exp(t - total))
                else:
                    total = t + log(1.0 + exp(total - t))
                share = times * exp(a + t)
                if piece.__class__ is bytes:
                    for b in piece:
                        counts[b] += share
                else:
                    counts[piece] += share
            beta[i] = total

    def learned(self, counts, ends):
        """Weights from expected counts (bytes by number) and the number of texts."""
        masses = np.array([counts.get(n, 0.0) for n in self.names]) + PRIOR
        low = np.array([counts.get(b, 0.0) for b in range(256)]) + PRIOR
        total = masses.sum() + low.sum() + ends + PRIOR
        return Pieces(
            self.names, np.log(masses / total).tolist(), np.log(low / total).tolist(),
            math.log((ends + PRIOR) / total),
        )


def marked(word: bytes) -> str:
    """A word as the vocabulary writes it, with the sign of a word's start."""
    return "▁" + word.decode("utf-8", "replace")


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, c): every word of any text, and how often training texts have it (maybe never)."""
    rows = docs.select(
        whole_text().cast("binary").alias("t"),
        (remainder("doc_id", FOLDS) != HELD_OUT).alias("taught"),
    )

    def run(batches):
        seen = Counter()

        def told():
            return pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())],
                names=["word", "c"],
            )

        for batch in batches:
            for text, taught in zip(batch.column("t"), batch.column("taught").to_pylist()):
                words = text.as_py().lower().split()
                if taught:
                    seen.update(words)
                else:
                    for w in words:
                        seen.setdefault(w, 0)
                if len(seen) > HELD_WORDS:
                    yield told()
                    seen.clear()
        yield told()

    parts = rows.mapInArrow(run, "word binary, c long")
    return stored(parts.groupBy("word").agg(F.sum("c").alias("c")), "lm-words")


def taught_pieces(words: DataFrame, start: Pieces, ends: int) -> Pieces:
    """Piece weights fitted to all training words by expectation maximisation.

    A task sums expected counts over its words and gives one row per piece, so what is
    shuffled and what reaches the driver is bounded by the vocabulary.
    """
    pieces = start
    for _ in range(ROUNDS):
        sent = words.sparkSession.sparkContext.broadcast(pieces)

        def run(batches, sent=sent):
            model, counts = sent.value, defaultdict(float)
            for batch in batches:
                for w, c in zip(batch.column("word").to_pylist(), batch.column("c").to_pylist()):
                    model.expect(marked(w), c, counts)
            pieces = {k: v for k, v in counts.items() if isinstance(k, str)}
            spelled = {k: v for k, v in counts.items() if not isinstance(k, str)}
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([*pieces, *[None] * len(spelled)], pa.string()),
                    pa.array([*[None] * len(pieces), *spelled], pa.int32()),
                    pa.array([*pieces.values(), *spelled.values()], pa.float64()),
                ],
                names=["piece", "byte", "n"],
            )

        parts = words.where("c > 0").mapInArrow(run, "piece string, byte int, n double")
        rows = parts.groupBy("piece", "byte").agg(F.sum("n").alias("n")).collect()
        counts = {r.byte if r.piece is None else r.piece: r.n for r in rows}
        pieces = pieces.learned(counts, ends)
        sent.unpersist()
    return pieces


def lm_scores(docs: DataFrame, vocabulary: str) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``base_score`` is the add-one word unigram of the training texts. ``score`` is log10 of the
    text's probability under the lattice model: every word, and one end, is drawn from the
    pieces of an existing vocabulary, summed over all segmentations. A null text is empty and
    still has its end; words of any length are scored whole; characters outside the vocabulary
    are spelled by bytes. A null id counts as empty text when folds are dealt. Repeated rows
    are rows of their own; an empty table gives no rows; further columns are not read.

    Frequent words (a bounded number) are settled where the text is read; all others are
    joined with the words' table, one row per document and distinct word.
    """
    docs = docs.select("doc_id", "text")
    spark = docs.sparkSession
    words = word_counts(docs)
    ends = docs.where(remainder("doc_id", FOLDS) != HELD_OUT).count()
    told = words.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count_if(F.col("c") > 0).alias("v")).first()
    tokens, kinds = told.n + ends, told.v + (ends > 0)
    below = math.log10(tokens + kinds + 1)
    sent = spark.sparkContext.broadcast(taught_pieces(words, Pieces.existing(vocabulary), ends))

    def weigh(batches):
        model = sent.value
        for batch in batches:
            found = [model.likelihood(marked(w)) / LOG10 for w in batch.column("word").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("word"), batch.column("c"), pa.array(found, pa.float64())],
                names=["word", "c", "weight"],
            )

    weighed = stored(words.mapInArrow(weigh, "word binary, c long, weight double"), "lm-weights")
    frequent = (
        weighed.where(F.length("word") <= FREQUENT_BYTES)
        .orderBy(F.desc("c"), "word")
        .limit(FREQUENT)
        .collect()
    )
    hot = spark.sparkContext.broadcast(
        {bytes(r.word): (r.c > 0, math.log10(r.c + 1) - below, r.weight) for r in frequent}
    )
    end_base = math.log10((ends if ends else 0) + 1) - below
    end_known = int(ends > 0)
    rows = docs.select(
        "doc_id",
        (remainder("doc_id", FOLDS) == HELD_OUT).alias("held_out"),
        whole_text().cast("binary").alias("t"),
    )

    def settle(batches):
        known = hot.value
        end_weight = sent.value.end / LOG10
        number = TaskContext.get().partitionId() << 40
        rest_type = pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())]))
        for batch in batches:
            n_tokens, n_known, base, score, rest = [], [], [], [], []
            for text in batch.column("t"):
                counts = Counter(text.as_py().lower().split())
                k, b, s, others = end_known, end_base, end_weight, []
                for word, n in counts.items():
                    got = known.get(word)
                    if got is None:
                        others.append({"word": word, "n": n})
                    else:
                        k += n * got[0]
                        b += n * got[1]
                        s += n * got[2]
                n_tokens.append(counts.total() + 1)
                n_known.append(k)
                base.append(b)
                score.append(s)
                rest.append(others)
            numbers = np.arange(number, number + batch.num_rows)
            number += batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(numbers), batch.column("doc_id"), batch.column("held_out"),
                    pa.array(n_tokens, pa.int64()), pa.array(n_known, pa.int64()),
                    pa.array(base, pa.float64()), pa.array(score, pa.float64()),
                    pa.array(rest, rest_type),
                ],
                names=["row", "doc_id", "held_out", "n_tokens", "k", "b", "s", "rest"],
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    part = stored(
        rows.mapInArrow(
            settle,
            f"row long, doc_id {id_type}, held_out boolean, n_tokens long, k long, b double, "
            "s double, rest array<struct<word: binary, n: long>>",
        ),
        "lm-documents",
    )
    others = part.select("row", F.inline("rest")).join(weighed, "word")
    n = F.col("n")
    sums = others.groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, n).otherwise(0)).alias("k2"),
        F.sum(n * (F.log10(F.col("c") + 1.0) - below)).alias("b2"),
        F.sum(n * F.col("weight")).alias("s2"),
    )

    def plus(a, b):
        return F.col(a) + F.coalesce(F.col(b), F.lit(0))

    return part.drop("rest").join(sums, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        plus("k", "k2").alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        plus("b", "b2").alias("base_score"),
        plus("s", "s2").alias("score"),
    )


def op7_lattice_lm(spark, sf_dir):
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    return lm_scores(docs, public_tokenizers.path("piece_bpe_32k.model"))
