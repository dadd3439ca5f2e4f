"""Quality scores learned from preference pairs (Bradley-Terry), cut at a score quantile."""

from __future__ import annotations

import math
from itertools import count
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import fresh, remainder, table, whole_text

#: Labelled rows a model is fitted on at most, those with the smallest hash of their id.
FIT_ROWS = 20_000
#: Opponents that each labelled document meets at most.
OPPONENTS = 24
RIDGE = 1e-3
CUT = 0.3
FOLDS = 5
#: Words of a stretch whose variety is read.
WINDOW = 50

_SIGNS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
FEATURES = 20 + len(_SIGNS)


def window_variety(codes: np.ndarray, width: int) -> np.ndarray:
    """Share of distinct words in every window of ``width`` words, at each place of the text.

    A word counts in a window if it has not come before in it: from just after its previous
    place, or where the window first reaches it, up to its own place.
    """
    n = len(codes)
    order = np.argsort(codes, kind="stable")
    again = codes[order[1:]] == codes[order[:-1]]
    before = np.full(n, -1)
    before[order[1:][again]] = order[:-1][again]
    own = np.arange(n)
    low = np.maximum(before, own - width) + 1
    change = np.bincount(np.maximum(low, 0), minlength=n + 1)
    change -= np.bincount(own + 1, minlength=n + 1)
    return np.cumsum(change)[: n - width + 1] / width


def features(text: bytes) -> np.ndarray:
    """Numbers that describe the writing of a whole text; all are zero for an empty text."""
    out = np.zeros(FEATURES)
    words = text.split()
    n = len(words)
    if not n:
        return out
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    chars = len(text)
    lengths = np.fromiter(map(len, words), np.int64, n)
    lines = text.split(b"\n")
    filled = [x for x in lines if x.strip()]
    # A word's code is the place where it is first seen.
    places: dict = {}
    codes = np.fromiter(map(places.setdefault, words, count()), np.int64, n)
    unique = len(places)
    local = window_variety(codes, min(n, WINDOW))
    signs = counts[list(_SIGNS)]
    out[:20] = (
        math.log1p(n),
        math.log1p(len(filled)),
        lengths.mean(),
        lengths.std(),
        math.log1p(int(lengths.max())),
        (lengths <= 3).mean(),
        unique / n,
        math.log(unique) / math.log(n) if n > 1 else 1.0,
        local.min(),
        local.mean(),
        sum(map(eq, words, words[1:])) / n,
        sum(map(bytes.isupper, words)) / n,
        sum(map(bytes.istitle, words)) / n,
        sum(map(bytes.isalpha, words)) / n,
        counts[48:58].sum() / chars,
        counts[65:91].sum() / chars,
        counts[128:].sum() / chars,
        signs.sum() / chars,
        len(set(filled)) / max(1, len(filled)),
        sum(x.rstrip().endswith((b".", b"!", b"?")) for x in filled) / max(1, len(filled)),
    )
    out[20:] = np.sqrt(signs / n)
    return out


def pairs(labels: np.ndarray, seed: int = 11):
    """(better, worse) row numbers: every row meets up to ``OPPONENTS`` of the other label."""
    rng = np.random.default_rng(seed)
    good, bad = np.flatnonzero(labels == 1), np.flatnonzero(labels == 0)
    if not len(good) or not len(bad):
        return np.zeros(0, int), np.zeros(0, int)
    better = [np.repeat(good, OPPONENTS), rng.choice(good, OPPONENTS * len(bad))]
    worse = [rng.choice(bad, OPPONENTS * len(good)), np.repeat(bad, OPPONENTS)]
    return np.concatenate(better), np.concatenate(worse)


def bradley_terry(x: np.ndarray, better: np.ndarray, worse: np.ndarray) -> np.ndarray:
    """Weights w that minimise the mean of log(1 + exp(-w (x_better - x_worse))), by Newton."""
    w = np.zeros(x.shape[1])
    if not len(better):
        return w
    for _ in range(30):
        slope, curve = -RIDGE * w, RIDGE * np.eye(len(w))
        for k in range(0, len(better), 32_768):
            differ = x[better[k : k + 32_768]] - x[worse[k : k + 32_768]]
            p = 1 / (1 + np.exp(np.clip(differ @ w, -40, 40)))
            slope += differ.T @ p / len(better)
            curve += (differ * (p * (1 - p))[:, None]).T @ differ / len(better)
        step = np.linalg.solve(curve, slope)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


class Model:
    """Weights, and the raw score at which a document is as likely good as the labels' share."""

    def __init__(self, x: np.ndarray, labels: np.ndarray):
        if len(x):
            self.mean, self.scale = x.mean(axis=0), x.std(axis=0)
        else:
            self.mean, self.scale = np.zeros(FEATURES), np.zeros(FEATURES)
        self.scale[self.scale < 1e-9] = 1.0
        z = self.standard(x) if len(x) else np.zeros((0, FEATURES))
        self.weights = bradley_terry(z, *pairs(labels))
        raw = z @ self.weights
        share = float((labels == 0).mean()) if len(labels) else 0.0
        # The quantile that leaves as many below it as the labels call bad.
        self.cut = float(np.quantile(raw, share, method="midpoint")) if len(raw) else 0.0

    def standard(self, x):
        return np.clip((x - self.mean) / self.scale, -8, 8)

    def score(self, x: np.ndarray) -> np.ndarray:
        """In (0, 1); the quantile cut lies at ``CUT``."""
        raw = self.standard(x) @ self.weights - self.cut + math.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(raw, -40, 40)))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from the labelled documents whose crc32 of the id leaves a remainder.

    Of several labels of one id the lower counts, null labels do not. At most ``FIT_ROWS``
    labelled ids are taken (smallest hash first, a top-k), so what is broadcast and what reaches
    the driver is bounded: ids, then one row of features for each of them.
    """
    taught = (
        labels.where("doc_id is not null and quality is not null")
        .where(remainder("doc_id", FOLDS) != 0)
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(FIT_ROWS)
    )
    texts = docs.select("doc_id", whole_text().cast("binary").alias("t")).join(
        F.broadcast(taught), "doc_id"
    )

    def run(frames):
        for frame in frames:
            yield pd.DataFrame({
                "h": frame["h"],
                "doc_id": frame["doc_id"],
                "quality": frame["quality"].astype("int32"),
                "x": [features(t) for t in frame["t"]],
            })

    rows = texts.select("doc_id", "quality", "t", F.xxhash64("t").alias("h")).mapInPandas(
        run, "h long, doc_id long, quality int, x array<double>"
    )
    # One text for an id, however often the id repeats.
    found = rows.groupBy("doc_id").agg(F.min(F.struct("h", "quality", "x")).alias("r"))
    got = found.select("doc_id", "r.quality", "r.x").toPandas().sort_values("doc_id")
    x = np.stack(got["x"].to_list()) if len(got) else np.zeros((0, FEATURES))
    return Model(x, got["quality"].to_numpy())


def scored(docs: DataFrame, model: Model, text: str, score: str) -> DataFrame:
    """All rows and columns, and ``score``: row by row, nothing is shuffled."""

    @F.pandas_udf("double")
    def judge(texts: pd.Series) -> pd.Series:
        x = np.stack([features(t) for t in texts]) if len(texts) else np.zeros((0, FEATURES))
        return pd.Series(model.score(x))

    return docs.withColumn(score, judge(whole_text(text).cast("binary")))


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    The score depends on the text alone. A null text counts as empty; a null id counts as empty
    text when folds are dealt. Without usable labels of both kinds every score is 0.3. Repeated
    rows are scored alike; an empty table gives no rows; further columns are not read.
    """
    model = fit(docs, labels)
    rows = scored(docs.select("doc_id", "text"), model, "text", "score")
    return rows.select(
        "doc_id",
        (remainder("doc_id", FOLDS) == 0).alias("held_out"),
        "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier does not reject, with all their columns."""
    score = fresh(docs, "score")
    return scored(docs, fit(docs, labels), "text", score).where(F.col(score) >= CUT).drop(score)


def op10_quality(spark, sf_dir):
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
