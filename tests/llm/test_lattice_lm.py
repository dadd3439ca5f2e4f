import itertools
import math
import zlib
from collections import Counter

import public_tokenizers
import pytest

from eventloom.llm import lattice_lm as lm

SF = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")


def plain_base(rows):
    """[(doc_id, n_tokens, n_known, N, base)] by the definition."""
    counts, end = Counter(), 0
    lists = []
    for d, t in rows:
        words = (t or "").encode().lower().split()
        key = "" if d is None else str(d)
        held = zlib.crc32(key.encode()) % 7 == 2
        lists.append((d, held, words))
        if not held:
            counts.update(words)
            end += 1
    n, v = counts.total() + end, len(counts) + (end > 0)
    out = []
    for d, held, words in lists:
        cs = [counts[w] for w in words] + [end]
        base = sum(math.log10((c + 1) / (n + v + 1)) for c in cs)
        out.append((d, held, len(cs), sum(c > 0 for c in cs), n, base))
    return out


def compare(spark, rows):
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, n int, word string")
    got = lm.lm_scores(docs, VOCABULARY).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[5])
    got.sort(key=key)
    wanted = sorted(plain_base(rows), key=key)
    assert len(got) == len(wanted)
    for g, w in zip(got, wanted):
        assert tuple(g)[:5] == w[:5]
        assert g.base_score == pytest.approx(w[5], rel=1e-9)
        assert math.isfinite(g.score) and g.score < 0
    return got


def test_sample_against_the_definition(spark, monkeypatch):
    monkeypatch.setattr(lm, "FREQUENT", 50)
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    compare(spark, [tuple(r) for r in rows])


def test_edge_cases(spark):
    rows = [(1, None), (1, None), (2, ""), (None, "a b a"), (3, "A \x0b b c " * 3000), (4, "世\U0001f600")]
    rows += [(5, "x" * 5000)]
    compare(spark, rows)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert lm.lm_scores(empty, VOCABULARY).count() == 0


def all_paths(pieces, word):
    """Summed probability of the word over all segmentations, by trying every cut."""
    total = 0.0
    for cuts in itertools.product([0, 1], repeat=len(word) - 1):
        parts, start = [], 0
        for k, cut in enumerate(cuts, 1):
            if cut:
                parts.append(word[start:k])
                start = k
        parts.append(word[start:])
        p = 1.0
        for part in parts:
            if pieces.table.get(part) is not None:
                p *= math.exp(pieces.table[part])
            elif len(part) == 1:
                p *= math.exp(sum(pieces.byte_weights[b] for b in part.encode()))
            else:
                p = 0
        total += p
    return total


def test_forward_recursion_sums_all_segmentations():
    pieces = lm.Pieces.existing(VOCABULARY)
    for word in ("▁the", "▁nation", "▁世ab", "▁x", "▁"):
        assert pieces.likelihood(word) == pytest.approx(math.log(all_paths(pieces, word)))


def test_expected_counts_cover_the_word():
    pieces, counts = lm.Pieces.existing(VOCABULARY), Counter()
    pieces.expect("▁nations", 3, counts)
    assert sum(len(p) * n for p, n in counts.items()) == pytest.approx(3 * 8)
    better = pieces.learned(counts, 1)
    assert better.likelihood("▁nations") > pieces.likelihood("▁nations")


def test_score_is_the_sum_of_words_and_end(spark, monkeypatch):
    rows = [(k, f"river stone {'cold ' * k}") for k in range(1, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    with_hot = {r.doc_id: r.score for r in lm.lm_scores(docs, VOCABULARY).collect()}
    monkeypatch.setattr(lm, "FREQUENT", 0)
    without = {r.doc_id: r.score for r in lm.lm_scores(docs, VOCABULARY).collect()}
    for k in with_hot:
        assert with_hot[k] == pytest.approx(without[k])
    steps = [with_hot[k + 1] - with_hot[k] for k in range(1, 8)]
    assert max(steps) - min(steps) < 1e-9
