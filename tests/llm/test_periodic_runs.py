import hashlib
import random
import zlib

import duckdb
import numpy as np

from compare import compare
from eventloom.llm import periodic_runs as pr


def plain(words):
    """The definition: every period, every stretch, smallest periods only."""
    n, runs = len(words), set()
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            piece = words[i : j + q]
            smaller = any(piece[p:] == piece[:-p] for p in range(1, q))
            if len(piece) >= max(6, 4 * q) and not smaller:
                runs.add((i, len(piece), q))
            i = j
    return sorted(runs, key=lambda r: (r[0], r[2]))


def samples():
    rng = random.Random(13)
    out = [list("a" * n) for n in range(14)] + [list("ab" * 9), list("abaab" * 8 + "aba")]
    for _ in range(500):
        words = []
        while len(words) < rng.randrange(1, 160):
            unit = [rng.choice("ab" if rng.random() < 0.4 else "abcdef") for _ in range(rng.randrange(1, 12))]
            words += (unit * rng.randrange(1, 9))[: rng.randrange(1, 80)]
        out.append(words)
    fibonacci = ["a", "ab"]
    for _ in range(10):
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    return [*out, list(fibonacci[-1]), list("ab" * 3 + "c") * 40, list("abc" * 200 + "x" + "abc" * 200)]


def test_runs_equal_the_definition():
    for words in samples():
        assert pr.runs_of(words) == plain(words), "".join(words)


def test_appended_word_by_word_or_in_pieces():
    rng = random.Random(14)
    for words in samples()[::4]:
        numbers = np.array([ord(w) for w in words], np.int64)
        single, pieces = pr.Catchers(), pr.Catchers()
        for k in range(len(numbers)):
            single.append(numbers[k : k + 1])
            if k % 9 == 0:
                assert single.runs() == plain(words[: k + 1])
        at = 0
        while at < len(numbers):
            step = rng.randrange(1, 40)
            pieces.append(numbers[at : at + step])
            at += step
        assert single.runs() == pieces.runs() == plain(words)


def test_memory_of_hashes_follows_the_blocks():
    catchers = pr.Catchers()
    for _ in range(40):
        catchers.append(np.arange(1_000) + len(catchers.words))
    assert all(len(level.hashes) <= 3 * level.size for level in catchers.levels[:-1])


def check(doc_id, text):
    """The contract for one document, from the definition."""
    words = (text or "").encode().split()
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain(words)
    drop = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = (None,) * 3
    for r in runs:
        if best[0] is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (
        doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
        sha("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()),
        sha(b" ".join(w for i, w in enumerate(words) if i not in drop)),
    )


def test_query_on_awkward_rows(spark, tmp_path):
    rng = random.Random(15)
    rows = [(None, "a b " * 12, 1), (1, None, 2), (1, None, 2), (2, "", 3), (3, " \t\n ", 4), (4, "x" * 9_000, 5)]
    rows += [(k, " ".join(rng.choice("ab") for _ in range(rng.randrange(1, 90))), k) for k in range(5, 160)]
    rows += [(200, "la " * 500, 1), (201, "é è\u000bù " * 30, 1), (202, "la " * 500, 1)]
    sf = str(tmp_path)
    spark.createDataFrame(rows, "doc_id long, text string, n_words int").write.parquet(f"{sf}/documents.parquet")
    got = sorted(map(tuple, pr.op13_periodic_runs(spark, sf).collect()), key=repr)
    assert got == sorted((check(d, t) for d, t, _ in rows), key=repr)
    none = spark.createDataFrame([], "doc_id string, text string")
    assert pr.collapse_runs(none).collect() == []


def test_query_equals_its_sql(spark):
    sf = "/root/testdata/sf0.001"
    db = duckdb.connect()
    db.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    assert compare(pr.op13_periodic_runs(spark, sf), db, pr.OP13_SQL) is None
