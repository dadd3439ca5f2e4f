import pandas as pd
import xxhash

from eventloom.llm import simhash as sh

SF = "/root/testdata/sf0.001"


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    n = max(1, len(words) - 2)
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[k : k + 3]), 42) for k in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """prints: [(doc_id, fp)]; the smallest doc_id that links reach, by flooding."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= 2:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for k, (d, _) in enumerate(prints):
        r = find(k)
        least[r] = min(least.get(r, d), d)
    return [least[find(k)] for k in range(len(prints))]


def check(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string, row int")
    got = sorted((r.doc_id, r.fingerprint, r.component_id) for r in sh.simhash(docs).collect())
    prints = [(r[0], plain_fingerprint(r[1])) for r in rows]
    wanted = sorted(
        (d, f"{f:016x}", c) for (d, f), c in zip(prints, plain_components(prints))
    )
    assert got == wanted


def test_against_all_pairs_of_the_sample(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    check(spark, [(r.doc_id, r.text, "x", 1) for r in rows])


def test_edge_cases(spark):
    base = " ".join(f"w{k}" for k in range(400))
    rows = [(k, base.replace(f"w{k * 7} ", f"v{k} "), None, None) for k in range(40)]
    rows += [(100, None, None, None), (101, "", None, None), (102, " \t\n", None, None)]
    rows += [(103, "one", None, None), (104, "ONE", None, None), (105, "one two", None, None)]
    rows += [(106, "word " * 60_000, None, None), (3, base, None, None), (3, base, None, None)]
    check(spark, rows)
    kept = sh.simhash_dedup(spark.createDataFrame(
        rows + [(None, "a text of its own, without id", None, None)],
        "doc_id long, text string, fp string, row int",
    ))
    assert kept.columns == ["doc_id", "text", "fp", "row"]
    prints = [(r[0], plain_fingerprint(r[1])) for r in rows]
    firsts = sorted(set(plain_components(prints)))
    got = kept.collect()
    assert sorted(r.doc_id for r in got if r.doc_id is not None) == firsts
    assert sum(r.doc_id is None for r in got) == 1


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert sh.simhash(docs).count() == 0
    assert sh.simhash_dedup(docs).count() == 0


def test_blocks_of_a_large_bucket(spark, monkeypatch):
    monkeypatch.setattr(sh, "BLOCK", 3)
    prints = [1 << b for b in range(40)] + [(1 << 50) | (1 << b) for b in range(20)] + [7, 63]
    groups = spark.createDataFrame(pd.DataFrame({"fp": prints, "doc_id": range(len(prints))}))
    got = {r.fp: r.root for r in sh.rooted(groups).collect()}
    named = plain_components(list(enumerate(prints)))
    same = {}
    for k, f in enumerate(prints):
        assert same.setdefault(named[k], got[f]) == got[f]
    assert len(set(got.values())) == len(set(named))


def plain_near(rows):
    """Smallest doc_id of each component of texts with 5-word Jaccard of 0.8, by all pairs."""
    sets = []
    for _, text in rows:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a == b or len(a & b) / len(a | b) >= 0.8:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    least = {}
    for k, (d, _) in enumerate(rows):
        least[find(k)] = min(least.get(find(k), d), d)
    return sorted(least.values())


def test_edited_copies_go_in_the_pipeline(spark, monkeypatch):
    import corpus_pipeline

    monkeypatch.setattr(sh, "NEAR_BLOCK", 4)
    rows = []
    for n in range(20):
        words = [f"w{n}x{k}" for k in range(100)]
        rows.append((100 * n, " ".join(words)))
        for c in range(1, 3 + n // 2):  # one word or two: similarity about 0.9 and 0.81
            rows.append((100 * n + c, " ".join(
                f"new{c}" if k in (10 * c % 97, 50 + c * (n % 2)) else w for k, w in enumerate(words)
            )))
    # 96 shingles each, 85 of them shared: 85 / 107 < 0.8
    words = [f"edge{k}" for k in range(100)]
    rows += [(5000, " ".join(words)), (5001, " ".join(f"e{k}" if k in (2, 20, 40) else w for k, w in enumerate(words)))]
    rows += [(6000, "one two"), (6001, "ONE  two"), (6002, "one"), (6003, ""), (6004, None), (6004, " ")]
    docs = spark.createDataFrame([(*r, 1, "d") for r in rows], "doc_id long, text string, row int, digest string")
    got = corpus_pipeline.near_stage(spark, docs, None)
    assert got.columns == docs.columns
    kept = sorted(r.doc_id for r in got.collect())
    assert kept == plain_near(rows)
    assert {100 * n for n in range(20)} | {5000, 5001, 6000, 6002, 6003} == set(kept)
    assert sh.near_dedup(docs.limit(0)).count() == 0


def test_edited_copies_of_the_sample(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    assert sorted(r.doc_id for r in sh.near_dedup(docs).collect()) == plain_near(rows)


def test_the_pipeline_links_by_fingerprints(spark):
    import corpus_pipeline

    # Shingles that come again and again decide the fingerprint, not the set: Jaccard is low.
    chorus = "red green blue " * 400
    ends = [" ".join(f"{n}end{k}" for k in range(20)) for n in range(4)]
    rows = [(10 * n + 7, chorus + end) for n, end in enumerate(ends)]
    rows += [(90, " ".join(f"own{k}" for k in range(50))), (None, chorus + "last"), (91, None)]
    prints = [plain_fingerprint(t) for _, t in rows]
    assert all((prints[0] ^ prints[k]).bit_count() <= 2 for k in (1, 2, 3, 5))
    assert plain_near([r for r in rows if r[0] is not None]) == [7, 17, 27, 37, 90, 91]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, fp int")
    got = corpus_pipeline.near_stage(spark, docs, None)
    assert got.columns == docs.columns
    assert sorted(r.doc_id for r in got.collect()) == [7, 90, 91]
