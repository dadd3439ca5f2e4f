from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from eventloom.llm import line_dedup as ld

SCHEMA = "doc_id long, text string, n_lines int, row string"
BLANK = " \t\n\r\x0b\x0c"


def plain(rows, least=5):
    """[(doc_id, text)] -> [(doc_id, text, lines, removed)], document by document in order."""
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, k))
    filled = [[x.strip(BLANK) for x in (t or "").split("\n") if x.strip(BLANK)] for _, t in rows]
    holder, out = {}, {}
    for k in order:
        partners = defaultdict(lambda: ([], []))
        for p, x in enumerate(filled[k]):
            first = holder.get(x)
            if first is not None:
                partners[first][0].append((p, x))
        for first, (mine, there) in partners.items():
            wanted = {x for _, x in mine}
            there += [(p, x) for p, x in enumerate(filled[first]) if x in wanted]
        found = set()
        for mine, there in partners.values():
            found |= ld.aligned(mine, there)
        gone = ld.blocks(found, {p: len(x.encode().split()) for p, x in enumerate(filled[k])}, least)
        for x in filled[k]:
            holder.setdefault(x, k)
        left, at = [], 0
        for x in (rows[k][1] or "").split("\n"):
            if x.strip(BLANK):
                at += 1
                if at - 1 in gone:
                    continue
            left.append(x)
        out[k] = (rows[k][0], "\n".join(left) if gone else rows[k][1], len(filled[k]), len(gone))
    return [out[k] for k in range(len(rows))]


def check(spark, rows):
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).coalesce(1)
    got = ld.line_dedup(docs)
    assert {"doc_id", "text", "row", "n_lines", "n_removed", "removed_words"} == set(got.columns)
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    got = sorted(((r.doc_id, r.text, r.n_lines, r.n_removed) for r in got.collect()), key=key)
    assert got == sorted(plain(rows), key=key)
    kept = ld.without_repeats(docs)
    assert kept.columns == docs.columns
    wanted = [(d, t) for d, t, n, m in plain(rows) if not m or m < n]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=key) == sorted(wanted, key=key)


def test_sample(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    check(spark, [tuple(r) for r in rows.orderBy("doc_id").collect()])


def test_edge_cases(spark):
    long = "\n".join(f"line number {k} of a long text" for k in range(3000))
    rows = [
        (1, "alpha beta gamma delta epsilon zeta\nhead\n\nsecond long line with many words"),
        (2, "own line here\nsecond long line with many words \nhead\nend of it all, truly the end"),
        (3, "head\nalpha beta gamma delta epsilon zeta"), (4, "head"), (5, None), (6, ""), (7, " \n\t"),
        (8, long), (9, long + "\nmore words than before, five"), (9, "again the very same line here"),
        (9, "again the very same line here"), (None, "again the very same line here"),
        (10, "second long line with many words\nalpha beta gamma delta epsilon zeta\nhead"),
        (11, "one two three four five six\none two three four five six"),
        (12, "one two three four five six\n" * 3),
    ]
    check(spark, rows)
    assert ld.line_dedup(spark.createDataFrame([], SCHEMA)).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=14), st.lists(st.integers(0, 6), max_size=14))
def test_alignment_matches_equal_lines_in_order(a, b):
    pairs = ld.patience(list(enumerate(a)), list(enumerate(b)))
    assert all(a[i] == b[j] for i, j in pairs)
    assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(pairs, pairs[1:]))
    unique = {x for x in a if a.count(x) == 1 and b.count(x) == 1}
    if a == b:
        assert len(pairs) == len(a)
    if unique:
        assert pairs


def test_moved_passages_are_found():
    later = list(enumerate("efgabc"))
    assert ld.aligned(later, list(enumerate("abcdefg"))) == set(range(6))
