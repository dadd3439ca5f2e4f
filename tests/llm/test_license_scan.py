import re

from eventloom.llm import license_scan as ls

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(text):
    """The definition, place by place."""
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORDS.findall(lowered)
    base, labels, score, starts = set(), set(), 0.0, []
    for s in range(len(words)):
        for label, phrase in ls.BASE:
            parts = phrase.split()
            if words[s : s + len(parts)] == parts:
                starts.append(s)
                base.add(label)
                score = 1.0
        for label, template in ls.TEMPLATES:
            parts = template.replace("[", "").replace("]", "").split()
            inside = template[template.index("[") + 1 : template.index("]")].split()
            before = len(template[: template.index("[")].split())
            if words[s + before : s + before + len(inside)] != inside:
                continue
            same = sum(a == b for a, b in zip(words[s:], parts))
            if same >= ls.COVERAGE * len(parts):
                labels.add(label)
                score = max(score, same / len(parts))
    return (
        len(words), len(starts), min(starts, default=None), max(starts, default=None),
        ",".join(sorted(base)), ",".join(sorted(base | labels)), score,
    )


def check(spark, rows):
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, row int, w string")
    got = sorted(((r[0] is None, r[0] or 0, *r[1:]) for r in map(tuple, ls.license_scan(docs).collect())), key=repr)
    wanted = sorted(((d is None, d or 0, *plain(t)) for d, t in rows), key=repr)
    assert got == wanted


def test_sample_against_the_definition(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    check(spark, [tuple(r) for r in rows])


def test_notices_and_edge_cases(spark):
    whole = [t.replace("[", "").replace("]", "") for _, t in ls.TEMPLATES]
    rows = [(k, f"Copyright 2020. {t.upper()}, and more.") for k, t in enumerate(whole)]
    rows += [(100 + k, t[: len(t) // 2]) for k, t in enumerate(whole)]
    rows += [
        (200, None), (200, None), (201, ""), (202, " .,- "), (None, "under the MIT license"),
        (203, "Under the\nMIT -- License. under the mit licenses"),
        (204, "word " * 50_000 + "cc by-nc " * 2_000 + "the end"),
        (205, "under the Kit license cc éby nc"),
        (206, "cc by nc cc by nc"),
        (207, "apache license version 2.0"), (208, "apache license version 20"),
        (209, "license mit the under"), (210, "xunder the mit license"),
        (211, "free and unencumbered software released into the public domain"),
    ]
    check(spark, rows)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert ls.license_scan(empty).count() == 0


def test_query_equals_its_sql(spark):
    import duckdb

    from compare import compare

    sf = "/root/testdata/sf0.001"
    db = duckdb.connect()
    db.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    assert compare(ls.op6_license_scan(spark, sf), db, ls.OP6_SQL) is None
