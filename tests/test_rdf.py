import pytest

from eventloom import vocab
from eventloom.operators import triples as tr
from eventloom.sources import (
    ntriples_to_triples,
    rdfxml_to_triples,
    read_ntriples,
    read_rdfxml,
    read_triples,
    unreadable_ntriples,
    unreadable_rdfxml,
    write_triples,
)

S = "http://h/foo"
LINES = [
    f"<{S}> <{vocab.RDF_TYPE}> <{vocab.CONTAINER}> .",
    f'<{S}> <{vocab.TITLE}> "This & That" .',
    f'<{S}> <{vocab.TITLE}> "a \\"quoted\\" \\\\ \\t\\u00e9 \\U0001F600 end"@en-GB .',
    f'<{S}> <{vocab.CREATED}> "2020-01-01T00:00:00Z"^^<{vocab.XSD_DATETIME}>. # note',
    f"\t_:b0   <{vocab.CONTAINS}>\t_:b1.x .",
    f'<{S}#part> <{vocab.TITLE}> "" .',
    f'<{S}> <{vocab.TITLE}> "dots . and \\" . inside" . # "c" .',
]
NOISE = ["", "# comment", "   "]
BROKEN = ["<a> <b>", "garbage line here .", f'<{S}> <{vocab.TITLE}> "open .', f"<{S}> p <o> ."]


def apart(label):
    """A blank node's label as written, without what keeps documents apart."""
    return "_:" + label.split("-", 1)[1] if label.startswith("_:") else label


def by_order(df):
    return [r for r in df.orderBy("ord").collect()]


def test_ntriples_terms(spark):
    text = "\n".join(LINES)
    rows = by_order(
        ntriples_to_triples(spark.createDataFrame([(S, text)], "uri string, text string"))
    )
    assert [apart(r.subject) for r in rows] == [S] * 4 + ["_:b0", f"{S}#part", S]
    assert [apart(r.object) for r in rows] == [
        vocab.CONTAINER,
        "This & That",
        'a "quoted" \\ \té 😀 end',
        "2020-01-01T00:00:00Z",
        "_:b1.x",
        "",
        'dots . and " . inside',
    ]
    assert [r.object_kind for r in rows] == [
        "uri", "literal", "literal", "literal", "bnode", "literal", "literal",
    ]
    assert rows[2].lang == "en-GB" and rows[2].datatype == vocab.LANG_STRING
    assert rows[3].datatype == vocab.XSD_DATETIME and rows[1].datatype == vocab.XSD_STRING
    assert {r.doc for r in rows} == {S}


def test_equal_labels_of_two_documents_are_two_nodes(spark, tmp_path):
    text = "_:b0 <urn:p> _:b0 .\n_:b0 <urn:q> _:b1 ."
    rows = ntriples_to_triples(spark.createDataFrame([("d1", text), ("d2", text)], "uri string, text string")).collect()
    assert {apart(r.subject) for r in rows} == {"_:b0"} and len({r.subject for r in rows}) == 2
    assert all((r.subject == r.object) == (r.predicate == "urn:p") for r in rows)
    for name in "ab":
        (tmp_path / f"{name}.nt").write_text(text)
    read = read_ntriples(spark, str(tmp_path)).collect()
    assert len({r.subject for r in read}) == 2 and all(r.doc == r.subject for r in read)


def test_ntriples_files_and_broken_lines(spark, tmp_path):
    (tmp_path / "a.nt").write_text("\n".join(LINES + NOISE + BROKEN))
    rows = read_ntriples(spark, str(tmp_path))
    assert rows.count() == len(LINES)
    assert {apart(r.doc) for r in rows.collect()} == {S, "_:b0"}
    bad = unreadable_ntriples(spark.read.text(str(tmp_path)))
    assert sorted(r.value for r in bad.collect()) == sorted(BROKEN)


def test_long_literal_with_many_escapes(spark):
    inner = "line\\n" * 50_000
    text = f'<{S}> <{vocab.TITLE}> "{inner}" .'
    row = ntriples_to_triples(
        spark.createDataFrame([(S, text)], "uri string, text string")
    ).first()
    assert row.object == "line\n" * 50_000


def test_lines_round_trip(spark):
    text = "\n".join(LINES)
    first = ntriples_to_triples(spark.createDataFrame([(S, text)], "uri string, text string"))
    again = ntriples_to_triples(tr.to_ntriples(first).selectExpr("doc as uri", "line as text"))
    drop = lambda df: {tuple(r) for r in df.drop("ord").collect()}
    assert drop(first) == drop(again)


XML = f"""<?xml version="1.0" encoding="UTF-8"?>
<r:RDF xmlns:r="{vocab.RDF}" xmlns:i="{vocab.INDEXING}" xmlns:q="{vocab.PREMIS}"
    xmlns:d="{vocab.DC}">
  <r:Description r:about="{S}">
    <r:type r:resource="{vocab.CONTAINER}"/>
    <!-- <r:type r:resource="not this"/> -->
    <i:hasIndexingTransformation r:about="own.xsl"/>
    <d:title xml:lang="fr">Ça &amp; là</d:title>
  </r:Description>
  <r:Description r:about="{S}#fixity">
    <q:hasSize r:datatype="{vocab.XSD}long">0016</q:hasSize>
    <q:hasEventOutcome>SUCCESS</q:hasEventOutcome>
  </r:Description>
</r:RDF>"""


def test_rdfxml(spark, tmp_path):
    df = spark.createDataFrame([(S, XML), ("bad", "<open>"), ("none", None)], "uri string, text string")
    rows = by_order(rdfxml_to_triples(df))
    assert [(r.subject, r.predicate, r.object, r.object_kind, r.lang) for r in rows] == [
        (S, vocab.RDF_TYPE, vocab.CONTAINER, "uri", None),
        (S, vocab.HAS_TRANSFORMATION, "own.xsl", "uri", None),
        (S, vocab.TITLE, "Ça & là", "literal", "fr"),
        (f"{S}#fixity", vocab.SIZE, "0016", "literal", None),
        (f"{S}#fixity", vocab.EVENT_OUTCOME, "SUCCESS", "literal", None),
    ]
    assert rows[3].datatype == vocab.XSD + "long"
    assert [r.uri for r in unreadable_rdfxml(df).collect()] == ["bad"]
    (tmp_path / "a.rdf").write_text(XML)
    stored = by_order(read_rdfxml(spark, str(tmp_path)))
    assert [tuple(r) for r in stored] == [tuple(r) for r in rows]


def test_containment_lines(spark):
    lines = [f"<{S}> <{vocab.CONTAINS}> <{S}/{c}> ." for c in "abcdefg"] + LINES + BROKEN
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    edges = tr.containment_edges_from_lines(df)
    assert {r.child for r in edges.collect()} == {f"{S}/{c}" for c in "abcdefg"}
    assert {r.parent for r in edges.collect()} == {S}


def test_update_text(spark, triples):
    rows = triples(
        (S, vocab.RDF_TYPE, vocab.CONTAINER, "uri"), (S, vocab.TITLE, "This & That", "literal")
    )
    row = tr.form_encoded(tr.update_statement(rows)).first()
    assert row.statement == (
        f"DELETE WHERE {{ <{S}> ?p ?o }};\nINSERT DATA {{ "
        f'<{S}> <{vocab.TITLE}> "This & That" .\n'
        f"<{S}> <{vocab.RDF_TYPE}> <{vocab.CONTAINER}> .\n}}"
    )
    assert row.body.startswith("update=DELETE+WHERE+%7B+%3Chttp%3A%2F%2Fh%2Ffoo%3E+%3Fp+%3Fo+%7D%3B%0A")
    assert row.body.endswith("%0A%7D")


def test_large_description_is_sent_in_parts(triples):
    rows = triples(*[(S, vocab.CONTAINS, f"{S}/{n}", "uri") for n in range(100)], ("http://h/b", "p", "o", "uri"))
    parts = tr.update_statement(rows, max_rows=10).collect()
    big = sorted((r for r in parts if r.uri == S), key=lambda r: r.part)
    clear = f"DELETE WHERE {{ <{S}> ?p ?o }};\n"
    assert big[0].part == 0 and big[0].statement.startswith(clear)
    assert len(big) > 2 and not any("DELETE" in r.statement for r in big[1:])
    texts = [r.statement.removeprefix(clear).removeprefix("INSERT DATA { ").removesuffix("\n}") for r in big]
    lines = [line for text in texts for line in text.split("\n")]
    assert len(lines) == len(set(lines)) == 100
    assert {r.parts for r in big} == {10}
    assert [(r.part, r.parts) for r in parts if r.uri != S] == [(0, 1)]


def test_match_and_prefer(triples):
    rows = triples(
        (S, vocab.CONTAINS, f"{S}/a", "uri"), (S, vocab.RDF_TYPE, vocab.BINARY, "uri"), ("x", "p", "o", "uri")
    )
    assert tr.match(rows, s=S, p=vocab.CONTAINS).first().object == f"{S}/a"
    assert tr.match(rows, graph=None).count() == 3 and tr.match(rows, graph="g").count() == 0
    omit = [vocab.PREFER_CONTAINMENT]
    assert tr.apply_prefer(rows, omit=omit).count() == 2
    assert tr.apply_prefer(rows, include=omit, omit=omit).count() == 3
    assert tr.apply_prefer(rows, omit=["urn:g"], groups={"urn:g": ["p"]}).count() == 2


def test_prefer_groups_from_a_table(spark, triples):
    rows = triples((S, "p", "o", "uri"), (S, "q", "o", "uri"), (S, "r", "o", "uri"))
    table = spark.createDataFrame(
        [("urn:g", "p"), ("urn:g", "q"), ("urn:other", "r"), ("urn:g", "p")],
        "prefer_value string, predicate string",
    )
    kept = tr.apply_prefer(rows, omit=["urn:g"], groups=table)
    assert [r.predicate for r in kept.collect()] == ["r"]
    with pytest.raises(ValueError):
        tr.apply_prefer(rows, omit=["urn:unknown"])


def test_snapshot_reads_only_touched_buckets(spark, triples, tmp_path):
    rows = triples(*[(f"http://h/{n % 40}", "p", f"o{n}", "uri") for n in range(400)])
    write_triples(rows, str(tmp_path), 8)
    assert {tuple(r) for r in read_triples(spark, str(tmp_path)).collect()} == {
        tuple(r) for r in rows.collect()
    }
    uris = spark.createDataFrame([("http://h/3",), ("http://h/3",)], "uri string")
    part = read_triples(spark, str(tmp_path), uris)
    assert part.filter("doc = 'http://h/3'").count() == 10
    assert part.count() < 400
    assert "PartitionFilters: [isnotnull(bucket" in part._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        read_triples(spark, str(tmp_path), uris, 16)
    # A new version replaces the old one for new readers only.
    write_triples(rows.limit(10), str(tmp_path), 4)
    assert read_triples(spark, str(tmp_path)).count() == 10
    assert part.filter("doc = 'http://h/3'").count() == 10
