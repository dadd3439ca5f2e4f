from pyspark.sql import functions as F

from conftest import BASE
from eventloom import vocab
from eventloom.operators import routing, search

A, B, C, GONE, OUT = (f"{BASE}/{x}" for x in ("a", "b", "c", "gone", "audit/x"))
INDEXABLE = (vocab.RDF_TYPE, vocab.INDEXABLE, "uri")
CONTAINER = (vocab.RDF_TYPE, vocab.CONTAINER, "uri")
LINK = vocab.HAS_TRANSFORMATION


def described(triples):
    return triples(
        (A, *CONTAINER), (A, *INDEXABLE), (A, LINK, "text", "literal"),
        (B, *CONTAINER), (B, LINK, "second.xsl", "uri", B, 9), (B, LINK, "first.xsl", "uri", B, 5),
        (f"{C}#x", *INDEXABLE, C), (C, LINK, C, "uri"),
    )


def hints(spark, *uris):
    return spark.createDataFrame([(u,) for u in uris], "uri string")


def input_events(events):
    update, delete = [vocab.UPDATE[1]], [vocab.DELETE[1]]
    indexable = [vocab.INDEXABLE]
    return events(
        {"event_id": "1", "uri": A, "event_types": update, "resource_types": indexable},
        {"event_id": "2", "uri": B, "event_types": update},
        {"event_id": "3", "uri": C, "event_types": update, "resource_types": indexable},
        {"event_id": "4", "uri": GONE, "event_types": update, "resource_types": indexable},
        {"event_id": "5", "uri": OUT, "event_types": delete},
        {"event_id": "6", "uri": OUT, "event_types": update},
        {"event_id": "7", "uri": A, "event_types": delete},
    )


def actions(df):
    return {(r.event_id, r.uri, r.action) for r in df.collect()}


def test_triplestore_decisions(spark, events, triples):
    args = input_events(events), hints(spark, B, A), described(triples)
    found = actions(routing.triplestore_actions(*args, True, [f"{BASE}/audit"]))
    assert found == {
        ("1", A, "update"), ("2", B, "delete"), ("3", C, "update"), ("4", GONE, "missing"),
        ("5", OUT, "delete"), ("7", A, "delete"), (None, B, "delete"), (None, A, "update"),
    }
    plain = actions(routing.triplestore_actions(*args, False, [f"{BASE}/audit"]))
    assert {a for _, u, a in plain if u == GONE} == {"update"}
    assert ("6", OUT, "update") not in plain and ("5", OUT, "delete") in plain


def test_actions_and_excluded_rows_make_up_the_input(spark, events, triples):
    rows = input_events(events)
    found = routing.triplestore_actions(rows, None, described(triples), True, [f"{BASE}/audit"])
    ids = [r.event_id for r in found.collect()]
    assert len(ids) == len(set(ids)) and set(ids) | {"6"} == {r.event_id for r in rows.collect()}


def test_search_decisions(spark, events, triples):
    args = input_events(events), hints(spark, A, B), described(triples), "default"
    rows = routing.search_actions(*args, True, True, [f"{BASE}/audit"]).collect()
    found = {(r.event_id, r.uri): (r.action, r.transformation) for r in rows}
    assert found == {
        ("1", A): ("update", "default"), ("2", B): ("delete", "first.xsl"),
        ("3", C): ("update", C), ("4", GONE): ("missing", None), ("5", OUT): ("delete", None),
        ("7", A): ("delete", None), (None, A): ("update", "default"), (None, B): ("delete", "first.xsl"),
    }
    done = routing.applicable(routing.search_actions(*args, False, True, []))
    assert {r.event_id for r in done.collect() if r.uri in (C, GONE)} == set()
    short = routing.search_actions(*args, False, False, [])
    assert {r.transformation for r in short.collect() if r.action == "update"} == {"default"}
    assert "SortMergeJoin" not in short._jdf.queryExecution().executedPlan().toString()


def test_latest_action(spark):
    rows = spark.createDataFrame(
        [("u", "1", 10, "update"), ("u", "2", 10, "delete"), ("u", None, None, "update"),
         ("v", None, None, "update")],
        "uri string, event_id string, t long, action string",
    ).select("uri", "event_id", F.timestamp_seconds("t").alias("ts"), "action")
    last = {r.uri: r.action for r in routing.latest_per_uri(rows).collect()}
    assert last == {"u": "delete", "v": "update"}


def test_search_document(triples):
    rows = triples(
        (A, *CONTAINER), (f"{A}#x", vocab.RDF_TYPE, "urn:t<&", "uri"), (A, *CONTAINER),
        (A, vocab.CONTAINS, "first", "uri"), (A, vocab.CONTAINS, "another", "uri"),
        (A, vocab.CREATED, "2020", "literal"), (B, vocab.TITLE, "x", "literal"),
    )
    docs = {r.id: r for r in search.default_search_doc(rows).collect()}
    assert docs[A].rdftype == [vocab.CONTAINER, "urn:t<&", vocab.CONTAINER]
    assert (docs[A].contains, docs[A].created, docs[A].lastmodified) == ("first", "2020", "")
    assert (docs[B].rdftype, docs[B].contains) == ([], "")
    commands = {r.id: r.command for r in search.search_add_command(search.default_search_doc(rows)).collect()}
    assert '<field name="rdftype">urn:t&lt;&amp;</field>' in commands[A]
    assert commands[A].count('name="rdftype"') == 3
    assert commands[B] == (
        f'<add><doc><field name="id">{B}</field><field name="contains"></field>'
        '<field name="lastmodified"></field><field name="created"></field></doc></add>'
    )


def test_transform_registry(spark, triples):
    def shout(rows):
        docs = search.default_search_doc(rows)
        return docs.withColumn("created", F.lit("custom"))

    rows = described(triples)
    updates = spark.createDataFrame(
        [(A, "default"), (B, "first.xsl"), (C, "nobody")], "uri string, transformation string"
    )
    registry = {"first.xsl": shout}
    docs = {r.id: r for r in search.apply_transforms(updates, rows, registry).collect()}
    assert set(docs) == {A, B} and docs[B].created == "custom" and docs[A].created == ""
    unknown = search.unknown_transforms(updates, registry).collect()
    assert [r.payload for r in unknown] == [f'{{"uri":"{C}","transformation":"nobody"}}']
