import pytest

from eventloom import vocab
from eventloom.operators import audit, events as ev, triples as tr

BASE_URI = "http://example.com/event"
RESOURCE = vocab.REPOSITORY + "Resource"


@pytest.mark.parametrize(
    "types, resource, expected",
    [
        ([vocab.CREATE[0]], RESOURCE, vocab.EVENT_CODE + "cre"),
        ([vocab.DELETE[0]], RESOURCE, vocab.EVENT_CODE + "del"),
        ([vocab.UPDATE[1]], RESOURCE, vocab.AUDIT + "metadataModification"),
        ([vocab.CREATE[1]], vocab.BINARY, vocab.EVENT_CODE + "ing"),
        ([vocab.UPDATE[1]], vocab.BINARY, vocab.AUDIT + "contentModification"),
        ([vocab.DELETE[1]], vocab.BINARY, vocab.AUDIT + "contentRemoval"),
        ([vocab.UPDATE[1], vocab.CREATE[1]], RESOURCE, vocab.EVENT_CODE + "cre"),
        ([vocab.UPDATE[0], vocab.DELETE[0]], RESOURCE, vocab.EVENT_CODE + "del"),
        (["urn:other"], RESOURCE, None),
        ([], RESOURCE, None),
    ],
)
def test_event_type(events, types, resource, expected):
    rows = events({"event_types": types, "resource_types": [resource]})
    assert ev.with_audit_event_type(rows).first().audit_event_type == expected


def record(**changes):
    return {
        "event_id": "urn:uuid:9",
        "uri": "http://h/a",
        "date_time": "2015-04-06T22:45:20Z",
        "event_types": [vocab.CREATE[1], vocab.UPDATE[1]],
        "agents": ["bypassAdmin", 'curl "7"'],
        **changes,
    }


def test_record_has_eight_triples(events):
    rows = audit.audit_triples(events(record()), BASE_URI)
    assert rows.count() == 8
    found = {(r.predicate, r.object) for r in rows.collect()}
    assert (vocab.EVENT_TYPE, vocab.EVENT_CODE + "cre") in found
    assert {r.subject for r in rows.collect()} == {BASE_URI + "/urn:uuid:9"}


def test_repeated_agents_and_untyped_events(events):
    rows = audit.audit_triples(events(record(agents=["a", "a"], event_types=[])), BASE_URI)
    assert rows.count() == 6


def test_statement_text(events):
    text = audit.audit_insert_statement(events(record()), BASE_URI).first().statement
    subject = f"<{BASE_URI}/urn:uuid:9>"
    lines = text.removeprefix("INSERT DATA { ").removesuffix("\n}").split("\n")
    assert len(lines) == 8
    assert (
        f'{subject} <{vocab.EVENT_DATE_TIME}> "2015-04-06T22:45:20Z"^^<{vocab.XSD_DATETIME}> .'
        in lines
    )
    assert f'{subject} <{vocab.EVENT_AGENT}> "curl \\"7\\"" .' in lines
    assert f"{subject} <{vocab.EVENT_OBJECT}> <http://h/a> ." in lines


def test_row_wise_statement_equals_the_grouped_one(events):
    rows = events(record(), record(event_id="urn:uuid:10", agents=["x\ny", "x\ny"]))
    direct = audit.audit_insert_statement(rows, BASE_URI).collect()
    grouped = tr.insert_statement(audit.audit_triples(rows, BASE_URI)).collect()
    assert {tuple(r) for r in direct} == {(r.subject, r.statement) for r in grouped}


def test_events_without_id_are_dead_letters(events):
    rows = events(record(event_id=None))
    assert audit.audit_triples(rows, BASE_URI).count() == 0
    assert audit.unaudited_events(rows).first().error == "event without id"


def test_record_is_built_without_shuffle(events):
    plan = audit.audit_triples(events(record()), BASE_URI)
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()
