import json

import pytest
from pyspark.sql import functions as F

from conftest import BASE
from eventloom import vocab
from eventloom.operators import events as ev
from eventloom.sources import malformed_events, parse_events, read_events

CURRENT = {
    "id": "urn:uuid:1",
    "type": [vocab.PROV + "Activity", vocab.ACTIVITY + "Delete"],
    "name": "removal",
    "published": "2031-03-07T06:05:04+02:00Z",
    "actor": [
        {"type": ["Person"], "id": "urn:person:ann"},
        {"type": ["Application"], "name": "robot 7"},
    ],
    "object": {
        "id": f"{BASE}/ledger/7",
        "type": [vocab.REPOSITORY + "Resource", vocab.BINARY],
        "isPartOf": BASE,
    },
    "@context": ["https://www.w3.org/ns/activitystreams", {"type": "@type"}],
}
LEGACY = {
    "@context": {"type": "@type"},
    "id": f"{BASE}/shelf/3",
    "type": [vocab.REPOSITORY + "Resource", vocab.CONTAINER],
    "isPartOf": BASE,
    "wasGeneratedBy": {
        "type": [vocab.PROV + "Activity", vocab.LEGACY_EVENT + "ResourceCreation"],
        "identifier": "urn:uuid:2",
        "atTime": "2031-03-08T09:10:11+02:00Z",
    },
    "wasAttributedTo": [
        {"type": vocab.PROV + "Person", "name": "the keeper"},
        {"type": vocab.PROV + "SoftwareAgent", "name": "robot 7"},
    ],
}


def bodies(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_current_form(spark):
    row = parse_events(bodies(spark, json.dumps(CURRENT))).first()
    assert (row.event_id, row.uri, row.is_part_of) == ("urn:uuid:1", f"{BASE}/ledger/7", BASE)
    assert row.date_time == "2031-03-07T06:05:04+02:00Z"
    assert row.event_types == CURRENT["type"]
    assert row.resource_types == CURRENT["object"]["type"]
    assert row.agents == ["urn:person:ann", "robot 7"]


def test_date_with_stray_zone_is_parsed_for_ordering(spark):
    parsed = parse_events(bodies(spark, json.dumps(CURRENT)))
    assert parsed.select(F.unix_timestamp("ts")).first()[0] == 1930622704


def test_legacy_form(spark):
    row = parse_events(bodies(spark, json.dumps(LEGACY))).first()
    assert (row.event_id, row.uri) == ("urn:uuid:2", LEGACY["id"])
    assert row.event_types == LEGACY["wasGeneratedBy"]["type"]
    assert row.resource_types == LEGACY["type"]
    assert row.agents == ["the keeper", "robot 7"]


def test_single_type_as_plain_string(spark):
    body = {**CURRENT, "type": vocab.DELETE[1], "object": {"id": "u", "type": vocab.BINARY}}
    row = parse_events(bodies(spark, json.dumps(body))).first()
    assert row.event_types == [vocab.DELETE[1]]
    assert (row.uri, row.resource_types) == ("u", [vocab.BINARY])
    assert row.event_id == "urn:uuid:1"


def test_unreadable_bodies_become_dead_letters(spark):
    rows = bodies(spark, "{not json", "", json.dumps(CURRENT), "[]")
    assert [r.event_id for r in parse_events(rows).collect()] == ["urn:uuid:1"]
    assert {r.payload for r in malformed_events(rows).collect()} == {"{not json", "[]"}


def test_bodies_that_name_no_resource_are_no_events(spark):
    texts = ["{}", '{"foo": 1}', '{"object": {}}', '{"object": {"id": " "}}', '{"id": "urn:x"}']
    rows = bodies(spark, *texts, json.dumps(CURRENT), None)
    assert parse_events(rows).count() == 1
    assert {r.payload for r in malformed_events(rows).collect()} == set(texts)
    both = parse_events(rows, rejects=True).collect()
    assert {r.reject for r in both if r.reject} == set(texts) and len(both) == len(texts) + 1


def test_missing_parts_get_defaults(spark):
    row = parse_events(bodies(spark, '{"object": {"id": "http://h/x"}}')).first()
    assert (row.event_id, row.uri, row.date_time) == (None, "http://h/x", "")
    assert (row.event_types, row.resource_types, row.agents) == ([], [], [])


def test_files_with_one_event_each_and_with_lines(spark, tmp_path):
    (tmp_path / "whole").mkdir()
    (tmp_path / "whole" / "a.json").write_text(json.dumps(CURRENT, indent=2))
    (tmp_path / "whole" / "b.json").write_text(json.dumps(LEGACY, indent=2))
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "a.json").write_text(json.dumps(CURRENT) + "\n" + json.dumps(LEGACY))
    whole = read_events(spark, str(tmp_path / "whole"), one_per_file=True)
    lines = read_events(spark, str(tmp_path / "lines"))
    assert sorted(r.event_id for r in whole.collect()) == ["urn:uuid:1", "urn:uuid:2"]
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, lines.collect()))


URIS = ("/audit", "/audit/1234", "/auditions/1234", "/objects/audit", "/audit-x")


def test_exclusion_respects_path_steps(events, spark):
    rows = events(*[{"uri": BASE + u} for u in URIS])
    wanted = {BASE + "/auditions/1234", BASE + "/objects/audit", BASE + "/audit-x"}
    listed = ev.exclude_containers(rows, f" {BASE}/audit ,, {BASE}/none")
    assert {r.uri for r in listed.collect()} == wanted
    table = spark.createDataFrame([(f"{BASE}/audit ",), ("",)], "uri string")
    assert {r.uri for r in ev.exclude_containers(rows, table).collect()} == wanted
    assert ev.exclude_containers(rows, "").count() == len(URIS)


def test_exclusion_by_table_equals_the_pairwise_rule(events, spark):
    names = ["a", "a/b", "a/b/c", "ab", "a//b", "b/a", "a/", "", "/a"]
    uris = [f"http://h/{x}" for x in names]
    containers = ["http://h/a", "http://h/a/", "http://h/b/a", "http://h/a/b"]
    table = spark.createDataFrame([(c,) for c in containers], "c string")
    kept = ev.exclude_containers(events(*[{"uri": u} for u in uris]), table)
    expected = {u for u in uris if not any(u == c or u.startswith(c + "/") for c in containers)}
    assert {r.uri for r in kept.collect()} == expected


def test_deletion_wins_over_other_types(events):
    rows = events(
        {"event_id": "both", "event_types": [vocab.UPDATE[1], vocab.DELETE[0]]},
        {"event_id": "new", "event_types": [vocab.DELETE[1]]},
        {"event_id": "none", "event_types": []},
        {"event_id": "update", "event_types": [vocab.UPDATE[0]]},
    )
    kinds = {r.event_id: r.change_kind for r in ev.with_change_kind(rows).collect()}
    assert kinds == {"both": "delete", "new": "delete", "none": "index", "update": "index"}
    deletes, others = ev.split_deletes(rows)
    assert {r.event_id for r in deletes.collect()} == {"both", "new"}
    assert {r.event_id for r in others.collect()} == {"none", "update"}


def test_forward_type_defaults_to_update(events):
    rows = events({"jms_event_type": "X"}, {"jms_event_type": ""}, {})
    found = sorted(r.forward_type for r in ev.with_forward_type(rows).collect())
    assert found == ["X", vocab.UPDATE[1], vocab.UPDATE[1]]


def test_exclusion_reaches_the_scan(spark, tmp_path, events):
    events({"uri": BASE}).write.parquet(str(tmp_path / "e"))
    stored = spark.read.parquet(str(tmp_path / "e"))
    plan = ev.exclude_containers(stored, [f"{BASE}/audit"]).select("uri")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in text and "StringStartsWith" in text
    assert "ReadSchema: struct<uri:string>" in text
