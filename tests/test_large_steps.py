"""Steps whose cost must not hang on a fixed number of tasks or on rows that need not move."""

from pathlib import Path

import pytest

from eventloom.operators import audit
from eventloom.plans.queries import REGISTRY
from eventloom.streaming import state

SF = Path("/root/testdata/sf0.001")


@pytest.fixture
def conf(spark):
    before = {}

    def change(name, value):
        before.setdefault(name, spark.conf.get(name, None))
        spark.conf.set(name, value)

    yield change
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def part_files(folder):
    return len(list(Path(folder.removeprefix("file:")).glob("part-*")))


def test_lines_in_order_are_cut_into_as_many_files_as_the_session_asks_for(spark, conf, monkeypatch):
    from eventloom.plans import queries

    made, own = [], queries.work_dir
    monkeypatch.setattr(queries, "work_dir", lambda *a: made.append(own(*a)) or made[-1])
    conf("spark.sql.shuffle.partitions", "9")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    assert REGISTRY["ntriples_files_in_order"](spark, str(SF)).count() > 0
    assert part_files(made[0]) == 9


def test_a_part_of_the_stream_has_as_many_files_as_its_input(spark, tmp_path, monkeypatch):
    from eventloom.plans import queries

    events = spark.read.parquet(f"{SF}/events.parquet")
    events.repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    made, own = [], queries.work_dir
    monkeypatch.setattr(queries, "work_dir", lambda *a: made.append(own(*a)) or made[-1])
    found = REGISTRY["latest_action_stream"](spark, str(tmp_path)).collect()
    assert part_files(f"{made[0]}/in") == 15
    batches = Path(f"{made[0]}/latest/changes/writer=main".removeprefix("file:"))
    assert len(list(batches.glob("batch=*"))) == 5
    wanted = REGISTRY["latest_action_stream"](spark, str(SF)).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, wanted))


def test_audit_keeps_events_and_compares_repeated_subjects_only(spark, events, tmp_path):
    rows = events(
        {"event_id": "a", "uri": "http://h/1", "date_time": "2020-01-01T00:00:00Z", "agents": ["x", "y"]},
        {"event_id": "a", "uri": "http://h/1", "date_time": "2020-01-01T00:00:00Z", "agents": ["y", "x"]},
        {"event_id": "a", "uri": "http://h/2", "date_time": None, "agents": None},
        {"event_id": "b", "uri": "http://h/1", "date_time": "2020-01-01T00:00:00Z", "agents": ["x", "x"]},
        {"event_id": "b", "uri": "http://h/1", "date_time": "2020-01-01T00:00:00Z", "agents": ["x", "x"]},
        {"event_id": None, "uri": "http://h/1"},
    )
    wanted = state.rdf_set(state.audit_triples(rows, "http://e"))
    once = audit.audited_once(rows, "http://e")
    assert sorted((r.event_id, r.versions) for r in once.collect()) == [("a", 3), ("a", 3), ("a", 3), ("b", 1)]
    for frame in (once, once.filter("event_id = 'b'")):
        got = audit.audit_set(frame, "http://e")
        same = wanted if frame is once else wanted.filter("subject = 'http://e/b'")
        assert got.exceptAll(same).isEmpty() and same.exceptAll(got).isEmpty()
    for batch in range(3):
        state.append_audit(rows, str(tmp_path), "http://e", (), batch)
    found = state.current_audit(spark, str(tmp_path))
    assert found.exceptAll(wanted).isEmpty() and wanted.exceptAll(found).isEmpty()
