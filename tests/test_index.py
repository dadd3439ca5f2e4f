"""The layout of the indexes: buckets, generations, expiry, filters, edges."""

import os
import shutil

import pytest

from conftest import BASE
from eventloom import schemas, vocab
from eventloom.operators import hierarchy
from eventloom.options import Options
from eventloom.streaming import changelog, edges, state
from eventloom.streaming.services import Inputs, build_services
from eventloom.sources import read_reindex_requests

GRAPHS = ("urn:g", None)


def plan(df):
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", 10_000)
    return df._jdf.queryExecution().executedPlan().toString()


def said(n, graph=None, text="v"):
    return (graph, f"{BASE}/{n}", "urn:p", f"{text} {n}", "literal", None, None, f"{BASE}/{n}", n)


def table(spark, rows):
    return spark.createDataFrame(rows, schemas.TRIPLE)


def actions(spark, *rows):
    """(n, action, second) as actions."""
    data = [(f"{BASE}/{n}", a, f"2024-01-01 00:00:{s:02}", f"e{s}") for n, a, s in rows]
    return spark.createDataFrame(data, "uri string, action string, ts string, event_id string")


def content(spark, path):
    return sorted(map(tuple, state.current_triples(spark, path).select("graph", "subject", "object").collect()), key=repr)


def loaded(spark, path, n=200, buckets=16):
    state.load_triples(table(spark, [said(k, g) for k in range(n) for g in GRAPHS]), path, buckets)


def test_a_lookup_reads_only_touched_buckets_and_no_shuffle_folds_a_base(spark, tmp_path):
    path = str(tmp_path)
    loaded(spark, path)
    wanted = spark.createDataFrame([(f"{BASE}/3",), (f"{BASE}/nobody",)], "uri string")
    found = state.current_triples(spark, path, wanted)
    assert {tuple(r) for r in found.select("graph", "object").collect()} == {("urn:g", "v 3"), (None, "v 3")}
    text = plan(found)
    assert "bucket" in text.split("PartitionFilters: [")[1].split(", PushedFilters")[0], text
    whole = state.current_triples(spark, path)
    assert "Exchange" not in plan(whole) and whole.count() == 400
    # With a log the same buckets are read, and its rows by slot.
    state.maintain_triple_index(actions(spark, (3, "update", 1)), table(spark, [said(3, None, "new")]), path, batch_id=0)
    found = state.current_triples(spark, path, wanted)
    assert {tuple(r) for r in found.select("graph", "object").collect()} == {("urn:g", "v 3"), (None, "new 3")}
    assert "slot" in plan(found).split("PushedFilters: [", 1)[1]


def test_compaction_rewrites_touched_buckets_only(spark, tmp_path):
    path = str(tmp_path)
    loaded(spark, path)
    first = changelog.manifest(spark, path)
    state.maintain_triple_index(
        actions(spark, (1, "update", 1), (2, "delete", 1)), table(spark, [said(1, None, "new")]), path, batch_id=0
    )
    expected = content(spark, path)
    state.compact_triples(spark, path)
    second = changelog.manifest(spark, path)
    old, new = ((second.parts[b], b in first.parts) for b in sorted(second.parts))
    assert old[1] and not new[1] and len(new[0]) <= 2 and sorted(old[0] + new[0]) == list(range(16))
    assert content(spark, path) == expected and second.covers("main", 0) and second.buckets == 16
    # An older update that comes late meets the purge that the base keeps.
    late = table(spark, [said(2, None, "late")])
    state.maintain_triple_index(actions(spark, (2, "update", 0)), late, path, batch_id=1)
    assert content(spark, path) == expected
    state.compact_triples(spark, path)
    assert content(spark, path) == expected


def test_a_triple_added_again_late_keeps_its_latest_time(spark, tmp_path):
    path = str(tmp_path)
    rows = table(spark, [said(1), ("urn:g", *said(2)[1:])])
    for batch, second in enumerate((20, 5)):
        state.maintain_triple_index(actions(spark, (1, "update", second)), rows, path, batch_id=batch)
        state.compact_triples(spark, path, 4)
    state.maintain_triple_index(actions(spark, (1, "delete", 10)), rows, path, batch_id=2)
    assert [r[2] for r in content(spark, path)] == ["v 1"]
    state.compact_triples(spark, path)
    assert [r[2] for r in content(spark, path)] == ["v 1"]


def files_below(path):
    return sorted(f"{d}/{f}" for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


def test_clearing_a_graph_writes_no_rows_and_later_batches_count(spark, tmp_path):
    path = str(tmp_path)
    loaded(spark, path)
    one = table(spark, [said(1, None, "again")])
    state.maintain_triple_index(actions(spark, (1, "update", 1)), one, path, graph="urn:g", batch_id=0)
    before = files_below(path)
    state.clear(spark, path, "urn:g")
    assert files_below(path) == before
    assert {r[0] for r in content(spark, path)} == {None}
    state.maintain_triple_index(actions(spark, (1, "update", 2)), one, path, graph="urn:g", batch_id=1)
    expected = content(spark, path)
    assert [r for r in expected if r[0]] == [("urn:g", f"{BASE}/1", "again 1")]
    state.compact_triples(spark, path, keep=1)
    assert content(spark, path) == expected
    (base,) = os.listdir(f"{path}/bases")
    assert len([f for f in files_below(f"{path}/bases/{base}/op=add") if "graph=urn" in f]) == 1
    state.clear(spark, path)
    assert content(spark, path) == []


def test_what_was_worked_out_from_an_older_base_is_refused(spark, tmp_path):
    path = str(tmp_path)
    loaded(spark, path, 10)
    before = changelog.manifest(spark, path)
    frame = changelog.read_changes(spark, path, state.TRIPLE_CHANGE, at=before)
    state.clear(spark, path, "urn:g")
    with pytest.raises(changelog.BaseMoved):
        changelog.rebase(spark, path, frame, after=before)
    assert {r[0] for r in content(spark, path)} == {None}


def test_a_manifest_that_was_not_finished_is_passed_over(spark, tmp_path):
    path = str(tmp_path)
    loaded(spark, path, 3)
    (tmp_path / "manifest" / "000000000002.json").write_text("{")
    assert changelog.manifest(spark, path).generation == 1 and len(content(spark, path)) == 6
    state.clear(spark, path, "urn:g")
    assert changelog.manifest(spark, path).generation == 3 and len(content(spark, path)) == 3


def test_covered_batches_go_while_a_pinned_reader_finishes(spark, tmp_path, monkeypatch):
    path = str(tmp_path)
    loaded(spark, path, 10)
    state.maintain_triple_index(
        actions(spark, (1, "update", 1)), table(spark, [said(1, None, "new")]), path, batch_id=0
    )
    log = tmp_path / "changes" / "writer=main"
    for batch in range(1, 1_000):
        shutil.copytree(log / "batch=0", log / f"batch={batch}")
    state.maintain_triple_index(actions(spark, (2, "delete", 2)), table(spark, [said(1)]), path, batch_id=1_000)
    expected = content(spark, path)
    with changelog.pinned(spark, path) as known:
        reader = state.current_triples(spark, path, at=known)
        for _ in range(2):
            state.compact_triples(spark, path, keep=1)
        assert len(os.listdir(log)) == 1_001
        asked = []
        real = changelog._files
        monkeypatch.setattr(changelog, "_files", lambda s, p: (asked.append(p), real(s, p))[1])
        assert changelog.finished_batches(spark, path, changelog.manifest(spark, path)) == set()
        assert len(asked) < 10
        monkeypatch.undo()
        assert sorted(map(tuple, reader.select("graph", "subject", "object").collect()), key=repr) == expected
    changelog.expire(spark, path, keep=1)
    assert os.listdir(log) == [] and len(changelog.generations(spark, path)) == 1
    assert changelog.manifest(spark, path).covered == {"main": [(0, 1_000)]}
    assert content(spark, path) == expected
    state.compact_triples(spark, path, keep=1)
    assert content(spark, path) == expected


def test_audit_repeats_are_dropped_when_written(spark, events, tmp_path):
    path = str(tmp_path)

    def rows(*numbers, by="someone"):
        return events(*[
            {"event_id": f"urn:uuid:{n}", "uri": f"{BASE}/{n}", "event_types": [vocab.UPDATE[1]], "agents": [by],
             "resource_types": [vocab.CONTAINER], "date_time": "2024-01-01T00:00:00Z"} for n in numbers
        ])

    expected = state.audit_triples(rows(*range(40)), "http://e").select(*schemas.TRIPLE_KEY).distinct().count()
    state.append_audit(rows(*range(30), 3), path, "http://e", batch_id=0)
    state.compact_audit(spark, path, 4)
    state.append_audit(rows(*range(20, 40)), path, "http://e", batch_id=1)
    state.append_audit(rows(*range(20, 40)), path, "http://e", batch_id=1)  # replayed
    state.append_audit(rows(*range(40)), path, "http://e", batch_id=2)
    found = state.current_audit(spark, path)
    assert "Exchange" not in plan(found) and found.count() == found.distinct().count() == expected
    # The same event told by another agent adds that triple only.
    state.append_audit(rows(5, by="else"), path, "http://e", batch_id=3)
    assert state.current_audit(spark, path).count() == expected + 1
    state.compact_audit(spark, path, keep=1)
    assert state.current_audit(spark, path).count() == expected + 1
    assert len(os.listdir(f"{path}/filters")) == 2 and not os.listdir(f"{path}/filters/writer=main")


def test_the_walk_takes_the_edge_table_that_changes_keep(spark, tmp_path):
    path, root = f"{tmp_path}/edges", f"{BASE}/0"
    pairs = [(root, f"{BASE}/{n}") for n in (1, 2)] + [(f"{BASE}/1", f"{BASE}/3"), (None, "x"), ("y", None)]
    edges.load_edges(spark.createDataFrame(pairs, "parent string, child string"), path, 4)
    contains = [(None, root, vocab.CONTAINS, f"{BASE}/{n}", "uri", None, None, root, n) for n in (2, 5)]
    changed = actions(spark, (0, "update", 1), (1, "delete", 1))
    edges.maintain_edges(changed, table(spark, [*contains, said(0)]), path)
    kept = {(root, f"{BASE}/2"), (root, f"{BASE}/5")}
    assert {tuple(r) for r in edges.current_edges(spark, path).collect()} == kept
    edges.compact_edges(spark, path)
    assert {tuple(r) for r in edges.current_edges(spark, path).collect()} == kept
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "r.json").write_text('{"request_id": "1", "path": "/0", "recipients_header": "queue:x"}')
    inputs = Inputs(requests=read_reindex_requests(spark, f"{tmp_path}/in", True))
    start = build_services(inputs, Options(target=str(tmp_path), base_url=BASE))["reindexing"]
    start(f"{tmp_path}/checkpoint", available_now=True).awaitTermination()
    hints = spark.read.json(f"{tmp_path}/hints").select("uri").collect()
    assert {r.uri for r in hints} == {root, f"{BASE}/2", f"{BASE}/5"}


def test_a_node_moves_once_however_many_roots_reach_it(spark, monkeypatch):
    pairs = [(f"r{n}", "hub") for n in range(60)] + [("hub", f"n{k}") for k in range(90)]
    pairs += [(f"n{k}", f"m{k % 7}") for k in range(90)] + [("m0", "hub")]
    links = spark.createDataFrame(pairs, "parent string, child string")
    roots = spark.createDataFrame([(f"r{n}",) for n in range(60)] + [("hub",)], "uri string")
    sizes, plans = [], []
    write, visited = hierarchy._Walk.write, hierarchy._Walk.visited

    def counted(self, rows, name, depth):
        live = write(self, rows, name, depth)
        sizes.append((name, depth, self.read(name, depth).count() if live else 0))
        return live

    def seen(self, buckets):
        found = visited(self, buckets)
        plans.append(plan(found))
        return found

    monkeypatch.setattr(hierarchy._Walk, "write", counted)
    monkeypatch.setattr(hierarchy._Walk, "visited", seen)
    found = hierarchy.traverse(links, roots)
    got = sorted(map(tuple, found.collect()))
    wanted = [("hub", "hub", 0)] + [("hub", f"n{k}", 1) for k in range(90)] + [("hub", f"m{k}", 2) for k in range(7)]
    for n in range(60):
        wanted += [(f"r{n}", f"r{n}", 0), (f"r{n}", "hub", 1)]
        wanted += [(f"r{n}", f"n{k}", 2) for k in range(90)] + [(f"r{n}", f"m{k}", 3) for k in range(7)]
    assert got == sorted(wanted)
    assert max(size for _, depth, size in sizes if depth) <= 91 + 7
    assert plans and all("bucket" in p.split("PartitionFilters: [")[1].split(", PushedFilters")[0] for p in plans)


def test_facts_follow_changes_and_decide_without_triples(spark, events, tmp_path):
    path = str(tmp_path)
    indexable = [(None, f"{BASE}/{n}", vocab.RDF_TYPE, vocab.INDEXABLE, "uri", None, None, f"{BASE}/{n}", 0) for n in (1, 2)]
    binary = [(None, f"{BASE}/2", vocab.RDF_TYPE, vocab.BINARY, "uri", None, None, f"{BASE}/2", 1)]
    link = [(None, f"{BASE}/2", vocab.HAS_TRANSFORMATION, f"urn:{t}", "uri", None, None, f"{BASE}/2", n) for n, t in ((3, "z"), (4, "a"))]
    state.load_facts(table(spark, [*indexable, said(3)]), path, 4)
    state.maintain_facts(
        actions(spark, (2, "update", 2), (1, "delete", 2), (3, "delete", 1), (9, "update", 1)),
        table(spark, [*indexable, *binary, *link]), path,
    )
    expected = {(f"{BASE}/2", True, "urn:z", True)}
    facts = lambda: {tuple(r) for r in state.current_facts(spark, path).collect()}
    assert facts() == expected
    state.compact_facts(spark, path)
    state.maintain_facts(actions(spark, (3, "update", 0)), table(spark, [said(3)]), path, batch_id=1)
    assert facts() == expected  # an update older than the deletion
    some = spark.createDataFrame([(f"{BASE}/2",), (f"{BASE}/1",)], "uri string")
    found = state.current_facts(spark, path, some)
    assert {tuple(r) for r in found.collect()} == expected
    from eventloom.operators import fixity, routing

    assert [r.uri for r in fixity.only_binaries(some, None, state.current_facts(spark, path)).collect()] == [f"{BASE}/2"]
    rows = events(*[{"event_id": str(n), "uri": f"{BASE}/{n}", "event_types": []} for n in (1, 2, 3)])
    decided = routing.triplestore_actions(rows, None, None, True, (), state.current_facts(spark, path))
    assert {r.uri[-1]: r.action for r in decided.collect()} == {"1": "missing", "2": "update", "3": "missing"}
    both = routing.search_actions(rows, None, None, "default", False, True, (), state.current_facts(spark, path))
    assert {r.uri[-1]: r.transformation for r in both.collect()} == {"1": None, "2": "urn:z", "3": None}
