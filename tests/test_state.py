"""The maintained indexes against a message-by-message simulation."""

import json
import os
import random
import sys
import uuid

import pytest
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from conftest import BASE
from eventloom import schemas, vocab
from eventloom.operators import events as ev
from eventloom.options import Options
from eventloom.plans.queries import _transforms
from eventloom.sources import read_events, read_hints, read_reindex_requests
from eventloom.streaming import changelog, delivery, state
from eventloom.streaming.services import Inputs, build_services, search_step, triplestore_step

cloudpickle.register_pickle_by_value(sys.modules[__name__])

URIS = [f"{BASE}/{x}" for x in "abcd"]
AUDIT = f"{BASE}/audit"
SNAPSHOT = [
    (URIS[0], vocab.RDF_TYPE, vocab.CONTAINER, "uri"),
    (URIS[0], vocab.CONTAINS, URIS[1], "uri"),
    (f"{URIS[0]}#x", "urn:p", "of a", "literal", URIS[0]),
    (URIS[1], "urn:p", "said in a", "literal", URIS[0]),
    (URIS[1], vocab.RDF_TYPE, vocab.CONTAINER, "uri"),
    (URIS[1], "urn:p", "said in b", "literal"),
    (URIS[2], vocab.RDF_TYPE, vocab.INDEXABLE, "uri"),
    (URIS[2], "urn:p", "said in c", "literal"),
    (URIS[0], "urn:p", "said in c", "literal", URIS[2]),
]


def random_events(seed, n=30):
    rng = random.Random(seed)
    kinds = ([vocab.UPDATE[1]], [vocab.DELETE[1]], [vocab.CREATE[0]], [])
    rows = []
    for i in range(n):
        rows.append(
            {
                "event_id": f"urn:uuid:{i:03}",
                "uri": rng.choice(URIS + [AUDIT, f"{AUDIT}/1"]),
                "event_types": rng.choice(kinds),
                "resource_types": [vocab.CONTAINER],
                "agents": ["someone"],
                "date_time": f"2024-01-01T00:00:{i:02}Z",
            }
        )
    return rows


def with_times(df):
    return df.withColumn("ts", F.try_to_timestamp("date_time"))


def simulate(rows, start=()):
    """Apply messages one after the other, as single-message consumers do."""
    store = set(start)
    for row in rows:
        gone = set(row["event_types"]) & set(vocab.DELETE)
        if not gone and (row["uri"] == AUDIT or row["uri"].startswith(AUDIT + "/")):
            continue
        graph = {t[:3] for t in SNAPSHOT if (t[4] if len(t) > 4 else t[0]) == row["uri"]}
        if not gone and not graph:
            continue
        store = {t for t in store if t[0] != row["uri"]}
        if not gone:
            store |= {t for t in graph if t[1] != vocab.CONTAINS}
    return store


def options(target, **more):
    return Options(
        target=target,
        triplestore_containers=AUDIT,
        search_containers=AUDIT,
        audit_containers=AUDIT,
        forward_containers=AUDIT,
        reindexing_enabled=False,
        **more,
    )


def stored(spark, target):
    rows = state.current_triples(spark, f"{target}/triplestore").collect()
    assert len(rows) == len(set(rows))
    return {(r.subject, r.predicate, r.object) for r in rows}


@pytest.mark.parametrize("seed", range(2))
def test_triple_index_equals_the_simulation(spark, events, triples, tmp_path, seed):
    rows, snapshot = random_events(seed), triples(*SNAPSHOT)
    start = [(URIS[0], "urn:p", "old"), ("urn:other", "urn:p", "kept")]
    state.load_triples(triples(*[(*t, "literal") for t in start]), f"{tmp_path}/triplestore")
    for batch, cut in enumerate((slice(0, 7), slice(7, 8), slice(8, 30))):
        for _ in range(2 if batch == 1 else 1):  # batch 1 is replayed
            part = with_times(events(*rows[cut]))
            triplestore_step(part, None, snapshot, options(str(tmp_path)), batch)
    expected = simulate(rows, start)
    assert stored(spark, tmp_path) == expected
    state.compact_triples(spark, f"{tmp_path}/triplestore")
    assert stored(spark, tmp_path) == expected
    again = with_times(events(*rows[8:30]))
    triplestore_step(again, None, snapshot, options(str(tmp_path)), 2)
    assert stored(spark, tmp_path) == expected


def test_missing_resources_are_dead_letters_and_change_nothing(spark, events, triples, tmp_path):
    rows = [{"event_id": "1", "uri": URIS[3], "event_types": [], "date_time": "2024-01-01T00:00:00Z"}]
    state.load_triples(triples((URIS[3], "p", "o", "uri")), f"{tmp_path}/triplestore")
    triplestore_step(with_times(events(*rows)), None, triples(*SNAPSHOT), options(str(tmp_path)))
    assert stored(spark, tmp_path) == {(URIS[3], "p", "o")}
    letters = delivery.read_dead_letters(spark, f"{tmp_path}/dead/triplestore").collect()
    assert [json.loads(r.payload) for r in letters] == [{"uri": URIS[3]}]


def test_named_graphs_and_clearing(spark, events, triples, tmp_path):
    rows = with_times(events(*random_events(1)))
    for graph in ("urn:g", ""):
        for batch in range(2):
            triplestore_step(
                rows, None, triples(*SNAPSHOT), options(str(tmp_path), named_graph=graph), batch,
                writer=f"w{graph[-1:]}",
            )
    path = f"{tmp_path}/triplestore"
    found = state.current_triples(spark, path)
    sizes = {r.graph: r["count"] for r in found.groupBy("graph").count().collect()}
    assert set(sizes) == {"urn:g", None} and len(set(sizes.values())) == 1
    state.clear(spark, path, "urn:g")
    assert {r.graph for r in state.current_triples(spark, path).collect()} == {None}
    state.clear(spark, path)
    assert state.current_triples(spark, path).count() == 0


def test_search_index_equals_the_simulation(spark, events, triples, tmp_path):
    rows, snapshot = random_events(4), triples(*SNAPSHOT)
    for batch, cut in enumerate((slice(0, 10), slice(10, 30))):
        part = with_times(events(*rows[cut]))
        search_step(part, None, snapshot, options(str(tmp_path)), batch)
    expected = set()
    for row in rows:
        if set(row["event_types"]) & set(vocab.DELETE):
            expected.discard(row["uri"])
        elif not row["uri"].startswith(AUDIT) and row["uri"] in URIS[:3]:
            expected.add(row["uri"])
    path = f"{tmp_path}/search"
    assert {r.id for r in state.current_docs(spark, path).collect()} == expected
    before = sorted(map(str, state.current_docs(spark, path).collect()))
    state.compact_docs(spark, path)
    assert sorted(map(str, state.current_docs(spark, path).collect())) == before


def test_audit_is_a_set(spark, events, tmp_path):
    rows = with_times(events(*random_events(5)))
    for batch in (0, 0, 1):
        state.append_audit(rows, str(tmp_path), "http://e", [AUDIT], batch)
    found = state.current_audit(spark, str(tmp_path))
    expected = state.audit_triples(ev.exclude_containers(rows, [AUDIT]), "http://e")
    assert found.count() == expected.count() > 0
    state.compact_audit(spark, str(tmp_path))
    assert state.current_audit(spark, str(tmp_path)).count() == expected.count()


class Collector:
    """Transport that keeps each payload in a file of its own."""

    def __init__(self, folder):
        self.folder = str(folder)

    def __call__(self, payload):
        os.makedirs(self.folder, exist_ok=True)
        with open(f"{self.folder}/{uuid.uuid4()}", "w") as out:
            out.write(payload)

    def received(self):
        return sorted(open(f"{self.folder}/{f}").read() for f in os.listdir(self.folder))


def test_other_systems_are_told(spark, events, triples, tmp_path):
    names = ("triplestore", "search-add", "search-delete")
    transports = {n: Collector(tmp_path / "got" / n) for n in names}
    settings = options(str(tmp_path), transports=transports)
    late = [{"event_id": "z", "uri": URIS[1], "event_types": [vocab.DELETE[1]], "date_time": "2025-01-01T00:00:00Z"}]
    late += [{**late[0], "uri": u, "event_types": [], "event_id": "y"} for u in (URIS[2], URIS[3])]
    rows = with_times(events(*late, {**late[0], "uri": URIS[3], "event_id": "x"}))
    triplestore_step(rows, None, triples(*SNAPSHOT), settings)
    search_step(rows, None, triples(*SNAPSHOT), settings)
    bodies = transports["triplestore"].received()
    assert len(bodies) == 3 and all(b.startswith("update=DELETE+WHERE+%7B") for b in bodies)
    # The later update of a resource without description leaves its deletion in force.
    updated = [b for b in bodies if "INSERT" in b]
    assert len(updated) == 1 and "said+in+c" in updated[0]
    adds = transports["search-add"].received()
    assert len(adds) == 1 and f'<field name="id">{URIS[2]}</field>' in adds[0]
    deletes = {json.loads(t)["delete"]["id"] for t in transports["search-delete"].received()}
    assert deletes == {URIS[1], URIS[3]}


# --- the running services --------------------------------------------------------------------


def body(row):
    return json.dumps(
        {
            "id": row["event_id"],
            "type": row["event_types"],
            "published": row["date_time"],
            "actor": [{"name": a} for a in row["agents"]],
            "object": {"id": row["uri"], "type": row["resource_types"]},
        }
    )


def write_event_files(folder, rows, size=7):
    folder.mkdir()
    for n in range(0, len(rows), size):
        (folder / f"{n:03}.json").write_text("\n".join(body(r) for r in rows[n : n + size]))


def run(service, checkpoint):
    service(str(checkpoint), available_now=True).awaitTermination()


def test_services_over_many_batches_equal_one_batch(spark, triples, tmp_path):
    rows = random_events(7, 20)
    write_event_files(tmp_path / "in", rows, 10)
    snapshot = triples(*SNAPSHOT)
    live = lambda: read_events(spark, str(tmp_path / "in"), True, maxFilesPerTrigger=1)
    settings = options(
        str(tmp_path / "stream"), audit_enabled=True, triplestore_enabled=True,
        search_enabled=True, forward_enabled=True, forward_url=str(tmp_path / "sent"),
        transforms=_transforms(),
    )
    built = build_services(Inputs(events=live(), triples=lambda uris: snapshot), settings)
    assert set(built) == {"audit", "triplestore", "search", "forward"}
    for name, service in built.items():
        run(service, tmp_path / f"checkpoint-{name}")
    run(built["audit"], tmp_path / "checkpoint-audit")  # restart: nothing left to do
    everything = read_events(spark, str(tmp_path / "in"))
    once = options(str(tmp_path / "batch"))
    triplestore_step(everything, None, snapshot, once)
    search_step(everything, None, snapshot, once)
    state.append_audit(everything, f"{once.target}/audit", once.event_base_uri, AUDIT)

    def same(read, folder):
        found = [sorted(map(str, read(spark, f"{tmp_path}/{x}/{folder}").collect())) for x in ("stream", "batch")]
        return found[0] == found[1] and found[0]

    assert same(state.current_triples, "triplestore")
    assert same(state.current_docs, "search")
    assert same(state.current_audit, "audit")
    assert stored(spark, tmp_path / "stream") == simulate(rows)
    sent = spark.read.option("recursiveFileLookup", "true").text(str(tmp_path / "sent")).count()
    assert sent == ev.exclude_containers(everything, AUDIT).count()


def test_hints_apply_after_the_events_seen_before(spark, triples, tmp_path):
    rows = [
        {**random_events(1)[0], "uri": URIS[0], "event_types": [vocab.DELETE[1]]},
    ]
    write_event_files(tmp_path / "in", rows)
    (tmp_path / "hints").mkdir()
    (tmp_path / "hints" / "a.json").write_text(json.dumps({"uri": URIS[0]}) + "\n")
    inputs = Inputs(
        events=read_events(spark, str(tmp_path / "in"), True),
        hints=read_hints(spark, str(tmp_path / "hints"), True),
        triples=lambda uris: triples(*SNAPSHOT),
    )
    settings = options(str(tmp_path / "t"), triplestore_enabled=True)
    run(build_services(inputs, settings)["triplestore"], tmp_path / "checkpoint")
    assert (URIS[0], vocab.RDF_TYPE, vocab.CONTAINER) in stored(spark, tmp_path / "t")


def test_reindexing_and_fixity_services(spark, triples, tmp_path):
    (tmp_path / "requests").mkdir()
    request = {"request_id": "1", "path": "/a", "recipients_header": "queue:x, queue:y"}
    (tmp_path / "requests" / "r.json").write_text(json.dumps(request))
    (tmp_path / "checks").mkdir()
    (tmp_path / "checks" / "c.json").write_text(
        "\n".join(json.dumps({"uri": u}) for u in URIS[:3])
    )
    edges = spark.createDataFrame([(URIS[0], URIS[1])], "parent string, child string")
    kinds = triples(*[(u, vocab.RDF_TYPE, vocab.BINARY, "uri") for u in URIS[:2]])
    content = spark.createDataFrame([(u, bytearray(b"x")) for u in URIS], "uri string, content binary")
    manifest = content.limit(1).select(
        "uri", F.concat(F.lit("urn:sha-256:"), F.sha2("content", 256)).alias("digest"), F.lit(1).alias("size")
    )
    inputs = Inputs(
        checks=read_hints(spark, str(tmp_path / "checks"), True),
        requests=read_reindex_requests(spark, str(tmp_path / "requests"), True),
        triples=lambda uris: kinds, edges=lambda parents: edges, binaries=lambda uris: content, manifest=lambda: manifest,
    )
    settings = Options(target=str(tmp_path / "t"), base_url=BASE, fixity_enabled=True)
    for name, service in build_services(inputs, settings).items():
        run(service, tmp_path / f"checkpoint-{name}")
    look = spark.read.option("recursiveFileLookup", "true")
    hints = spark.read.json(f"{tmp_path}/t/hints").select("uri", "recipient").collect()
    assert {tuple(r) for r in hints} == {(u, q) for u in URIS[:2] for q in ("queue:x", "queue:y")}
    assert look.json(f"{tmp_path}/t/answers").first().message == f"Indexing started at {URIS[0]}"
    results = look.parquet(f"{tmp_path}/t/fixity/results").collect()
    assert {r.uri: r.outcome for r in results} == {URIS[0]: "SUCCESS", URIS[1]: "FAILURE"}
    failed = look.schema(schemas.HINT).json(f"{tmp_path}/t/fixity/failures").collect()
    assert [r.uri for r in failed] == [URIS[1]]


def test_a_batch_that_ends_during_compaction_is_read(spark, events, triples, tmp_path):
    rows, snapshot = random_events(3), triples(*SNAPSHOT)
    path = f"{tmp_path}/triplestore"
    triplestore_step(with_times(events(*rows[:10])), None, snapshot, options(str(tmp_path)), 0)
    before = changelog.finished_batches(spark, path)
    triplestore_step(with_times(events(*rows[10:])), None, snapshot, options(str(tmp_path)), 1)
    expected = stored(spark, tmp_path)
    base = state.fold_triples(changelog.read_changes(spark, path, state.TRIPLE_CHANGE, before))
    purges = changelog.read_changes(spark, path, state.TRIPLE_CHANGE, before).filter("op = 'purge'")
    frame = base.select(F.lit("add").alias("op"), "seq", *schemas.TRIPLE_KEY).unionByName(purges)
    changelog.rebase(spark, path, frame, before)
    assert stored(spark, tmp_path) == expected == simulate(rows)


def test_a_missing_base_is_an_error(spark, triples, tmp_path):
    path = f"{tmp_path}/triplestore"
    state.load_triples(triples((URIS[0], "p", "o", "uri")), path)
    base = next(iter(os.listdir(f"{path}/bases")))
    os.rename(f"{path}/bases/{base}", f"{tmp_path}/elsewhere")
    with pytest.raises(AnalysisException):
        state.current_triples(spark, path).count()
    assert state.current_triples(spark, f"{tmp_path}/nothing").count() == 0


def test_an_undated_delete_counts_when_it_is_seen(spark, events, triples, tmp_path):
    update = {"event_id": "1", "uri": URIS[0], "event_types": [], "date_time": "2024-01-01T00:00:00Z"}
    gone = {"event_id": "0", "uri": URIS[0], "event_types": [vocab.DELETE[1]], "date_time": ""}
    for batch, row in enumerate((update, gone)):
        triplestore_step(with_times(events(row)), None, triples(*SNAPSHOT), options(str(tmp_path)), batch)
    assert not {t for t in stored(spark, tmp_path) if t[0] == URIS[0]}


def test_unreadable_events_become_dead_letters_of_the_services(spark, triples, tmp_path):
    (tmp_path / "in").mkdir()
    lines = [body(random_events(1)[0]), "{}", "no json", '{"foo": 1}']
    (tmp_path / "in" / "a.json").write_text("\n".join(lines))
    events = read_events(spark, str(tmp_path / "in"), True, rejects=True)
    settings = options(str(tmp_path / "t"), audit_enabled=True, forward_enabled=True, forward_url=str(tmp_path / "sent"))
    for name, service in build_services(Inputs(events=events), settings).items():
        run(service, tmp_path / f"checkpoint-{name}")
        letters = delivery.read_dead_letters(spark, f"{tmp_path}/t/dead/{name}-input").collect()
        assert {r.payload for r in letters} == set(lines[1:])


def test_a_processing_time_trigger_and_compaction(spark, triples, tmp_path):
    rows = random_events(7, 20)
    write_event_files(tmp_path / "in", rows, 5)
    events = read_events(spark, str(tmp_path / "in"), True, maxFilesPerTrigger=1)
    settings = options(str(tmp_path / "t"), triplestore_enabled=True, compact_every=2)
    inputs = Inputs(events=events, triples=lambda uris: triples(*SNAPSHOT))
    query = build_services(inputs, settings)["triplestore"](str(tmp_path / "checkpoint"))
    query.processAllAvailable()
    query.stop()
    assert len(os.listdir(tmp_path / "t/triplestore/bases")) >= 1
    assert stored(spark, tmp_path / "t") == simulate(rows)


def test_preferences_come_from_options(spark, events, triples, tmp_path):
    rows = with_times(events({"event_id": "1", "uri": URIS[2], "event_types": [], "date_time": "2024-01-01T00:00:00Z"}))
    for folder, more in (
        ("unknown", {"prefer_omit": "urn:managed"}),
        ("given", {"prefer_omit": "urn:managed", "prefer_groups": {"urn:managed": ["urn:p"]}}),
    ):
        triplestore_step(rows, None, triples(*SNAPSHOT), options(str(tmp_path / folder), **more))
        said = {p for _, p, _ in stored(spark, tmp_path / folder)}
        assert (("urn:p" in said), vocab.RDF_TYPE in said) == (folder == "unknown", True)
