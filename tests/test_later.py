"""Order of lines in split files, last actions over late batches, redelivery over triggers."""

import datetime
import os
import sys

import pytest
from pyspark import cloudpickle

from conftest import BASE
from eventloom import vocab
from eventloom.operators import routing
from eventloom.sources import read_ntriples
from eventloom.sources.rdf import numbered_lines
from eventloom.streaming import delivery, latest

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def test_lines_of_split_files_are_numbered(spark, tmp_path):
    for name, n in (("a.nt", 3_000), ("b.nt", 1), ("c.nt", 700)):
        (tmp_path / name).write_text("".join(f"line {k} of {name} {'x' * (k % 37)}\n" for k in range(n)))
    (tmp_path / "empty.nt").write_text("")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 4_096)
    try:
        lines = numbered_lines(spark, str(tmp_path))
        assert lines.rdd.getNumPartitions() > 1
        found = sorted((os.path.basename(r.file), r.number, r.value.split()[1]) for r in lines.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found == sorted((f, k, str(k)) for f, n in (("a.nt", 3_000), ("b.nt", 1), ("c.nt", 700)) for k in range(n))


def test_first_values_follow_the_lines(spark, tmp_path):
    links = [f"<urn:a> <{vocab.HAS_TRANSFORMATION}> <urn:t{k}> ." for k in (5, 1, 9)]
    (tmp_path / "a.nt").write_text("# note\n\n" + "\n".join(links))
    rows = read_ntriples(spark, str(tmp_path), ordered=True)
    assert [r.ord for r in rows.orderBy("ord").collect()] == [2, 3, 4]
    assert routing.resource_facts(rows).first().own_transformation == "urn:t5"
    assert routing.resource_facts(read_ntriples(spark, str(tmp_path))).first().own_transformation == "urn:t1"
    with pytest.raises(ValueError):
        read_ntriples(spark, str(tmp_path), streaming=True, ordered=True)


def test_late_actions_change_nothing_that_came_after_them(spark, tmp_path):
    def batch(number, *rows):
        data = [(e, u, datetime.datetime(2024, 1, 1, 0, 0, s) if s is not None else None, a) for e, u, s, a in rows]
        frame = spark.createDataFrame(data, latest.LATEST.replace("uri string, event_id string", "event_id string, uri string"))
        frame.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(frame.schema).parquet(f"{tmp_path}/in")
        latest.keep_latest(stream, f"{tmp_path}/t", f"{tmp_path}/c", available_now=True).awaitTermination()
        return {r.uri: r.event_id for r in latest.current_latest(spark, f"{tmp_path}/t").collect()}

    assert batch(0, ("e5", "a", 5, "update"), ("e2", "b", 2, "delete")) == {"a": "e5", "b": "e2"}
    assert batch(1, ("e3", "a", 3, "delete"), ("e4", "b", 4, "update")) == {"a": "e5", "b": "e4"}
    latest.compact_latest(spark, f"{tmp_path}/t", keep=1)
    assert batch(2, ("e6", "b", None, "delete"), ("e1", "c", 1, "update")) == {"a": "e5", "b": "e6", "c": "e1"}
    assert sorted(os.listdir(f"{tmp_path}/t/changes/writer=main")) != []


class Moody:
    """Receiver that notes each try in a folder and accepts a payload from its nth try on."""

    def __init__(self, folder):
        self.folder = str(folder)

    def __call__(self, payload):
        place = f"{self.folder}/{payload.replace('/', '_')}"
        with open(place, "a") as out:
            out.write("x")
        if os.path.getsize(place) < int(payload.split()[-1]):
            raise ConnectionError("busy")

    def tries(self):
        return {f: os.path.getsize(f"{self.folder}/{f}") for f in os.listdir(self.folder)}


def test_failed_messages_wait_longer_each_time_until_the_limit(spark, tmp_path):
    (tmp_path / "got").mkdir()
    receiver, target = Moody(tmp_path / "got"), str(tmp_path / "t")
    how = delivery.Redelivery(pause=10, factor=3, limit=3)
    rows = [(f"m{k} {k}",) for k in range(1, 7)] + [("twin 2",), ("twin 2",)]
    delivery.forward(spark.createDataFrame(rows, "message string"), target, receiver, redelivery=how)
    start = datetime.datetime(2100, 1, 1)
    waits = []
    for second in (0, 1, 30, 119, 120, 121, 500):
        delivery.redeliver(spark, target, receiver, how, start + datetime.timedelta(seconds=second))
        waits.append(delivery.queued(spark, target).count())
    # Tries at 0 (2nd), 30 (3rd: 10 * 3 later), 120 (4th: 90 later); a fifth is over the limit of 3 repeats.
    assert receiver.tries() == {"m1 1": 1, "m2 2": 2, "m3 3": 3, "m4 4": 4, "m5 5": 4, "m6 6": 4, "twin 2": 3}
    assert waits == [4, 4, 3, 3, 0, 0, 0]
    letters = delivery.read_dead_letters(spark, f"{target}/dead").collect()
    assert {(r.payload, r.attempts) for r in letters} == {("m5 5", 4), ("m6 6", 4)} and len(letters) == 2


def test_a_newer_message_overtakes_those_that_wait(spark, tmp_path):
    (tmp_path / "got").mkdir()
    receiver, target = Moody(tmp_path / "got"), str(tmp_path / "t")
    how = delivery.Redelivery(pause=1)

    def send(batch, *rows):
        frame = spark.createDataFrame(rows, "message string, uri string, part int")
        delivery.forward(frame, target, receiver, redelivery=how, batch_id=batch, group="uri", order="part")

    send(0, ("a0 1", f"{BASE}/a", 0), ("a1 3", f"{BASE}/a", 1), ("a2 1", f"{BASE}/a", 2), ("b0 9", f"{BASE}/b", 0))
    assert {r.message for r in delivery.queued(spark, target).collect()} == {"a1 3", "a2 1", "b0 9"}
    send(1, ("b new 1", f"{BASE}/b", 0))
    assert {r.message for r in delivery.queued(spark, target).collect()} == {"a1 3", "a2 1"}
    for day in (1, 2, 3):
        delivery.redeliver(spark, target, receiver, how, f"2100-01-0{day} 00:00:00")
    assert delivery.queued(spark, target).count() == 0
    assert receiver.tries() == {"a0 1": 1, "a1 3": 3, "a2 1": 1, "b0 9": 1, "b new 1": 1}


def test_files_are_dropped_into_a_folder_that_is_there(tmp_path):
    drop = delivery.FileDrop(str(tmp_path / "inbox"))
    with pytest.raises(FileNotFoundError):
        drop("x")
    (tmp_path / "inbox").mkdir()
    drop("é")
    drop("é")
    assert [(tmp_path / "inbox" / f).read_text() for f in os.listdir(tmp_path / "inbox")] == ["é", "é"]
