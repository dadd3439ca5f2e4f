"""Folders of very many small files: dealt over shelves, read by the tasks and not by the driver."""

import datetime
import os
import re
import sys
from collections import Counter

import pytest
from pyspark import cloudpickle

from eventloom.plans import views
from eventloom.plans.queries import REGISTRY
from eventloom.streaming import delivery

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def test_what_arrived_is_read_without_a_list_of_files_in_the_driver(spark, tmp_path, monkeypatch):
    from eventloom.plans import queries

    start = datetime.datetime(2024, 1, 1)
    kinds = ("signup", "click", "error", "purchase", "view", None)
    events = [(n, start, n % 9 if n % 50 else None, kinds[n % 6], 1.0, '{"k": 3}') for n in range(400)]
    spark.createDataFrame(events, views.SCHEMAS["events"]).write.parquet(f"{tmp_path}/events.parquet")
    suppliers = [(n % 7, "s", 0, 0.0) for n in range(20)]
    spark.createDataFrame(suppliers, views.SCHEMAS["supplier"]).write.parquet(f"{tmp_path}/supplier.parquet")
    wanted = Counter(r.message for r in REGISTRY["forward_message"](spark, str(tmp_path)).collect())
    assert max(wanted.values()) > 5

    made, own = [], queries.work_dir
    monkeypatch.setattr(queries, "work_dir", lambda *a: made.append(own(*a)) or made[-1])
    frame = REGISTRY["redelivered_later"](spark, str(tmp_path))
    assert frame.columns == ["message", "attempts", "n"]
    assert {tuple(r) for r in frame.collect()} == {(m, 3, n) for m, n in wanted.items()}
    assert not [f for f in frame.inputFiles() if "/inbox/" in f]
    inbox = made[0].removeprefix("file:") + "/inbox"
    files = {d: len([f for f in names if re.fullmatch("[0-9a-f]{16}-[0-9a-f]{32}", f)]) for d, _, names in os.walk(inbox)}
    assert sum(files.values()) == sum(wanted.values())
    assert not files[inbox] and max(files.values()) < 20


@pytest.mark.parametrize("shelves", [None, 3])
def test_drops_are_read_whole(spark, tmp_path, shelves):
    drop = delivery.FileDrop(str(tmp_path / "inbox"), shelves)
    with pytest.raises(FileNotFoundError):
        drop("x")
    with pytest.raises(Exception, match="no such folder"):
        delivery.dropped(spark, drop).collect()
    (tmp_path / "inbox").mkdir()
    assert delivery.dropped(spark, drop).collect() == []
    texts = ["é\nline\r\n", "", " a "] + ["again"] * 40
    for text in texts:
        drop(text)
    (tmp_path / "inbox" / "_SUCCESS").write_text("")
    (tmp_path / "inbox" / "note.txt").write_text("not dropped")
    assert sorted(r.message for r in delivery.dropped(spark, drop).collect()) == sorted(texts)
    folders = [f for f in os.listdir(tmp_path / "inbox") if os.path.isdir(tmp_path / "inbox" / f)]
    assert len(folders) == (shelves or 0)


def test_many_files_of_a_shelf_come_in_batches(spark, tmp_path):
    (tmp_path / "inbox").mkdir()
    drop = delivery.FileDrop(str(tmp_path / "inbox"), 2)
    for n in range(30):
        drop(f"{n} " + "x" * 500_000)
    found = delivery.dropped(spark, drop).selectExpr("split(message, ' ')[0] as n", "length(message) as size").collect()
    assert sorted((int(r.n), r["size"] - len(r.n)) for r in found) == [(n, 500_001) for n in range(30)]


def refuse(payload):
    raise ConnectionError("refused")


def test_waiting_messages_of_no_group_stay_where_they_lie(spark, tmp_path):
    target = str(tmp_path / "t")
    rows = spark.range(0, 400, 1, 4).selectExpr("concat('m', id) as message", "if(id < 8, concat('g', id % 4), null) as uri", "cast(id as int) as part")
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.files.openCostInBytes": str(1 << 30)}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        for batch, some in enumerate((rows, rows.filter("part < 4"))):
            delivery.forward(some, target, refuse, redelivery=delivery.Redelivery(), batch_id=batch, group="uri", order="part")
        delivery.forward(rows.select("message"), f"{target}-alone", refuse, redelivery=delivery.Redelivery())
        found = [r.message for r in delivery.queued(spark, target).collect()]
        alone = delivery.queued(spark, f"{target}-alone").selectExpr("spark_partition_id() as task", "message").collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    # Of the groups only the second batch's four messages still wait.
    assert sorted(found) == sorted(f"m{n}" for n in range(400) if not 4 <= n < 8)
    assert len({r.message for r in alone}) == len(alone) == 400
    assert len({r.task for r in alone}) == 4
