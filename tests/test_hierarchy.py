import pytest

from eventloom import schemas
from eventloom.operators import hierarchy
from eventloom.sources import read_edges, write_edges

FOO, BAR, BAZ = "queue:one", "queue:two", "topic:three"
JSON = "application/json"


def requests(spark, *rows):
    data = [(str(n), "/p", *row) for n, row in enumerate(rows)]
    return spark.createDataFrame(data, schemas.REINDEX_REQUEST)


@pytest.mark.parametrize(
    "content_type, header, body, expected",
    [
        (None, None, None, set()),
        ("text/plain", f" {FOO} ", f'["{BAR}"]', {FOO}),
        (JSON, f"{FOO},,{FOO}\t,{BAR}\n", None, {FOO, BAR}),
        (JSON, FOO, " \n ", {FOO}),
        (JSON, BAZ, f'["{FOO}", "{BAZ}", "{BAR}"]', {FOO, BAR, BAZ}),
        (JSON, None, f'{{"a": "{FOO}", "b": "{BAR}"}}', {FOO, BAR}),
        (JSON, BAZ, "{}", {BAZ}),
        (JSON, None, f'["{FOO}", {{"x": "{BAR}"}}, ["{BAZ}"], null, " "]', {FOO}),
        (JSON, None, f'{{"a": {{"b": "{BAR}"}}, "c": "{FOO}"}}', {FOO}),
        (JSON, None, "[7, true, 1.5]", {"7", "true", "1.5"}),
        (JSON, BAR, '"a scalar"', {BAR}),
    ],
)
def test_recipients(spark, content_type, header, body, expected):
    row = hierarchy.merge_recipients(requests(spark, (content_type, header, body))).first()
    assert set(row.recipients) == expected and len(row.recipients) == len(expected)
    assert row.recipients_text == ",".join(sorted(expected))


def test_answers(spark):
    rows = requests(spark, (None, None, None), (None, FOO, None), (JSON, FOO, "[broken"))
    answers = hierarchy.admit_requests(rows, "http://h").orderBy("request_id").collect()
    assert [(r.status, r.message, r.admitted) for r in answers] == [
        (200, "No endpoints configured for indexing", False),
        (200, "Indexing started at http://h/p", True),
        (400, "Invalid JSON", False),
    ]


def edges(spark, *pairs):
    return spark.createDataFrame(pairs, "parent string, child string")


def roots(spark, *uris):
    return spark.createDataFrame([(u,) for u in uris], "uri string")


def test_walk_visits_each_node_once(spark):
    shared = edges(spark, ("r", "a"), ("r", "b"), ("a", "c"), ("b", "c"), ("c", "d"), ("r", "a"))
    found = hierarchy.traverse(shared, roots(spark, "r", "c", "r"))
    assert {(r.root, r.uri, r.depth) for r in found.collect()} == {
        ("r", "r", 0), ("r", "a", 1), ("r", "b", 1), ("r", "c", 2), ("r", "d", 3),
        ("c", "c", 0), ("c", "d", 1),
    }
    assert found.count() == 7


def test_walk_ends_on_cycles_and_at_max_depth(spark):
    ring = edges(spark, ("a", "b"), ("b", "c"), ("c", "a"))
    assert hierarchy.traverse(ring, roots(spark, "a")).count() == 3
    assert hierarchy.traverse(ring, roots(spark, "a"), max_depth=1).count() == 2
    assert hierarchy.traverse(ring, roots(spark, "lone")).count() == 1


def test_walk_over_stored_edges_reads_only_touched_buckets(spark, tmp_path):
    pairs = [("r", f"n{n}") for n in range(300)] + [(f"n{n}", f"m{n}") for n in range(0, 300, 5)]
    pairs += [("r", "n0"), ("far", "away"), ("r", None)]
    write_edges(edges(spark, *pairs), str(tmp_path), 8)
    asked = []

    def stored(parents):
        found = read_edges(spark, str(tmp_path), parents)
        asked.append(found._jdf.queryExecution().executedPlan().toString())
        return found

    walked = sorted(map(tuple, hierarchy.traverse(stored, roots(spark, "r", "n5")).collect()))
    plain = hierarchy.traverse(edges(spark, *pairs), roots(spark, "r", "n5"))
    assert walked == sorted(map(tuple, plain.collect())) and len(walked) == 363
    assert all("PartitionFilters: [" in text and "bucket" in text.split("PartitionFilters: [")[1][:60] for text in asked), asked


def test_reindex_sends_every_node_to_every_recipient(spark):
    tree = [("http://h/p", f"http://h/p/{a}") for a in "abc"]
    tree += [(f"http://h/p/{a}", f"http://h/p/{a}/{n}") for a in "abc" for n in range(5)]
    rows = requests(spark, (None, f"{FOO},{BAR}", None), (None, None, None), (None, BAZ, None))
    found = hierarchy.reindex(rows, edges(spark, *tree), "http://h").collect()
    assert len(found) == 19 * 3
    assert {r.recipient for r in found if r.request_id == "0"} == {FOO, BAR}


def test_fan_out_ignores_blanks(spark):
    df = spark.createDataFrame([("u", [FOO, "", " ", BAR]), ("v", [])], schemas.HINT)
    assert {tuple(r) for r in hierarchy.fan_out(df).collect()} == {("u", FOO), ("u", BAR)}
