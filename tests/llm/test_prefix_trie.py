import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest

from compare import compare
from eventloom.llm import prefix_trie as pt

SCHEMA = "conv_id long, turn long, role string, text string, depth int"


def ordered(rows):
    """Turns of each conversation; only equal rows share a number in these tests."""
    out = defaultdict(list)
    for c, turn, role, text, _ in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
        if c is not None:
            out[c].append((role or "", text or ""))
    return out


def rebuild(original):
    out = {}
    for c, own in original.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = original.get(c - c % 5, [])[:h] + own[h:]
    return out


def plain(conversations):
    members = defaultdict(list)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    rows = set()
    for path, inside in members.items():
        subtree = [p for p in members if p[: len(path)] == path]
        children = [p for p in subtree if len(p) == len(path) + 1]
        leaves = [p for p in subtree if not any(q[:-1] == p for q in members if q)]
        saved = sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in subtree if p)
        ends = ",".join(str(c) for c in sorted(inside) if len(conversations[c]) == len(path))
        rows.add((
            min(inside), len(path), min(members[path[:-1]]) if path else None, len(inside),
            len(children), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return rows


def samples():
    rng = random.Random(12)
    rows = []
    for c in [*range(60), 1000, 1001, 5_000, 70_003]:
        for t in range(rng.choice([1, 2, 3, 4, 9, 17])):
            role = rng.choice(["user", "assistant", None])
            rows.append((c, t if t or rng.random() < 0.8 else None, role, rng.choice(["a", "é", "", None, "bb"]), 1))
    rows += [(9, 3, "x", "twice", 1), (9, 3, "x", "twice", 1), (None, 0, "user", "nobody", 1), (64, 0, None, None, 1)]
    return [r for r in rows if r[0] != 45]


def check(spark, got, wanted):
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len(set(found)) and set(found) == wanted


def test_tries_equal_the_definition(spark):
    rows = samples()
    df = spark.createDataFrame(rows, SCHEMA)
    check(spark, pt.conversation_trie(df), plain(ordered(rows)))
    check(spark, pt.prefix_trie(pt.rebuilt(pt.signed(df))), plain(rebuild(ordered(rows))))


def test_long_tails_copies_and_turnless(spark):
    rows = [(c, t, "u", f"same {t}", 0) for c in range(0, 40) for t in range(3)]
    rows += [(c, t, "u", f"same {t}" if t < 70 else f"{c} {t}", 0) for c in (101, 102) for t in range(90)]
    rows += [(5_000 + 4_096 * c, t, "u", "copy", 0) for c in range(6) for t in range(2)]
    df = spark.createDataFrame(rows, SCHEMA)
    check(spark, pt.conversation_trie(df), plain(ordered(rows)))
    check(spark, pt.prefix_trie(pt.rebuilt(pt.signed(df))), plain(rebuild(ordered(rows))))
    short = [(c, 0, "u", "x", 0) for c in range(1, 100) if c % 5]
    lone = rebuild(ordered(short))
    assert any(not t for t in lone.values())
    check(spark, pt.prefix_trie(pt.rebuilt(pt.signed(spark.createDataFrame(short, SCHEMA)))), plain(lone))


def test_private_tails_need_no_level(spark):
    rows = [(c, t, "u", f"{c} {t}", 0) for c in range(5) for t in range(200)]
    rows += [(9, 0, "u", "0 0", 0)]
    entry = pt.entering(pt.merged(pt.paths(pt.signed(spark.createDataFrame(rows, SCHEMA)))))
    assert {r.conv_id: r.entry for r in entry.collect()} == {0: 2, 1: 1, 2: 1, 3: 1, 4: 1, 9: 1}


def test_empty_table(spark):
    assert pt.conversation_trie(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_its_sql(spark, sf):
    db = duckdb.connect()
    db.execute(f"create view conversations as select * from '/root/testdata/{sf}/conversations.parquet'")
    assert compare(pt.op12_prefix_trie(spark, f"/root/testdata/{sf}"), db, pt.OP12_SQL) is None
