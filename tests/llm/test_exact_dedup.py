import hashlib
import re
from collections import defaultdict

import pytest

import __spark_entry__ as contract
from compare import compare, connect
from eventloom.llm import exact_dedup as ex
from eventloom.llm import registry

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.CHECKS))
def test_query_against_sql(spark, name):
    df = contract.queries()[name](spark, SF)
    assert compare(df, connect(SF), contract.oracle_sql()[name]) is None


def plain(rows):
    groups = defaultdict(list)
    for d, t in rows:
        text = re.sub("[\x20\x09-\x0d]+", " ", t or "")
        groups[hashlib.sha256(text.encode()).hexdigest()].append(d)
    out = []
    for digest, ids in groups.items():
        first = min((d for d in ids if d is not None), default=None)
        left = 1
        for d in ids:
            kept = d == first and left == 1
            left -= kept
            out.append((d, first, len(ids), kept, digest))
    return sorted(out, key=repr)


def test_edge_cases(spark, monkeypatch):
    rows = [(5, "a  b"), (3, "a\tb"), (3, "a\nb"), (None, "a b"), (4, " a b"), (6, None), (7, ""), (8, " ")]
    rows += [(None, "alone"), (None, "twice"), (None, "twice"), (9, "x" * 300_000), (10, "x" * 300_000)]
    rows += [(100 + k, "very frequent") for k in range(50)] + [(200 + k, f"pair {k // 2}") for k in range(40)]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, row int, text_sha256 string")
    for frequent in (1, 2_048):
        monkeypatch.setattr(ex, "FREQUENT", frequent)
        got = ex.exact_dedup(docs.repartition(5))
        assert sorted(map(tuple, got.collect()), key=repr) == plain(rows)
    assert ex.exact_dedup(docs.limit(0)).count() == 0


def test_frequent_digests_are_settled_without_the_shuffle(spark, monkeypatch):
    monkeypatch.setattr(ex, "FREQUENT", 1)
    docs = spark.createDataFrame([(k, "same" if k % 3 else f"t{k}") for k in range(300)], "doc_id long, text string")
    same = hashlib.sha256(b"same").hexdigest()
    assert [r.text_sha256 for r in ex.frequent_digests(ex.digested(docs)).collect()] == [same]
