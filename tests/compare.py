"""Run registered queries next to their check SQL and compare the rows as multisets."""

import collections
import datetime
import os
import sys
import time

import duckdb

from eventloom.plans.views import TABLES


def connect(sf_dir):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return db


def plain(value):
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def multiset(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return collections.Counter(tuple(plain(r[i]) for i in order) for r in rows)


def compare(df, db, sql):
    """None if equal, otherwise a short report."""
    result = db.execute(sql)
    columns = [c[0] for c in result.description]
    expected = multiset(columns, result.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    found = multiset(df.columns, [tuple(r) for r in df.collect()])
    if found == expected:
        return None
    extra, lacking = found - expected, expected - found
    return (
        f"rows {sum(found.values())} vs {sum(expected.values())}; "
        f"extra {list(extra.items())[:2]}; lacking {list(lacking.items())[:2]}"
    )


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as contract
    from eventloom.session import local_session

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = local_session()
    db = connect(sf_dir)
    wanted = sys.argv[1:] or list(contract.queries())
    bad = 0
    for name in wanted:
        start = time.time()
        try:
            report = compare(contract.queries()[name](spark, sf_dir), db, contract.oracle_sql()[name])
        except Exception as problem:
            report = f"{type(problem).__name__}: {str(problem)[:600]}"
        bad += report is not None
        print(f"{'ok ' if report is None else 'BAD'} {name} {time.time() - start:.1f}s {report or ''}", flush=True)
    print(f"{bad} differ of {len(wanted)}; unchecked: {sorted(set(contract.queries()) - set(contract.oracle_sql()))}")
