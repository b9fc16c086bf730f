"""Every core query against its SQL on the smallest tables."""

import glob
import os

import duckdb
import pytest

from presslake.plans import queries


@pytest.fixture(scope="module")
def db(small):
    con = duckdb.connect()
    con.execute("set TimeZone='UTC'")
    for f in glob.glob(f"{small}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


def plain(v):
    if v is None or v != v:
        return None
    if isinstance(v, float):
        return round(v, 6)
    return str(v)[:19].replace(" 00:00:00", "") if hasattr(v, "year") else str(v)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, small, db, name):
    frame = queries.QUERIES[name](spark, small)
    columns = sorted(frame.columns)
    got = frame.select(*columns).collect()
    if name not in queries.ORACLE:
        assert frame.columns
        return
    cursor = db.execute(queries.ORACLE[name])
    names = [d[0] for d in cursor.description]
    rows = [dict(zip(names, r)) for r in cursor.fetchall()]
    assert sorted(names) == columns
    key = lambda r: tuple(repr(plain(r[c])) for c in columns)
    assert sorted(map(key, got)) == sorted(map(key, rows))


def test_entry(spark, small):
    import __spark_entry__ as entry

    assert set(queries.QUERIES) <= set(entry.queries()) and entry.entry(spark).count() > 0
