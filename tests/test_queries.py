"""Every registered query of the library against its SQL on the smallest tables."""

import decimal

import duckdb
import pytest

from tracewright.queries import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db(tiny):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tiny}/{t}.parquet'")
    return con


def plain(v):
    return repr(round(v, 9)) if isinstance(v, float) else str(v) if not isinstance(v, decimal.Decimal) else str(v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, tiny, name):
    df = QUERIES[name](spark, tiny)
    cols = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in cols) for r in df.collect())
    if name not in ORACLES:
        assert got
        return
    found = db.execute(ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    assert got == sorted(tuple(plain(r[i]) for i in at) for r in found.fetchall())


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
