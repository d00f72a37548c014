"""Every query outside the training-data operators against its SQL, over the smallest tables."""

import decimal

import duckdb
import pytest

import __spark_entry__ as entry
from parkwright import plans

SMALL = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    return None if isinstance(v, float) and v != v else round(v, 9) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_query(spark, duck, name):
    df = plans.QUERIES[name](spark, SMALL)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    if name not in plans.ORACLE_SQL:
        assert got
        return
    found = duck.execute(plans.ORACLE_SQL[name])
    names = [x[0] for x in found.description]
    assert sorted(names) == cols
    assert got == sorted((tuple(plain(row[names.index(c)]) for c in cols) for row in found.fetchall()), key=repr)


def test_entry(spark):
    assert entry.entry(spark).count() == 4


def test_names_agree():
    assert set(entry.oracle_sql()) <= set(entry.queries())
