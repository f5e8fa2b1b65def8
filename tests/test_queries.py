"""Every query of the library against its SQL, on the smallest tables."""

import datetime
import math
import os

import duckdb
import pytest

from tallyfold import plans

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables here")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return c


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return v


@pytest.mark.parametrize("name", sorted(plans.ORACLE_SQL))
def test_query(spark, duck, name):
    df = plans.QUERIES[name](spark, SF)
    rel = duck.sql(plans.ORACLE_SQL[name])
    names = sorted(df.columns)
    assert names == sorted(rel.columns)
    got = sorted(repr([plain(r[c]) for c in names]) for r in df.collect())
    at = [rel.columns.index(c) for c in names]
    want = sorted(repr([plain(r[k]) for k in at]) for r in rel.fetchall())
    assert got == want


def test_rows_only(spark):
    for name in set(plans.QUERIES) - set(plans.ORACLE_SQL):
        assert plans.QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(plans.QUERIES) <= set(__spark_entry__.queries())
