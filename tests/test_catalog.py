"""Every query runs; those that SQL can state agree with it row by row."""

import math
from pathlib import Path

import duckdb
import pytest

from millrace.plans import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def plain(v):
    return round(v, 6) if isinstance(v, float) and not math.isnan(v) else v


@pytest.mark.parametrize("name", [n for n in catalog.QUERIES if n in catalog.ORACLES])
def test_against_sql(spark, db, name):
    df = catalog.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = [tuple(plain(r[c]) for c in columns) for r in df.collect()]
    told = db.execute(catalog.ORACLES[name])
    names = [d[0] for d in told.description]
    assert sorted(names) == columns
    want = [tuple(plain(r[names.index(c)]) for c in columns) for r in told.fetchall()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


@pytest.mark.parametrize("name", [n for n in catalog.QUERIES if n not in catalog.ORACLES])
def test_runs(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
