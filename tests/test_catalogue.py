"""Every query with SQL against DuckDB, on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

from lexstrata.plans.catalogue import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def rows(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    plain = lambda v: None if pd.isna(v) else v.item() if hasattr(v, "item") else v
    return sorted((tuple(map(plain, r)) for r in frame.itertuples(index=False, name=None)), key=repr)


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS FROM '{DATA}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, db, name):
    got = QUERIES[name](spark, DATA).toPandas()
    want = db.execute(ORACLES[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
    assert len(got)


def test_entry(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() > 0
