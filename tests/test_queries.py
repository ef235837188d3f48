"""All queries run, and give what DuckDB gives for their SQL."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from lexiloom.catalogue import QUERIES, SQL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def cells(df: pd.DataFrame) -> list[tuple]:
    one = lambda v: "-" if v is None or (not isinstance(v, list | dict) and pd.isna(v)) else f"{v:.6g}" if isinstance(v, float) else str(v)
    return sorted(tuple(map(one, r)) for r in df[sorted(df.columns)].itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sf, name):
    got = QUERIES[name](spark, sf).toPandas()
    if name in SQL:
        wanted = duck.execute(SQL[name]).fetchdf()
        assert sorted(got.columns) == sorted(wanted.columns)
        assert cells(got) == cells(wanted)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(SQL) <= set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
