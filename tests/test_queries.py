"""Every query with an oracle against DuckDB on the smallest tables."""

import duckdb
import pandas as pd
import pytest

from pitchlake import catalog

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows(frame: pd.DataFrame) -> list[tuple]:
    def cell(v):
        if pd.isna(v):
            return "null"
        return repr(round(float(v), 6)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)

    cols = sorted(frame.columns)
    return sorted(tuple(map(cell, r)) for r in frame[cols].astype(object).values.tolist())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_against_sql(spark, duck, name):
    got, want = catalog.QUERIES[name](spark, DATA).toPandas(), duck.execute(catalog.ORACLES[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
