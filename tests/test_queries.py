"""Every query with SQL equals DuckDB on the smallest tables; the others run and keep their schema."""

from __future__ import annotations

import duckdb
import numpy as np
import pandas as pd
import pytest

from placemetrics import queries, zone_queries

QUERIES, SQL = queries.QUERIES | zone_queries.QUERIES, queries.SQL | zone_queries.SQL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(df: pd.DataFrame) -> list:
    def one(v):
        if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
            return None
        if isinstance(v, (bool, np.bool_)):
            return str(bool(v))
        return f"{float(v):.6f}" if isinstance(v, (int, float, np.number)) else str(v).removesuffix(" 00:00:00")

    return sorted((tuple(one(v) for v in row) for row in df[sorted(df.columns)].astype(object).values.tolist()), key=repr)


@pytest.fixture(scope="module")
def con(small):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS FROM '{small}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, small, con, name):
    got = QUERIES[name](spark, small).toPandas()
    assert len(got)
    if name in SQL:
        want = con.sql(SQL[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert plain(got) == plain(want)


def test_contract_without_the_training_data_operators(spark):
    import __spark_entry__ as contract

    assert set(QUERIES) <= set(contract.queries()) and set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).count() > 0
