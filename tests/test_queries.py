"""Every query that has SQL gives the SQL's rows on the smallest tables."""

import math

import duckdb
import pandas as pd
import pytest

from sievecraft.plans import catalogue

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("set TimeZone='UTC'")
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


def rows(df: pd.DataFrame) -> list:
    plain = lambda v: None if v is None or v is pd.NaT or (isinstance(v, float) and math.isnan(v)) else round(float(v), 6) if isinstance(v, float) else v
    return sorted((tuple(map(plain, r)) for r in df[sorted(df.columns)].itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_equals_sql(spark, duck, name):
    assert rows(catalogue.QUERIES[name](spark, DATA).toPandas()) == rows(duck.sql(catalogue.ORACLE_SQL[name]).df())


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLE_SQL)))
def test_runs(spark, name):
    assert catalogue.QUERIES[name](spark, DATA).limit(5).collect()
