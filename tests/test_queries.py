"""Every query with SQL against DuckDB on the smallest tables."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__

SF = "/root/testdata/sf0.001"
QUERIES, SQL = __spark_entry__._own()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.sql("set timezone='UTC'")
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def told(frame):
    def cell(v):
        if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
            return "NULL"
        return str(int(v)) if isinstance(v, float) and v == int(v) else str(round(v, 5) if isinstance(v, float) else v).replace(" 00:00:00", "")

    frame = frame[sorted(frame.columns)]
    return sorted(tuple(map(cell, r)) for r in frame.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, SF).toPandas()
    if name in SQL:
        expected = duck.sql(SQL[name]).df()
        assert sorted(got.columns) == sorted(expected.columns)
        assert told(got) == told(expected)
    else:
        assert len(got)
