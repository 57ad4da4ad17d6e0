"""Every registered query that has SQL returns what the SQL says."""

import math

import duckdb
import pandas as pd
import pytest

from plumbline import queries as engine

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def sql(data):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{data}/{t}.parquet'")
    con.execute("set timezone = 'UTC'")
    return con


def plain(v):
    if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return round(v, 8)
    return plain(v.item()) if hasattr(v, "item") else v


def rows(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted([tuple(plain(v) for v in r) for r in frame.itertuples(index=False)], key=repr)


@pytest.mark.parametrize("name", sorted(engine.queries()))
def test_query(spark, data, sql, name):
    out = engine.queries()[name](spark, data).toPandas()
    text = engine.oracle_sql().get(name)
    if text is None:
        assert len(out) > 0
        return
    want = sql.sql(text).df()
    assert sorted(out.columns) == sorted(want.columns)
    assert rows(out) == rows(want)


def test_entry_imports_and_names_match(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
