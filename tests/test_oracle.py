"""Every registered query against its DuckDB oracle on the smallest test data."""

import math

import duckdb
import pandas as pd
import pytest

from conftest import SF_SMALL
from shelfwise.plans.registry import QUERIES

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def _rows(pdf):
    cols = sorted(pdf.columns)

    def norm(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return None
        if hasattr(v, "item"):
            v = v.item()
        if isinstance(v, float):
            return round(v, 6)
        return v
    rows = [tuple(norm(x) for x in r) for r in pdf[cols].itertuples(index=False)]
    return cols, sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _names():
    return sorted(QUERIES)


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, con, name):
    from __spark_entry__ import oracle_sql, queries
    got = queries()[name](spark, SF_SMALL).toPandas()
    exp = con.execute(oracle_sql()[name]).df()
    gc, gr = _rows(got)
    ec, er = _rows(exp)
    assert gc == ec
    assert len(gr) == len(er)
    assert gr == er


def test_every_query_has_an_oracle():
    from __spark_entry__ import oracle_sql, queries
    assert set(QUERIES) <= set(queries())
    assert set(QUERIES) <= set(oracle_sql())


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.count() > 0
    assert "health_label" in df.columns
    assert isinstance(df.toPandas(), pd.DataFrame)
