"""Registered queries against their DuckDB statements on the smallest tables."""

import math

import duckdb
import pandas as pd
import pytest

from shelfwise.llm.oracles import ORACLES
from shelfwise.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def rows(pdf):
    cols = sorted(pdf.columns)

    def norm(v):
        if v is None or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
            return None
        v = v.item() if hasattr(v, "item") else v
        return round(float(v), 6) if isinstance(v, (int, float)) and not isinstance(v, bool) else v
    return cols, sorted((tuple(norm(x) for x in r) for r in pdf[cols].itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels", "pages", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    assert rows(QUERIES[name](spark, SF).toPandas()) == rows(con.execute(ORACLES[name]).df())


def test_one_query_for_each_operator():
    numbers = sorted(int(q[2:].split("_")[0]) for q in QUERIES)
    assert numbers == list(range(1, 14))
