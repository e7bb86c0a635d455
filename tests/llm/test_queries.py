"""Queries that have a SQL twin: equal rows, columns and values."""

import os
import sys

import duckdb
import pytest

from itemscope.llm.queries import ORACLE, QUERIES

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", "..", "tools"))
from oracle_check import TABLES, digest  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14)) and set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    assert digest(QUERIES[name](spark, SF).toPandas()) == digest(con.execute(ORACLE[name]).df())
