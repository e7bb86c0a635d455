"""Driver contract: entry, every registered query on sf0.001, and the SQL twins."""

import duckdb
import pytest

import __spark_entry__ as E
from itemscope.plans.queries import QUERIES

from conftest import SF001

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0 and len(df.columns) == 17


def test_oracles_are_registered():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_runs_and_matches_oracle(spark, name):
    import sys
    sys.path.insert(0, "tools")
    from oracle_check import digest
    out = E.queries()[name](spark, SF001).toPandas()
    assert len(out.columns) > 0
    sql = E.oracle_sql().get(name)
    if sql is None:
        return
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    assert digest(out) == digest(con.execute(sql).df())
