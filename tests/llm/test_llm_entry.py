"""The registered queries, and those with SQL against DuckDB."""

import re

import duckdb
import pytest

import __spark_entry__ as E
from check_oracle import TABLES, digest
from popspark.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    names = [n for n in E.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert set(names) == set(QUERIES) and "pipeline" in E.queries()
    assert set(ORACLE_SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    rel = con.sql(ORACLE_SQL[name])
    want = rel.fetchall()
    got = [tuple(r) for r in df.collect()]
    assert len(got) == len(want) > 0
    assert digest(df.columns, got) == digest(rel.columns, want)
