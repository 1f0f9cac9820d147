"""Driver contract: entry smoke, query/oracle parity, oracle match at sf0.001."""

import duckdb
import pytest

import __spark_entry__ as E
from check_oracle import TABLES, digest
from popspark.plans import catalog

from conftest import SF001


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["year", "state_fips", "state_name", "age", "sex", "race_p_ethnicity", "population"]
    assert df.count() > 0
    assert E.entry(spark).schema == df.schema


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) <= set(E.oracle_sql())
    assert set(catalog.QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF001)
    got = [tuple(r) for r in df.collect()]
    rel = duck.sql(E.oracle_sql()[name])
    want = rel.fetchall()
    assert len(got) == len(want)
    assert sorted(df.columns) == sorted(rel.columns)
    assert digest(df.columns, got) == digest(rel.columns, want)


@pytest.mark.parametrize("name", ["pipeline_1990", "pipeline_2010", "scan_csv_missing_tokens", "export_order"])
def test_results_do_not_depend_on_session_settings(spark, duck, name):
    """The driver runs queries in its own session: AQE off, ANSI off, many partitions."""
    changed = {"spark.sql.adaptive.enabled": "false", "spark.sql.ansi.enabled": "false", "spark.sql.shuffle.partitions": "37"}
    before = {k: spark.conf.get(k) for k in changed}
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        df = E.queries()[name](spark, SF001)
        got = [tuple(r) for r in df.collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    rel = duck.sql(E.oracle_sql()[name])
    assert digest(df.columns, got) == digest(rel.columns, rel.fetchall())
