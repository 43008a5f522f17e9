"""Driver contract: entry() runs, and every registered query equals its
DuckDB oracle on the sf0.001 tables (row count, columns, values)."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from tracelens.plans.driver import QUERIES
from tracelens.plans.oracle import ORACLE

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")


def _norm(v):
    if isinstance(v, float):
        return round(v, 6) + 0.0
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(repr(_norm(r[i])) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("events",):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns[:2] == ["window_start", "machine_id"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert QUERIES.items() <= E.queries().items()
    missing = set(QUERIES) - set(ORACLE)
    assert not missing, missing


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    res = duck.execute(ORACLE[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _rows(df.columns, df.collect()) == _rows(ocols, res.fetchall())


@pytest.mark.parametrize("tz", ["America/Los_Angeles", "Asia/Kolkata"])
def test_results_do_not_depend_on_session_time_zone(spark, duck, tz):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", tz)
    try:
        for name in ("task_statistics_per_machine", "job_scheduling_latency", "invariant_anomaly",
                     "busy_machines"):
            df = QUERIES[name](spark, SF)
            res = duck.execute(ORACLE[name])
            ocols = [d[0] for d in res.description]
            assert _rows(df.columns, df.collect()) == _rows(ocols, res.fetchall()), name
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
