"""Plan properties that matter at scale: no Python in batch plans, type
and time predicates in the Parquet scan, one shuffle of the big side for
the per-key operators, broadcasts only where bounded."""

import os
import re

import pytest

from tracelens.plans.driver import QUERIES

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                "FlatMapCoGroupsInPandas", "PythonUDF")

# these two write all event types and read them back
WRITTEN = ("task_statistics_from_trace_files", "dead_letters")
BATCH = [n for n in QUERIES if not n.endswith("_stream") and n not in WRITTEN]


def _plan(spark, name):
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the static plan
    try:
        return QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)


@pytest.mark.parametrize("name", BATCH)
def test_batch_plans_stay_in_the_jvm(spark, name):
    plan = _plan(spark, name)
    assert not any(node in plan for node in PYTHON_NODES), name


@pytest.mark.parametrize("name", [n for n in BATCH if not n.startswith("task_event_")
                                  and n != "job_event_count"])  # counts every type
def test_event_types_reach_the_scan(spark, name):
    plan = _plan(spark, name)
    assert re.search(r"PushedFilters: \[[^\]]*(In\(event_type|EqualTo\(event_type)", plan), name


@pytest.mark.parametrize("name", ["job_event_count", "job_scheduling_latency",
                                  "job_scheduling_latency_first", "job_scheduling_latency_directed",
                                  "longest_session_per_job", "task_sessions"])
def test_per_key_operators_shuffle_once(spark, name):
    plan = _plan(spark, name)
    shuffles = re.findall(r"Exchange hashpartitioning\(", plan)
    assert len(shuffles) == 1, (name, len(shuffles))


def test_training_pass_reads_only_the_training_range(spark):
    from tracelens.plans.driver import TRAINING_END
    from tracelens.sources.tables import task_events

    df = task_events(spark, SF, types=(0, 1), until=TRAINING_END)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(ts," in plan


def test_scan_reads_only_used_columns(spark):
    plan = _plan(spark, "task_statistics_per_machine")
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert set(c.split(":")[0] for c in schema.split(",")) == {"ts", "user_id", "event_type"}
