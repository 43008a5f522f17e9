"""Hashed event_seq floods, checkpoint folder on clusters, default read mode."""

import inspect

import pytest
from pyspark.sql import functions as F

from tracelens.operators.skew import running_count
from tracelens.session import ensure_checkpoint_dir
from tracelens.sources import trace_files


def test_flood_of_hashed_event_seq(spark):
    df = spark.range(4000).select(F.lit(1).alias("k"), F.lit(5).cast("long").alias("timestamp"),
                                  F.xxhash64("id").alias("event_seq"))
    out = running_count(df, ["k"], "n", hot_key_rows=100, chunk_rows=100)
    assert [r["n"] for r in out.orderBy("event_seq").collect()] == list(range(1, 4001))


def test_cluster_needs_a_shared_checkpoint_dir():
    class Conf:
        def get(self, *a):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_readers_fail_on_bad_rows_by_default():
    for f in (trace_files.read_task_events, trace_files.read_job_events):
        assert inspect.signature(f).parameters["mode"].default == "FAILFAST"
