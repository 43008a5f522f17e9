"""Session helpers and loading the driver module by path."""

import importlib.util
import os

from tracelens.session import checkpoint_path, cluster_conf, ensure_checkpoint_dir

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_checkpoint_dir_comes_from_the_session(spark):
    current = spark.sparkContext.getCheckpointDir()
    assert current and ensure_checkpoint_dir(spark) == current  # never replaced once set
    assert checkpoint_path(spark, "x").startswith(current.rstrip("/"))


def test_cluster_conf_bounds_partitions():
    big = cluster_conf(100 * 10**12, total_cores=8000)
    assert 16_000 <= int(big["spark.sql.shuffle.partitions"]) <= 100_000
    small = cluster_conf(10**6, total_cores=8)
    assert int(small["spark.sql.shuffle.partitions"]) == 16
    assert big["spark.sql.adaptive.enabled"] == "true"


def test_entry_module_loads_by_path(spark):
    spec = importlib.util.spec_from_file_location("entry_by_path", os.path.join(REPO, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    from tracelens.plans.driver import QUERIES

    # every query of the event library has its SQL; the llm queries may have none
    assert set(QUERIES) <= set(mod.oracle_sql()) <= set(mod.queries())
    assert mod.entry(spark).count() > 0
