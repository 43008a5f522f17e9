import os
import sys

import pytest
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tracelens.schema import JOB_SCHEMA, TASK_SCHEMA  # noqa: E402
from tracelens.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores="*", shuffle_partitions=8)
    yield s
    s.stop()


def _task_row(job=0, task=0, ts=0, etype=0, machine=-1, priority=0, max_cpu=0.0, **kw):
    return {
        "timestamp": int(ts), "missing_info": kw.get("missing_info", "123"), "job_id": int(job),
        "task_index": int(task), "machine_id": int(machine), "event_type": etype,
        "username": "Kate", "scheduling_class": 2, "priority": int(priority),
        "max_cpu": float(max_cpu), "max_ram": 0.0, "max_disk": 0.0, "different_machine": False,
    }


def make_tasks(spark, rows, ms=True):
    """rows: dicts of _task_row arguments.  Fixture times are milliseconds;
    the engine's timestamp is microseconds (x1000).  event_seq = list order."""
    data = []
    for i, r in enumerate(rows):
        d = _task_row(**r)
        if ms:
            d["timestamp"] *= 1000
        data.append(tuple(d[f.name] for f in TASK_SCHEMA.fields) + (i,))
    schema = T.StructType(TASK_SCHEMA.fields + [T.StructField("event_seq", T.LongType(), False)])
    return spark.createDataFrame(data, schema)


def make_jobs(spark, rows, ms=True):
    data = []
    for i, r in enumerate(rows):
        ts = int(r["ts"]) * (1000 if ms else 1)
        data.append((ts, "123", int(r["job"]), r["etype"], "Kate", 0, "job42", "logicalJob42", i))
    schema = T.StructType(JOB_SCHEMA.fields + [T.StructField("event_seq", T.LongType(), False)])
    return spark.createDataFrame(data, schema)
