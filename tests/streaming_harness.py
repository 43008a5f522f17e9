"""Drive a streaming query over fixture rows: one parquet file per
micro-batch (maxFilesPerTrigger=1, increasing mtimes), then collect the
memory sink."""

import itertools
import os
import tempfile

import pyarrow as pa
import pyarrow.parquet as pq

from tracelens.schema import JOB_SCHEMA, TASK_SCHEMA

_ids = itertools.count()

_ARROW = {"LongType()": pa.int64(), "IntegerType()": pa.int32(), "StringType()": pa.string(),
          "DoubleType()": pa.float64(), "BooleanType()": pa.bool_()}


def _arrow_schema(fields):
    return pa.schema([(f.name, _ARROW[repr(f.dataType)]) for f in fields] + [("event_seq", pa.int64())])


def task_record(job=0, task=0, ts=0, etype=0, machine=-1, priority=0, max_cpu=0.0, ms=True):
    return {"timestamp": ts * (1000 if ms else 1), "missing_info": "123", "job_id": job,
            "task_index": task, "machine_id": machine, "event_type": etype, "username": "Kate",
            "scheduling_class": 2, "priority": priority, "max_cpu": float(max_cpu), "max_ram": 0.0,
            "max_disk": 0.0, "different_machine": False}


def job_record(job=0, ts=0, etype=0, ms=True):
    return {"timestamp": ts * (1000 if ms else 1), "missing_info": "123", "job_id": job,
            "event_type": etype, "username": "Kate", "scheduling_class": 0,
            "job_name": "job42", "logical_job_name": "logicalJob42"}


def write_batches(folder, batches, kind="task", start_seq=0, start_index=0):
    """batches: list of lists of record dicts -> one parquet file each."""
    os.makedirs(folder, exist_ok=True)
    schema = _arrow_schema(TASK_SCHEMA.fields if kind == "task" else JOB_SCHEMA.fields)
    seq = start_seq
    for i, rows in enumerate(batches, start=start_index):
        recs = []
        for r in rows:
            recs.append({**r, "event_seq": seq})
            seq += 1
        path = os.path.join(folder, f"b{i:04d}.parquet")
        pq.write_table(pa.Table.from_pylist(recs, schema=schema), path)
        os.utime(path, (1_600_000_000 + i, 1_600_000_000 + i))
    return seq


def run(spark, out_df, mode="append"):
    name = f"q{next(_ids)}"
    ck = tempfile.mkdtemp(prefix="tl-stream-ck-")
    q = (out_df.writeStream.format("memory").queryName(name).outputMode(mode)
         .option("checkpointLocation", ck).start())
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return spark.sql(f"SELECT * FROM {name}").collect()
