"""Record schemas and event-type codes of the cluster trace.

All timestamps are BIGINT microseconds (``timestamp``); operators derive
``event_time`` (TIMESTAMP) from it for windows and watermarks.  ``event_seq``
is the tie break for events with equal timestamps: operators that depend on
order always sort by (timestamp, event_seq), never by timestamp alone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Lifecycle event codes of the trace format.
SUBMIT = 0
SCHEDULE = 1
EVICT = 2
FAIL = 3
FINISH = 4
KILL = 5
LOST = 6
UPDATE_PENDING = 7
UPDATE_RUNNING = 8

# Code -> name, in code order.
EVENT_TYPE_NAMES = {
    0: "SUBMIT",
    1: "SCHEDULE",
    2: "EVICT",
    3: "FAIL",
    4: "FINISH",
    5: "KILL",
    6: "LOST",
    7: "UPDATE_PENDING",
    8: "UPDATE_RUNNING",
}
EVENT_TYPE_CODES = {v: k for k, v in EVENT_TYPE_NAMES.items()}

TASK_FIELDS = [
    T.StructField("timestamp", T.LongType(), False),
    T.StructField("missing_info", T.StringType(), True),
    T.StructField("job_id", T.LongType(), False),
    T.StructField("task_index", T.IntegerType(), False),
    T.StructField("machine_id", T.LongType(), False),
    T.StructField("event_type", T.IntegerType(), True),
    T.StructField("username", T.StringType(), True),
    T.StructField("scheduling_class", T.IntegerType(), False),
    T.StructField("priority", T.IntegerType(), False),
    T.StructField("max_cpu", T.DoubleType(), False),
    T.StructField("max_ram", T.DoubleType(), False),
    T.StructField("max_disk", T.DoubleType(), False),
    T.StructField("different_machine", T.BooleanType(), False),
]
TASK_SCHEMA = T.StructType(TASK_FIELDS)
TASK_COLUMNS = [f.name for f in TASK_FIELDS]

JOB_FIELDS = [
    T.StructField("timestamp", T.LongType(), False),
    T.StructField("missing_info", T.StringType(), True),
    T.StructField("job_id", T.LongType(), False),
    T.StructField("event_type", T.IntegerType(), True),
    T.StructField("username", T.StringType(), True),
    T.StructField("scheduling_class", T.IntegerType(), False),
    T.StructField("job_name", T.StringType(), True),
    T.StructField("logical_job_name", T.StringType(), True),
]
JOB_SCHEMA = T.StructType(JOB_FIELDS)
JOB_COLUMNS = [f.name for f in JOB_FIELDS]

SEQ = "event_seq"
TS = "timestamp"
EVENT_TIME = "event_time"


def event_type_name(code: Column | str) -> Column:
    """Code -> name through a map literal; unknown codes give NULL."""
    code = F.col(code) if isinstance(code, str) else code
    lookup = F.create_map(*[x for k, v in EVENT_TYPE_NAMES.items() for x in (F.lit(k), F.lit(v))])
    return lookup[code]


def event_type_code(name: Column | str) -> Column:
    """Name -> code; unknown names give NULL."""
    name = F.col(name) if isinstance(name, str) else name
    lookup = F.create_map(*[x for k, v in EVENT_TYPE_CODES.items() for x in (F.lit(k), F.lit(v))])
    return lookup[F.upper(F.trim(name))]


def with_event_time(df, ts: str = TS, out: str = EVENT_TIME):
    """Add the TIMESTAMP column used by windows and watermarks."""
    return df.withColumn(out, F.timestamp_micros(F.col(ts)))


def ensure_event_time(df, ts: str = TS, out: str = EVENT_TIME):
    """``with_event_time`` unless the column is already there."""
    return df if out in df.columns else with_event_time(df, ts, out)


def ensure_seq(df, seq: str = SEQ):
    """Give rows without a sequence column a stable tie break.

    Data read from files gets ``event_seq`` from the reader (file order);
    this fallback derives one from the row's own fields so that it is
    deterministic under task retries (unlike ``monotonically_increasing_id``).
    """
    if seq in df.columns:
        return df
    return df.withColumn(seq, F.xxhash64(*[F.col(c) for c in df.columns]))
