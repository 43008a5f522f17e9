"""Adapter from the driver's ``events`` table to task and job events.

The projection (fixed by the test-data contract) is::

    timestamp        microseconds of ts
    job_id           user_id
    task_index       event_id % 3
    machine_id       -1 when user_id % 20 = 0, else user_id % 20
    event_type       signup 0, click 1, error 3, purchase 4, view 5
    priority         user_id % 12
    scheduling_class user_id % 4
    max_cpu          value
    event_seq        event_id

Everything is a per-row column expression, so Catalyst prunes the scan to
the five columns used and pushes any later filter on them into Parquet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import EVENT_TIME

# Driver event names -> lifecycle codes.
DRIVER_EVENT_CODES = {
    "signup": 0,
    "click": 1,
    "error": 3,
    "purchase": 4,
    "view": 5,
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _micros(spark: SparkSession, ts: str) -> F.Column:
    # ts is TIMESTAMP_NTZ (a wall clock without zone).  The difference to
    # the NTZ epoch involves no time zone, so the result does not depend on
    # spark.sql.session.timeZone.
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", epoch, F.col(ts))


def _event_code(col: str) -> F.Column:
    expr = None
    for name, code in DRIVER_EVENT_CODES.items():
        expr = (F.when(F.col(col) == name, F.lit(code)) if expr is None
                else expr.when(F.col(col) == name, F.lit(code)))
    return expr.cast("int")


def task_events_from_events(spark: SparkSession, events: DataFrame,
                            with_time: bool = True) -> DataFrame:
    uid = F.col("user_id")
    df = events.select(
        _micros(spark, "ts").alias("timestamp"),
        F.lit("").alias("missing_info"),
        uid.alias("job_id"),
        (F.col("event_id") % 3).cast("int").alias("task_index"),
        F.when(uid % 20 == 0, F.lit(-1).cast("long")).otherwise(uid % 20).alias("machine_id"),
        _event_code("event_type").alias("event_type"),
        F.lit("").alias("username"),
        (uid % 4).cast("int").alias("scheduling_class"),
        (uid % 12).cast("int").alias("priority"),
        F.col("value").alias("max_cpu"),
        F.lit(0.0).alias("max_ram"),
        F.lit(0.0).alias("max_disk"),
        F.lit(False).alias("different_machine"),
        F.col("event_id").alias("event_seq"),
    )
    if with_time:
        df = df.withColumn(EVENT_TIME, F.timestamp_micros("timestamp"))
    return df


def job_events_from_events(spark: SparkSession, events: DataFrame,
                           with_time: bool = True) -> DataFrame:
    uid = F.col("user_id")
    df = events.select(
        _micros(spark, "ts").alias("timestamp"),
        F.lit("").alias("missing_info"),
        uid.alias("job_id"),
        _event_code("event_type").alias("event_type"),
        F.lit("").alias("username"),
        (uid % 4).cast("int").alias("scheduling_class"),
        F.lit("").alias("job_name"),
        F.lit("").alias("logical_job_name"),
        F.col("event_id").alias("event_seq"),
    )
    if with_time:
        df = df.withColumn(EVENT_TIME, F.timestamp_micros("timestamp"))
    return df


def restrict(events: DataFrame, types=None, until=None, since=None) -> DataFrame:
    """Filter the raw table before the projection, so the predicates reach
    the Parquet scan (``PushedFilters``): event codes become the raw names,
    an instant bound (microseconds, datetime or ISO string, inclusive)
    becomes a bound on ``ts``."""
    from ..functions.time import instant_micros

    if types is not None:
        names = [n for n, c in DRIVER_EVENT_CODES.items() if c in set(types)]
        events = events.where(F.col("event_type").isin(*names)) if names else events.where(F.lit(False))
    for bound, op in ((until, "<="), (since, ">=")):
        if bound is None:
            continue
        # compare wall clock with wall clock: a TIMESTAMP_NTZ literal
        lit = F.lit(_ntz_literal(instant_micros(bound))).cast("timestamp_ntz")
        events = events.where(F.col("ts") <= lit if op == "<=" else F.col("ts") >= lit)
    return events


def _ntz_literal(micros: int) -> str:
    import datetime as dt

    t = dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=micros)
    return t.isoformat(sep=" ")


def task_events(spark: SparkSession, sf_dir: str, types=None, until=None, since=None) -> DataFrame:
    """Task events projected from ``{sf_dir}/events.parquet``; ``types``,
    ``until`` and ``since`` are pushed into the scan."""
    raw = restrict(read_table(spark, sf_dir, "events"), types, until, since)
    return task_events_from_events(spark, raw)


def job_events(spark: SparkSession, sf_dir: str, types=None, until=None, since=None) -> DataFrame:
    """Job events projected from ``{sf_dir}/events.parquet`` (same pushdown)."""
    raw = restrict(read_table(spark, sf_dir, "events"), types, until, since)
    return job_events_from_events(spark, raw)
