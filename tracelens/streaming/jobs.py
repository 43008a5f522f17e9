"""Structured Streaming forms of the jobs.

Stateless and window jobs (J4-J7) reuse the batch operators on a stream with
a watermark.  Per-event state machines (J1, T1 for J2/J3/J11, T2 for J9/J10,
J8, J12) run as ``transformWithStateInPandas`` processors keyed like the
batch jobs; see ``processors``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.time import interval_micros
from ..operators import windows as W
from ..operators.filters import keep_types, schedule_with_cpu
from ..schema import EVENT_TIME, FINISH, JOB_SCHEMA, SCHEDULE, SUBMIT, TASK_SCHEMA
from ..sources.tables import job_events_from_events, task_events_from_events
from . import processors as P

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def ensure_rocksdb(spark: SparkSession) -> None:
    """transformWithState keeps several state variables per key, which only
    the RocksDB state store supports; select it when the session uses
    another provider (a runtime SQL setting, read when a query starts)."""
    key = "spark.sql.streaming.stateStore.providerClass"
    if spark.conf.get(key, None) != ROCKSDB:
        spark.conf.set(key, ROCKSDB)


def _tws(grouped, df: DataFrame, proc, schema, time_mode: str, **kw) -> DataFrame:
    """``transformWithStateInPandas`` in append mode (processors are pickled
    by value, see ``processors``)."""
    ensure_rocksdb(df.sparkSession)
    return grouped.transformWithStateInPandas(proc, schema, "Append", time_mode, **kw)


#: Buckets of keys that the event-order processors (J1, T1, T2) work on, by default.
BUCKETS = 256


def bucketed(df: DataFrame, keys, buckets: int | None):
    """``df`` grouped into buckets of keys by a hash.  More buckets: smaller groups
    and state values, more calls a micro-batch.  A restart from a checkpoint needs
    the same number."""
    return df.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets or BUCKETS)).cast("int")).groupBy("_bucket")


EVENTS_SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def with_watermark(df: DataFrame, delay: str = "0 seconds") -> DataFrame:
    if EVENT_TIME not in df.columns:
        df = df.withColumn(EVENT_TIME, F.timestamp_micros("timestamp"))
    return df.withWatermark(EVENT_TIME, delay)


def read_events_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A folder of ``events``-table parquet files as a stream."""
    r = spark.readStream.schema(EVENTS_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.parquet(path)


TASK_STREAM_SCHEMA = T.StructType(TASK_SCHEMA.fields + [T.StructField("event_seq", T.LongType())])


def read_task_stream(spark: SparkSession, path: str, delay: str = "0 seconds",
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """A folder of parquet files with task-event columns (and event_seq) as
    a watermarked stream."""
    r = spark.readStream.schema(TASK_STREAM_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return with_watermark(r.parquet(path), delay)


JOB_STREAM_SCHEMA = T.StructType(JOB_SCHEMA.fields + [T.StructField("event_seq", T.LongType())])


def read_job_stream(spark: SparkSession, path: str, delay: str = "0 seconds",
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """A folder of parquet files with job-event columns (and event_seq) as
    a watermarked stream."""
    r = spark.readStream.schema(JOB_STREAM_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return with_watermark(r.parquet(path), delay)


def task_stream(spark: SparkSession, path: str, delay: str = "0 seconds",
                max_files_per_trigger: int | None = None) -> DataFrame:
    ev = read_events_stream(spark, path, max_files_per_trigger)
    return with_watermark(task_events_from_events(spark, ev), delay)


def job_stream(spark: SparkSession, path: str, delay: str = "0 seconds",
               max_files_per_trigger: int | None = None) -> DataFrame:
    ev = read_events_stream(spark, path, max_files_per_trigger)
    return with_watermark(job_events_from_events(spark, ev), delay)


# ---------------------------------------------------------------- J1, T1

def _ttl_ms(ttl) -> int | None:
    return None if ttl is None else max(1, interval_micros(ttl) // 1000)


def _ordered(order: str) -> bool:
    if order not in ("event", "arrival"):
        raise ValueError("order must be 'event' or 'arrival'")
    return order == "event"


def job_event_count_stream(jobs: DataFrame, compact: bool = False, order: str = "event",
                           buckets: int | None = None) -> DataFrame:
    """One row per event with the job's running count (append sink).

    ``order="event"``: counted in (timestamp, event_seq) order, a row when
    the watermark has passed it; ``"arrival"``: as the rows come, at once.
    ``compact=True``: one row per job and micro-batch with the count so far
    (a streaming aggregation for an ``update`` sink; partial aggregation)."""
    if compact:
        return jobs.groupBy("job_id").agg(F.count(F.lit(1)).alias("event_count"))
    ordered = _ordered(order)
    schema = "job_id long, timestamp long, event_seq long, event_count long"
    src = jobs.select("job_id", "timestamp", "event_seq", *[EVENT_TIME] * ordered)
    return _tws(bucketed(src, ["job_id"], buckets), src, P.RunningCount(src.schema["job_id"], ordered), schema,
                "EventTime" if ordered else "None")


def pair_stream(df: DataFrame, keys, type_a: int, type_b: int, repeat: str = "latest",
                carry=(), event_time: bool = False, ttl: str | int | None = None,
                order: str | None = None, buckets: int | None = None) -> DataFrame:
    """T1 stream: alternating pairs per key (append).

    ``order="event"`` (default): each key's events are matched in (timestamp,
    event_seq) order, a pair comes out when the watermark has passed its
    closing event.  ``"arrival"``: matched as they come, at once.
    ``event_time=True`` adds an ``event_time`` and declares it the output's
    event-time column, so a later stateful operator keeps the watermark: the
    closing event's time, in event order just past the watermark by which the pair
    is certain.
    ``ttl`` (interval or microseconds) drops slots untouched that long in
    processing time, and so goes with order of arrival (its default order)."""
    order = order or ("event" if ttl is None else "arrival")
    ordered = _ordered(order)
    if ordered and ttl is not None:
        raise ValueError("ttl runs on processing time: it needs order='arrival'")
    keys, carry = list(keys), [c for c in carry if c not in keys]
    kept = [df.schema[c] for c in carry]
    fields = [df.schema[k] for k in keys] + [
        T.StructField("timestamp", T.LongType()), T.StructField("event_seq", T.LongType()),
        T.StructField("event_type", T.IntegerType())] + kept + [
        T.StructField("partner_timestamp", T.LongType()), T.StructField("partner_seq", T.LongType()),
        T.StructField("duration", T.LongType())]
    src = keep_types(df, type_a, type_b).select(*keys, "timestamp", "event_seq", "event_type", *carry,
                                                *[EVENT_TIME] * ordered)
    proc = P.PairMatcher([df.schema[k] for k in keys], type_a, type_b, repeat, kept, event_time, _ttl_ms(ttl), ordered)
    grouped = bucketed(src, keys, buckets)
    if not event_time:
        # state TTL runs on processing time
        mode = "EventTime" if ordered else "ProcessingTime" if ttl is not None else "None"
        return _tws(grouped, src, proc, T.StructType(fields), mode)
    fields.append(T.StructField(EVENT_TIME, T.TimestampType()))
    return _tws(grouped, src, proc, T.StructType(fields), "EventTime",
                eventTimeColumnName=EVENT_TIME)


def job_scheduling_latency_stream(jobs: DataFrame, repeat: str = "latest", ttl=None,
                                  order: str | None = None, buckets: int | None = None) -> DataFrame:
    p = pair_stream(jobs, ["job_id"], SUBMIT, SCHEDULE, repeat, ttl=ttl, order=order, buckets=buckets)
    return p.select("job_id", "timestamp", "event_seq", F.col("duration").alias("latency"))


def task_duration_stream(tasks: DataFrame, type_a: int = SUBMIT, type_b: int = FINISH,
                         ttl=None, order: str | None = None, buckets: int | None = None) -> DataFrame:
    return pair_stream(tasks, ["job_id", "task_index"], type_a, type_b, carry=["priority"], ttl=ttl, order=order,
                       buckets=buckets)


def max_task_completion_stream(tasks: DataFrame, running: bool = True, order: str | None = None,
                               buckets: int | None = None) -> DataFrame:
    """Running maximum duration per priority, one row per completed task
    (append sink).  In event order every micro-batch brings the pairs closed
    between two watermarks, all of them, so ordering them within the batch orders the
    whole.  ``running=False``: one row per priority and micro-batch
    with the maximum so far (an aggregation after the pair processor, for an
    ``update`` sink)."""
    if not running:
        d = task_duration_stream(tasks, SUBMIT, FINISH, order=order, buckets=buckets)
        return d.groupBy("priority").agg(F.max("duration").alias("max_duration"))
    d = task_duration_stream(tasks, SUBMIT, FINISH, order=order, buckets=buckets).select(
        "priority", "timestamp", "event_seq", "duration")
    return _tws(d.groupBy("priority"), d, P.RunningMax(),
                "priority int, timestamp long, event_seq long, max_duration long", "None")


def invariant_anomaly_stream(tasks: DataFrame, training_end, buckets: int | None = None) -> DataFrame:
    """Pairs per (job, task), then train-then-detect per priority by
    event time (detection rows are held until the watermark passes the
    training end)."""
    from ..functions.time import instant_micros

    end = instant_micros(training_end)
    d = pair_stream(tasks, ["job_id", "task_index"], SUBMIT, SCHEDULE, carry=["priority"],
                    event_time=True, buckets=buckets)
    d = d.select("priority", "job_id", "task_index", "timestamp", "event_seq", "duration", EVENT_TIME)
    schema = ("priority int, job_id long, task_index int, timestamp long, event_seq long, "
              "duration long")
    return _tws(d.groupBy("priority"), d, P.InvariantCheck(end), schema, "EventTime")


# ---------------------------------------------------------------- J4-J7

def filter_task_events_stream(tasks: DataFrame, types=(SUBMIT, FINISH)) -> DataFrame:
    return keep_types(tasks, *types)


def task_statistics_stream(tasks: DataFrame, window: str = "1 minute", by=None) -> DataFrame:
    """J5 / J6 on a watermarked stream (append: a window is emitted once)."""
    return W.task_statistics(tasks, window, by)


def busy_machines_stream(tasks: DataFrame, length: str = "15 minutes", slide: str = "5 minutes",
                         threshold: int = 15) -> DataFrame:
    """J7 as two chained aggregations (append); the second groups by the
    event time of the first window so the watermark carries over."""
    t = keep_types(tasks, SCHEDULE)
    per_machine = (t.groupBy("machine_id", F.window(EVENT_TIME, length, slide).alias("w"))
                   .agg(F.count(F.lit(1)).alias("n")))
    busy = per_machine.where(F.col("n") >= threshold).select(F.window_time("w").alias("wt"))
    out = busy.groupBy("wt").agg(F.count(F.lit(1)).alias("busy_machines"))
    return out.select((F.unix_micros("wt") + 1).alias("window_end"), "busy_machines")


# ---------------------------------------------------------------- J8

def longest_session_stream(tasks: DataFrame, jobs: DataFrame, gap: str = "10 minutes",
                           wait_for_open_session: bool = False) -> DataFrame:
    """Closed sessions and FINISH events meet in one processor per job;
    the first FINISH arms an event-time timer that emits the longest
    session seen when it fires (just after the finish, or one gap later with
    ``wait_for_open_session``)."""
    s = (keep_types(tasks, SUBMIT).groupBy("job_id", F.session_window(EVENT_TIME, gap).alias("s"))
         .agg(F.count(F.lit(1)).alias("session_events")))
    sessions = s.select("job_id", F.window_time("s").alias(EVENT_TIME),
                        (F.unix_micros(F.window_time("s")) + 1).alias("timestamp"),
                        F.lit(0).cast("long").alias("event_seq"), F.lit("s").alias("kind"),
                        "session_events")
    fin = keep_types(jobs, FINISH).select("job_id", EVENT_TIME, "timestamp", "event_seq",
                                          F.lit("f").alias("kind"),
                                          F.lit(None).cast("long").alias("session_events"))
    both = sessions.unionByName(fin)
    wait = interval_micros(gap) if wait_for_open_session else 0
    return _tws(both.groupBy("job_id"), both, P.LongestSession(wait), "job_id long, session_events long",
                "EventTime")


# ---------------------------------------------------------------- J9 / J10

SLOT_SCHEMA = P.SLOT_SCHEMA


def rule_anomaly_stream(tasks: DataFrame, e1: int, e2: int, e3: int, limit,
                        keys=("job_id", "task_index"), ttl=None, buckets: int | None = None) -> DataFrame:
    """J9 / J10 (repeat epochs, event time).  ``ttl`` (event time) clears
    slots that wait longer than that for an e1 (they would block forever)."""
    keys = list(keys)
    cols = [f.name for f in SLOT_SCHEMA.fields]
    flat = [tasks.schema[k] for k in keys] + [
        T.StructField(f"{s}_{f.name}", f.dataType) for s in ("first", "second", "third")
        for f in SLOT_SCHEMA.fields]
    src = keep_types(tasks, e1, e2, e3).select(*dict.fromkeys(keys + cols + [EVENT_TIME]))
    proc = P.SequenceRule([tasks.schema[k] for k in keys], e1, e2, e3, interval_micros(limit),
                          None if ttl is None else interval_micros(ttl))
    out = _tws(bucketed(src, keys, buckets), src, proc, T.StructType(flat), "EventTime")
    return out.select(*keys, *[F.struct(*[F.col(f"{s}_{c}").alias(c) for c in cols]).alias(s)
                               for s in ("first", "second", "third")])


def start_rule_anomaly(tasks: DataFrame, sink: str, checkpoint: str, e1: int, e2: int, e3: int,
                       limit, available_now: bool = True, trigger_interval: str = "1 second"):
    """The restartable rule job.  ``tasks`` is a watermarked task stream
    (files via ``read_task_stream`` / ``task_stream``, or Kafka via
    ``sources.kafka.read_task_topic``).  Anomalies go to parquet at ``sink``;
    offsets, state and sink commits live under ``checkpoint`` (a folder of
    the cluster's shared ``spark.checkpoint.dir``), so a restart after a
    failure continues from the last committed batch with the same output."""
    out = rule_anomaly_stream(tasks, e1, e2, e3, limit)
    w = (out.writeStream.format("parquet").option("path", sink)
         .option("checkpointLocation", checkpoint).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger_interval)
    return w.start()


# ---------------------------------------------------------------- J12

def time_series_anomaly_stream(tasks: DataFrame, length="5 seconds", slide="2 seconds",
                               windows: int = 3, diff: float = 0.3, by: str = "machine_id") -> DataFrame:
    # keep the window's event time so the watermark reaches the processor
    t = schedule_with_cpu(tasks)
    a = (t.groupBy(by, F.window(EVENT_TIME, length, slide).alias("w"))
         .agg(F.avg("max_cpu").alias("current_avg")))
    a = a.select(by, F.window_time("w").alias(EVENT_TIME),
                 (F.unix_micros(F.window_time("w")) + 1).alias("window_end"), "current_avg")
    schema = T.StructType([tasks.schema[by], T.StructField("window_end", T.LongType()),
                           T.StructField("current_avg", T.DoubleType()),
                           T.StructField("moving_avg", T.DoubleType())])
    proc = P.MovingAverageCheck(windows, interval_micros(slide), diff, by)
    return _tws(a.groupBy(by), a, proc, schema, "EventTime")
