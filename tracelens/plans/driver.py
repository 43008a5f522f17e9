"""Driver queries: each takes (spark, sf_dir) and runs one operator of the
library over the whole ``events`` table at that scale.  Parameters are the
day-scale ones of the test-data contract (the table spans 30 days with
about ten hours between two events of one user).  ``types=`` / ``until=``
on the adapter push the operator's own type and time filters into the
Parquet scan; the operators filter again, so results never depend on it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import codec
from ..operators import anomaly, filters, pairs, patterns, rolling, sessions, windows
from ..schema import FAIL, FINISH, KILL, SCHEDULE, SUBMIT
from ..session import checkpoint_path
from ..sources.tables import DRIVER_EVENT_CODES, job_events, job_events_from_events, task_events, task_events_from_events
from ..streaming import jobs as S

TERMINAL = (FAIL, FINISH, KILL)

Query = Callable[[SparkSession, str], DataFrame]


def task_statistics_per_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.task_statistics(task_events(spark, sf_dir, types=TERMINAL), window="1 day",
                                   by="machine_id")


def task_statistics_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.task_statistics(task_events(spark, sf_dir, types=TERMINAL), window="1 day")


def filter_task_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.filter_task_events(task_events(spark, sf_dir, types=(SUBMIT, FINISH))).select(
        "timestamp", "job_id", "task_index", "machine_id", "event_type", "priority",
        "scheduling_class", "max_cpu", "event_seq")


def busy_machines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.busy_machines(task_events(spark, sf_dir, types=(SCHEDULE,)), length="3 days",
                                 slide="1 day", threshold=10)


def busy_machines_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J7 with 1-day windows sliding by 1 hour (24 windows per event: the
    pane-based plan)."""
    return windows.busy_machines(task_events(spark, sf_dir, types=(SCHEDULE,)), length="1 day",
                                 slide="1 hour", threshold=5)


def job_event_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rolling.job_event_count(job_events(spark, sf_dir))


def job_scheduling_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.job_scheduling_latency(job_events(spark, sf_dir, types=(SUBMIT, SCHEDULE)),
                                        repeat="latest")


def job_scheduling_latency_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.job_scheduling_latency(job_events(spark, sf_dir, types=(SUBMIT, SCHEDULE)),
                                        repeat="first")


def max_task_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.max_task_completion(task_events(spark, sf_dir, types=(SUBMIT, FINISH)))


def max_task_completion_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.max_task_completion(task_events(spark, sf_dir, types=(SUBMIT, FINISH)), running=True)


def longest_session_per_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.longest_session_per_job(task_events(spark, sf_dir, types=(SUBMIT,)),
                                            job_events(spark, sf_dir, types=(FINISH,)), gap="3 days")


def longest_session_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.longest_session_per_job(task_events(spark, sf_dir, types=(SUBMIT,)),
                                            job_events(spark, sf_dir, types=(FINISH,)), gap="3 days",
                                            with_bounds=True)


RULE = dict(e1=SUBMIT, e2=SCHEDULE, e3=KILL, limit="5 days")
RULE_TYPES = (SUBMIT, SCHEDULE, KILL)


def rule_anomaly_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = patterns.rule_anomaly(task_events(spark, sf_dir, types=RULE_TYPES), **RULE)
    return r.select("job_id", "task_index",
                    *[F.col(f"{s}.{c}").alias(f"{s}_{c.replace('event_', '')}")
                      for s in ("first", "second", "third") for c in ("timestamp", "event_seq")])


def rule_anomaly_repeat(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = patterns.rule_anomaly(task_events(spark, sf_dir, types=RULE_TYPES), epoch="repeat", **RULE)
    return r.select("job_id", "task_index",
                    *[F.col(f"{s}.{c}").alias(f"{s}_{c.replace('event_', '')}")
                      for s in ("first", "second", "third") for c in ("timestamp", "event_seq")])


TRAINING_END = "2024-01-15"


def invariant_anomaly(spark: SparkSession, sf_dir: str) -> DataFrame:
    types = (SUBMIT, SCHEDULE)
    return anomaly.invariant_anomaly(
        task_events(spark, sf_dir, types=types), TRAINING_END,
        training_tasks=task_events(spark, sf_dir, types=types, until=TRAINING_END))


def time_series_anomaly(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = anomaly.time_series_anomaly(task_events(spark, sf_dir, types=(SCHEDULE,)), length="3 days",
                                    slide="1 day",
                                    windows=3, diff=0.3)
    return r.select("machine_id", "window_end", F.round("current_avg", 6).alias("current_avg"),
                    F.round("moving_avg", 6).alias("moving_avg"))


WIRE_COLUMNS = ["event_seq", "timestamp", "missing_info", "job_id", "task_index", "machine_id",
                "event_type", "username", "scheduling_class", "priority", "max_cpu", "max_ram",
                "max_disk", "different_machine"]


def _roundtrip(spark: SparkSession, sf_dir: str, fmt: str) -> DataFrame:
    tasks = task_events(spark, sf_dir)
    value = codec.to_json_value(tasks) if fmt == "json" else codec.to_text_value(tasks)
    wire = tasks.select("event_seq", value.alias("value"))
    return codec.decode(wire, fmt, keep=("event_seq",)).select(*WIRE_COLUMNS)


def task_event_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _roundtrip(spark, sf_dir, "json")


def task_event_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _roundtrip(spark, sf_dir, "text")


#: The registered streams get the events as they would arrive: up to a slice
#: late, one slice after the other; rows of one slice span two of them.
SLICE_DAYS = 3
DELAY = f"{2 * SLICE_DAYS} days"
#: Events of the whole table for one bucket of keys (some three slices of them wait at once).
BUCKET_ROWS = 40_000
#: Ends a bounded stream: rows whose time no event reaches move the watermark
#: past all events; they themselves stay behind it and give no output.
FLUSH_TIME = "2200-01-01 00:00:00"


class Arrivals:
    """The ``events`` table dealt into slices by time of arrival, which lies up
    to one slice behind the event's own (by a hash of its id); ``feed`` appends
    slices to the folder that a stream reads, oldest first."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        base = checkpoint_path(spark, f"driver-arrivals-{uuid.uuid4().hex}")
        self.staged = f"{base}/staged"
        ev = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
        span = SLICE_DAYS * 86_400_000_000
        behind = F.pmod(F.xxhash64("event_id"), F.lit(span))
        at = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts"))
        ev.withColumn("_slice", F.floor((at + behind) / span)).write.partitionBy("_slice").parquet(self.staged)
        dealt = spark.read.parquet(self.staged)
        self.slices = sorted(r[0] for r in dealt.select("_slice").distinct().collect())  # one per SLICE_DAYS
        self.files = max(1, -(-len(dealt.inputFiles()) // max(1, len(self.slices))))
        self.buckets = max(32, -(-dealt.count() // BUCKET_ROWS))

    def feed(self, folder: str, slices: list[int], flush: bool) -> None:
        for i in slices:
            rows = self.spark.read.schema(S.EVENTS_SCHEMA).parquet(f"{self.staged}/_slice={i}")
            rows.write.mode("append").parquet(folder)
        if flush:
            last = self.spark.range(1).select(F.explode(F.array(*map(F.lit, DRIVER_EVENT_CODES))).alias("event_type"))
            last = last.select(F.lit(-1).cast("long").alias("event_id"), F.lit(FLUSH_TIME).cast("timestamp_ntz").alias("ts"),
                               F.lit(-1).cast("long").alias("user_id"), "event_type", F.lit(1.0).alias("value"),
                               F.lit("").alias("props"))
            last.coalesce(1).write.mode("append").parquet(folder)


def _run_stream(spark: SparkSession, build: Callable[[DataFrame, int], DataFrame], folder: str, arrivals: Arrivals,
                base: str) -> T.StructType:
    """Runs the stream over what ``folder`` holds, from where the checkpoint
    under ``base`` ended, waits for its end and returns its schema."""
    # a session of its own: the number of state partitions (the cluster's
    # cores, fixed in the checkpoint at the first batch) is no one else's setting
    own = spark.newSession()
    key = "spark.sql.shuffle.partitions"
    own.conf.set(key, str(min(int(spark.conf.get(key)), spark.sparkContext.defaultParallelism)))
    out = build(S.read_events_stream(own, folder, arrivals.files), arrivals.buckets)
    q = (out.writeStream.format("parquet").option("path", f"{base}/out")
         .option("checkpointLocation", f"{base}/ck").outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return out.schema


def _streamed(spark: SparkSession, sf_dir: str, build: Callable[[DataFrame, int], DataFrame], stops: int = 0) -> DataFrame:
    """The output of a streaming job over the whole table in slices of
    arrival, read back from the shared checkpoint folder.  ``stops``: how often the job
    is stopped on the way and restarted from its checkpoint."""
    arrivals = Arrivals(spark, sf_dir)
    base = checkpoint_path(spark, f"driver-stream-{uuid.uuid4().hex}")
    n = len(arrivals.slices)
    cuts = [n * k // (stops + 1) for k in range(stops + 2)]
    for k in range(stops + 1):
        arrivals.feed(f"{base}/feed", arrivals.slices[cuts[k]:cuts[k + 1]], flush=k == stops)
        schema = _run_stream(spark, build, f"{base}/feed", arrivals, base)
    return spark.read.schema(schema).parquet(f"{base}/out")


def _task_stream(ev: DataFrame) -> DataFrame:
    return S.with_watermark(task_events_from_events(ev.sparkSession, ev), DELAY)


def _job_stream(ev: DataFrame) -> DataFrame:
    return S.with_watermark(job_events_from_events(ev.sparkSession, ev), DELAY)


def job_event_count_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed(spark, sf_dir, lambda ev, n: S.job_event_count_stream(_job_stream(ev), buckets=n))


def job_scheduling_latency_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed(spark, sf_dir, lambda ev, n: S.job_scheduling_latency_stream(_job_stream(ev), buckets=n))


def max_task_completion_running_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed(spark, sf_dir, lambda ev, n: S.max_task_completion_stream(_task_stream(ev), buckets=n))


def rule_anomaly_repeat_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stopped twice on the way, with rows waiting in state, and
    restarted from its checkpoint."""
    def build(ev, n):
        r = S.rule_anomaly_stream(_task_stream(ev), **RULE, buckets=n)
        return r.select("job_id", "task_index",
                        *[F.col(f"{s}.{c}").alias(f"{s}_{c.replace('event_', '')}")
                          for s in ("first", "second", "third") for c in ("timestamp", "event_seq")])

    return _streamed(spark, sf_dir, build, stops=2)


def task_statistics_per_machine_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed(spark, sf_dir, lambda ev, _: S.task_statistics_stream(_task_stream(ev), "1 day", "machine_id"))


def busy_machines_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed(spark, sf_dir, lambda ev, _: S.busy_machines_stream(_task_stream(ev), "3 days", "1 day", 10))


def invariant_anomaly_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed(spark, sf_dir, lambda ev, n: S.invariant_anomaly_stream(_task_stream(ev), TRAINING_END, n))


def time_series_anomaly_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build(ev, _):
        r = S.time_series_anomaly_stream(_task_stream(ev), "3 days", "1 day", 3, 0.3)
        return r.select("machine_id", "window_end", F.round("current_avg", 6).alias("current_avg"),
                        F.round("moving_avg", 6).alias("moving_avg"))

    return _streamed(spark, sf_dir, build)


def job_scheduling_latency_directed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.job_scheduling_latency(job_events(spark, sf_dir, types=(SUBMIT, SCHEDULE)),
                                        directed=True)


def task_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.job_sessions(task_events(spark, sf_dir, types=(SUBMIT,)), gap="3 days")


def cpu_window_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = anomaly.window_means(task_events(spark, sf_dir, types=(SCHEDULE,)), "3 days", "1 day")
    return m.select("machine_id", "window_end", F.round("current_avg", 6).alias("current_avg"))


def _spoilt(value: F.Column) -> F.Column:
    """Some values made bad by event id: cut short, or with a letter before
    every number of the record's beginning."""
    n = F.col("event_seq")
    return (F.when(n % 7 == 0, F.substring_index(value, ",", 5))
            .when(n % 11 == 0, F.concat(F.lit("x"), value)).otherwise(value).alias("value"))


def dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good and bad trace lines of tasks and jobs and wire
    values of tasks, each read once and split into accepted rows and rejects."""
    from ..sources import trace_files

    tasks, jobs = task_events(spark, sf_dir), job_events(spark, sf_dir)
    line = F.concat_ws(",", "timestamp", F.lit(""), "job_id", "task_index", "machine_id", "event_type", F.lit("u"),
                       "scheduling_class", "priority", "max_cpu")
    job_line = F.concat_ws(",", "timestamp", F.lit(""), "job_id", "event_type", F.lit("u"), "scheduling_class",
                           F.lit("name"), F.lit("logical"))
    keep = ("event_seq",)
    parsed = {
        "task_line": trace_files.parse_task_lines(tasks.select("event_seq", _spoilt(line)), keep=keep),
        "job_line": trace_files.parse_job_lines(jobs.select("event_seq", _spoilt(job_line)), keep=keep),
        "json": codec.decode(tasks.select("event_seq", _spoilt(codec.to_json_value(tasks))), "json", keep=keep,
                             mode="PERMISSIVE"),
        "text": codec.decode(tasks.select("event_seq", _spoilt(codec.to_text_value(tasks))), "text", keep=keep,
                             mode="PERMISSIVE"),
    }
    base = checkpoint_path(spark, f"driver-dead-letters-{uuid.uuid4().hex}")
    out = None
    for name, rows in parsed.items():
        good, rejects, counts = trace_files.split_rejects(rows, f"{base}/{name}")
        total = F.lit(counts["rejected"]).cast("long").alias("all_rejected")
        for part, accepted in ((good, True), (rejects, False)):
            part = part.select(F.lit(name).alias("source"), "event_seq", F.lit(accepted).alias("accepted"),
                               *[(F.col(c) if accepted else F.lit(None)).cast("long").alias(c)
                                 for c in ("timestamp", "job_id", "event_type")], total)
            out = part if out is None else out.unionByName(part)
    return out


def task_statistics_from_trace_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table written out as gzipped trace lines (one folder under the
    shared checkpoint dir), read back through the trace-file reader (S1-S3),
    then J6."""
    from ..sources import trace_files

    folder = checkpoint_path(spark, f"driver-trace-{uuid.uuid4().hex}")
    trace_files.write_task_events(task_events(spark, sf_dir), folder)
    tasks = trace_files.read_task_events(spark, folder, mode="FAILFAST")
    return windows.task_statistics(tasks, window="1 day", by="machine_id")


QUERIES: dict[str, Query] = {
    "task_statistics_per_machine": task_statistics_per_machine,
    "task_statistics_global": task_statistics_global,
    "filter_task_events": filter_task_events,
    "busy_machines": busy_machines,
    "busy_machines_hourly": busy_machines_hourly,
    "job_event_count": job_event_count,
    "job_scheduling_latency": job_scheduling_latency,
    "job_scheduling_latency_first": job_scheduling_latency_first,
    "max_task_completion": max_task_completion,
    "max_task_completion_running": max_task_completion_running,
    "longest_session_per_job": longest_session_per_job,
    "longest_session_bounds": longest_session_bounds,
    "rule_anomaly_single": rule_anomaly_single,
    "rule_anomaly_repeat": rule_anomaly_repeat,
    "invariant_anomaly": invariant_anomaly,
    "time_series_anomaly": time_series_anomaly,
    "task_event_json": task_event_json,
    "task_event_text": task_event_text,
    "job_scheduling_latency_directed": job_scheduling_latency_directed,
    "task_sessions": task_sessions,
    "cpu_window_means": cpu_window_means,
    "task_statistics_from_trace_files": task_statistics_from_trace_files,
    "dead_letters": dead_letters,
    "job_event_count_stream": job_event_count_stream,
    "job_scheduling_latency_stream": job_scheduling_latency_stream,
    "max_task_completion_running_stream": max_task_completion_running_stream,
    "rule_anomaly_repeat_stream": rule_anomaly_repeat_stream,
    "task_statistics_per_machine_stream": task_statistics_per_machine_stream,
    "busy_machines_stream": busy_machines_stream,
    "invariant_anomaly_stream": invariant_anomaly_stream,
    "time_series_anomaly_stream": time_series_anomaly_stream,
}
