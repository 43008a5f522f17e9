"""The longest task session of every finished job.

A session is a maximal run of a job's SUBMIT task events in which each
event follows the previous one by at most ``gap`` (an event exactly one gap
later joins the session, like Spark's ``session_window``).  "Longest" means
most events.  Only jobs with a FINISH job event give a row; the finished-job
side is a semi join, so no job-event column is carried.

Sessions are numbered with a gap flag and a running sum per (job, chunk),
so a job with a large share of the events is split over many tasks
(``skew.add_chunks``); chunk borders are stitched by a prefix over a
one-row-per-hot-chunk summary, and the events per session are counted with
map-side partial aggregation.  ``job_sessions_windowed`` is the same result
through Spark's ``session_window``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.time import interval_micros
from ..schema import EVENT_TIME, FINISH, SUBMIT, ensure_event_time, ensure_seq
from .filters import keep_types
from .skew import CHUNK, add_chunks


def job_sessions(tasks: DataFrame, gap: str = "10 minutes", **split) -> DataFrame:
    """Sessions of SUBMIT task events per job (the bounds Spark's
    ``session_window`` gives: start = first event, end = last event + gap).

    Output: job_id, session_start, session_end (BIGINT microseconds),
    session_events.  Numbered by ``session_ids`` (hot jobs split), then one
    aggregation per (job, session) with map-side partial aggregation.
    """
    g = interval_micros(gap)
    t = ensure_seq(keep_types(tasks, SUBMIT)).select("job_id", "timestamp", "event_seq")
    ids = session_ids(t, ["job_id"], g, **split)
    return (ids.groupBy("job_id", "_sid")
            .agg(F.min("timestamp").alias("session_start"),
                 (F.max("timestamp") + F.lit(g)).alias("session_end"),
                 F.count(F.lit(1)).alias("session_events"))
            .drop("_sid"))


def job_sessions_windowed(tasks: DataFrame, gap: str = "10 minutes") -> DataFrame:
    """The same sessions through Spark's ``session_window`` (the form the
    streaming job uses); a job's events are merged in one task."""
    t = keep_types(ensure_event_time(tasks), SUBMIT)
    s = (t.groupBy("job_id", F.session_window(EVENT_TIME, gap).alias("s"))
         .agg(F.count(F.lit(1)).alias("session_events")))
    return s.select("job_id",
                    F.unix_micros(F.col("s.start")).alias("session_start"),
                    F.unix_micros(F.col("s.end")).alias("session_end"),
                    "session_events")


def session_ids(df: DataFrame, keys, gap_us: int, **split) -> DataFrame:
    """Add ``_sid``: the number of the event's session within its key
    (1, 2, ... in time order).  ``split``: arguments of ``add_chunks``."""
    keys = list(keys)
    d, hot = add_chunks(df, keys, **split)
    w = Window.partitionBy(*keys, CHUNK).orderBy("timestamp", "event_seq")
    d = d.withColumn("_pts", F.lag("timestamp").over(w))
    new = F.col("_pts").isNull() | (F.col("timestamp") - F.col("_pts") > F.lit(gap_us))
    d = d.withColumn("_lsid", F.sum(new.cast("long")).over(
        w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    if not hot:
        return d.withColumn("_sid", F.col("_lsid")).drop("_pts", "_lsid", CHUNK)
    summ = (d.where(F.col(CHUNK) > 0).groupBy(*keys, CHUNK)
            .agg(F.min("timestamp").alias("_first"), F.max("timestamp").alias("_last"),
                 F.max("_lsid").alias("_n")))
    cw = Window.partitionBy(*keys).orderBy(CHUNK)
    summ = summ.withColumn("_cont", F.coalesce(
        F.col("_first") - F.lag("_last").over(cw) <= F.lit(gap_us), F.lit(False)))
    summ = summ.withColumn("_inc", F.col("_n") - F.col("_cont").cast("long"))
    summ = summ.withColumn("_end", F.sum("_inc").over(
        cw.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    summ = summ.select(*keys, CHUNK, (F.col("_end") - F.col("_n")).alias("_off"))
    # one row per hot chunk: bounded by the chunk budget
    d = d.join(F.broadcast(summ), keys + [CHUNK], "left")
    return (d.withColumn("_sid", F.col("_lsid") + F.coalesce(F.col("_off"), F.lit(0)))
            .drop("_pts", "_lsid", "_off", CHUNK))


def longest_session_per_job(tasks: DataFrame, jobs: DataFrame,
                            gap: str = "10 minutes", with_bounds: bool = False,
                            **split) -> DataFrame:
    """(job_id, session_events) of the session with most events, for
    every job that has a FINISH event and at least one SUBMIT session.
    ``with_bounds``: also session_start / session_end of that session (the
    earliest one when several have the most events -- the first maximum)."""
    finished = keep_types(jobs, FINISH).select("job_id")
    if with_bounds:
        s = job_sessions(tasks, gap, **split)
        best = s.groupBy("job_id").agg(F.max_by(
            F.struct("session_start", "session_end", "session_events"),
            F.struct(F.col("session_events"), -F.col("session_start"))).alias("b"))
        return best.join(finished, "job_id", "left_semi").select("job_id", "b.*")
    t = ensure_seq(keep_types(tasks, SUBMIT)).select("job_id", "timestamp", "event_seq")
    ids = session_ids(t, ["job_id"], interval_micros(gap), **split)
    per_session = ids.groupBy("job_id", "_sid").agg(F.count(F.lit(1)).alias("n"))
    longest = per_session.groupBy("job_id").agg(F.max("n").alias("session_events"))
    return longest.join(finished, "job_id", "left_semi")
