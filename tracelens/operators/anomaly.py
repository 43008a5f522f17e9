"""Anomaly detectors J11 (invariant bounds) and J12 (moving average).

J11 trains per-priority duration bounds on the pairs that close at or
before ``training_end`` and reports later pairs outside them.  Because the
pair matcher is causal, the training pairs depend only on events up to
``training_end``: the training pass reads just that time range (the filter
reaches the Parquet scan).  The bounds have one row per priority; they are
collected behind a row-count check and joined by broadcast, and beyond the
check the join is a plain shuffle join.

J12 averages the CPU limit of SCHEDULE events per machine and sliding
window, then compares each window's mean with the mean of the last
``windows`` consecutive windows.  The second step runs on the aggregated
windows (rows per machine grow with the time span, not with the data).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.time import instant_micros, interval_micros
from ..schema import SCHEDULE, SUBMIT
from .filters import keep_types, schedule_with_cpu
from .pairs import pair_events
from .skew import plan_chunks
from .windows import sliding_sums

# Largest bounds table that is broadcast; above it the join shuffles.
MAX_BROADCAST_BOUNDS = 100_000


def _small_or_none(df: DataFrame, max_rows: int):
    rows = df.limit(max_rows + 1).collect()
    return None if len(rows) > max_rows else rows


def duration_bounds(pairs: DataFrame, by: str = "priority") -> DataFrame:
    return pairs.groupBy(by).agg(F.min("duration").alias("min_duration"),
                                 F.max("duration").alias("max_duration"))


def invariant_anomaly(tasks: DataFrame, training_end, keys: Sequence[str] = ("job_id", "task_index"),
                      type_a: int = SUBMIT, type_b: int = SCHEDULE,
                      max_broadcast: int = MAX_BROADCAST_BOUNDS,
                      training_tasks: DataFrame | None = None, **split) -> DataFrame:
    """J11.  Output: priority, job_id, task_index, timestamp, event_seq,
    duration -- one row per detection-period pair outside its priority's
    training bounds.  Priorities without training pairs give no row.

    ``training_tasks`` may name a source already cut at ``training_end``
    (e.g. a scan with the time bound pushed down); by default ``tasks`` is
    filtered."""
    end = instant_micros(training_end)
    keys = list(keys)
    source = tasks if training_tasks is None else training_tasks
    # one hot-key plan for both passes (training is a time slice of the same keys)
    plan = plan_chunks(keep_types(tasks, type_a, type_b), keys, **split)
    train = pair_events(source.where(F.col("timestamp") <= F.lit(end)), keys, type_a, type_b,
                        carry=["priority"], chunk_plan=plan)
    bounds = duration_bounds(train)
    detect = (pair_events(tasks, keys, type_a, type_b, carry=["priority"], chunk_plan=plan)
              .where(F.col("timestamp") > F.lit(end)))
    rows = _small_or_none(bounds, max_broadcast)
    if rows is not None:
        spark = tasks.sparkSession
        bounds = F.broadcast(spark.createDataFrame(rows, bounds.schema))
    j = detect.join(bounds, "priority")
    d = F.col("duration")
    return (j.where((d > F.col("max_duration")) | (d < F.col("min_duration")))
            .select("priority", *keys, "timestamp", "event_seq", "duration"))


def window_means(tasks: DataFrame, length: str, slide: str, by: str = "machine_id",
                 panes: str | bool = "auto") -> DataFrame:
    """Mean CPU limit of SCHEDULE events (with a positive limit) per key and
    sliding window.  Output: by, window_end (microseconds), current_avg.
    (Pane-based for large length/slide ratios, see ``windows.sliding_sums``.)"""
    s = sliding_sums(schedule_with_cpu(tasks), by, length, slide, value="max_cpu", panes=panes)
    return s.select(by, "window_end", (F.col("total") / F.col("n")).alias("current_avg"))


def time_series_anomaly(tasks: DataFrame, length="5 seconds", slide="2 seconds",
                        windows: int = 3, diff: float = 0.3,
                        by: str = "machine_id", panes: str | bool = "auto") -> DataFrame:
    """J12.  A window is reported when it and the ``windows - 1`` windows
    before it (one slide apart each) all exist and
    ``2 * |cur - mov| / (cur + mov) > diff``, where ``mov`` is the mean of
    the ``windows`` window means.

    Output: by, window_end, current_avg, moving_avg.
    """
    if windows < 1:
        raise ValueError("windows must be >= 1")
    step = interval_micros(slide)
    a = window_means(tasks, length, slide, by, panes)
    w = Window.partitionBy(by).orderBy("window_end")
    frame = w.rowsBetween(-(windows - 1), Window.currentRow)
    m = a.select(by, "window_end", "current_avg",
                 F.avg("current_avg").over(frame).alias("moving_avg"),
                 F.lag("window_end", windows - 1).over(w).alias("_first_end"))
    if windows > 1:
        m = m.where(F.col("_first_end") == F.col("window_end") - F.lit((windows - 1) * step))
    cur, mov = F.col("current_avg"), F.col("moving_avg")
    return (m.where(F.lit(2.0) * F.abs(cur - mov) / (cur + mov) > F.lit(diff))
            .select(by, "window_end", "current_avg", "moving_avg"))
