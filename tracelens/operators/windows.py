"""Window statistics: J5 / J6 (task statistics) and J7 (busy machines).

Windows are Spark's own ``window()`` on ``event_time``: half open, aligned
to the epoch, empty windows give no row.  Counting is a declarative
aggregate, so Spark combines map-side before the shuffle; a machine or a
window that holds a large share of the rows costs one partial row per map
task, not a hot reducer.  Window bounds come out as BIGINT microseconds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.time import interval_micros, interval_string
from ..schema import EVENT_TIME, FAIL, FINISH, KILL, SCHEDULE, ensure_event_time
from .filters import keep_types


def task_statistics(tasks: DataFrame, window: str = "1 minute",
                    by: str | list[str] | None = None) -> DataFrame:
    """J5 (global) and J6 (``by="machine_id"``).

    Output: window_start, [by...], finished, failed, killed.  After the
    FAIL/FINISH/KILL filter every row that is neither FINISH nor FAIL counts
    as killed.
    """
    keys = [] if by is None else ([by] if isinstance(by, str) else list(by))
    t = keep_types(ensure_event_time(tasks), FAIL, FINISH, KILL)
    et = F.col("event_type")
    out = (t.groupBy(F.window(EVENT_TIME, window).alias("w"), *keys)
           .agg(F.count_if(et == FINISH).alias("finished"),
                F.count_if(et == FAIL).alias("failed"),
                F.count_if((et != FINISH) & (et != FAIL)).alias("killed")))
    return out.select(F.unix_micros(F.col("w.start")).alias("window_start"), *keys,
                      "finished", "failed", "killed")


# Above this many windows per event, aggregate per pane first.
PANE_RATIO = 4


def _floor_to(x, m: int):
    return x - F.pmod(x, F.lit(m))


def sliding_sums(df: DataFrame, keys, length, slide, value: str | None = None,
                 panes: str | bool = "auto") -> DataFrame:
    """Count (and sum of ``value``) per key and sliding window, aligned to
    the epoch like ``F.window``; windows without events give no row.

    Output: keys, window_start, window_end (microseconds), n [, total].

    ``F.window`` with a slide expands every row into length/slide copies
    before the partial aggregation.  With ``panes`` (default when that ratio
    exceeds PANE_RATIO) rows are first counted per pane of
    gcd(length, slide) and only the aggregated panes are spread over the
    windows that contain them -- exact for counts and sums.
    """
    import math

    keys = [keys] if isinstance(keys, str) else list(keys)
    length_us, slide_us = interval_micros(length), interval_micros(slide)
    use_panes = panes if isinstance(panes, bool) else length_us > PANE_RATIO * slide_us
    aggs = [F.count(F.lit(1)).alias("n")]
    if value:
        aggs.append(F.sum(value).alias("total"))
    if not use_panes:
        t = ensure_event_time(df)
        w = F.window(EVENT_TIME, interval_string(length_us), interval_string(slide_us)).alias("w")
        out = t.groupBy(*keys, w).agg(*aggs)
        return out.select(*keys, F.unix_micros(F.col("w.start")).alias("window_start"),
                          F.unix_micros(F.col("w.end")).alias("window_end"), *[a for a in ("n", "total")
                                                                                if a in out.columns])
    g = math.gcd(length_us, slide_us)
    pane = _floor_to(F.col("timestamp"), g).alias("_pane")
    pane_aggs = [F.count(F.lit(1)).alias("_pn")] + ([F.sum(value).alias("_ps")] if value else [])
    p = df.groupBy(*keys, pane).agg(*pane_aggs)
    # windows [s, s + length) with s a multiple of slide and s <= pane <= s + length - g
    first = -_floor_to(-(F.col("_pane") + F.lit(g - length_us)), slide_us)
    last = _floor_to(F.col("_pane"), slide_us)
    p = p.withColumn("window_start", F.explode(F.sequence(first, last, F.lit(slide_us))))
    out_aggs = [F.sum("_pn").alias("n")] + ([F.sum("_ps").alias("total")] if value else [])
    out = p.groupBy(*keys, "window_start").agg(*out_aggs)
    return out.select(*keys, "window_start", (F.col("window_start") + F.lit(length_us)).alias("window_end"),
                      *(["n", "total"] if value else ["n"]))


def busy_machines(tasks: DataFrame, length: str = "15 minutes", slide: str = "5 minutes",
                  threshold: int = 15, panes: str | bool = "auto") -> DataFrame:
    """Per sliding window, the number of machines with at least
    ``threshold`` SCHEDULE events.  Windows without a busy machine give no row.

    Output: window_end, busy_machines.
    """
    t = keep_types(tasks, SCHEDULE)
    per_machine = sliding_sums(t, "machine_id", length, slide, panes=panes)
    busy = per_machine.where(F.col("n") >= threshold)
    return busy.groupBy("window_end").agg(F.count(F.lit(1)).alias("busy_machines"))
