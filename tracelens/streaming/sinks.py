"""S10-S12 and friends: starting a streaming job on a sink, and reading
what the watermark dropped (W10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

SINKS = ("console", "memory", "noop", "parquet", "json", "kafka")


def start(df: DataFrame, sink: str = "console", checkpoint: str | None = None,
          name: str | None = None, path: str | None = None, mode: str = "append",
          trigger: dict | None = None, **options) -> StreamingQuery:
    """Start ``df`` on a sink: ``console`` (S10), ``memory`` (S11, tests),
    ``noop`` (S12, measurements), ``parquet``/``json`` files, ``kafka``
    (value/key columns, see ``sources.kafka``).  ``checkpoint`` should be a
    folder of the cluster's shared checkpoint dir for anything but tests."""
    if sink not in SINKS:
        raise ValueError(f"sink must be one of {SINKS}")
    w = df.writeStream.format(sink).outputMode(mode)
    if name:
        w = w.queryName(name)
    if path:
        w = w.option("path", path)
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    for k, v in options.items():
        w = w.option(k, v)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


#: By run: last batch counted and late rows up to it.
_LATE: dict[str, tuple[int | None, int]] = {}


def _retained() -> int:
    """Progress reports that a query keeps."""
    spark = SparkSession.getActiveSession()
    return int(spark.conf.get("spark.sql.streaming.numRecentProgressUpdates", "100")) if spark else 100


def late_rows(query: StreamingQuery) -> int:
    """Rows dropped as late by the stateful operators of ``query`` since its
    start (``numRowsDroppedByWatermark``).  A query keeps only its last
    progress reports, so the count is carried on from call to call; call it
    at least once in that many batches.  Fails if reports were lost."""
    run, reports = str(query.runId), query.recentProgress
    last, total = _LATE.get(run, (None, 0))
    # a report without addBatch is of an idle trigger, under the next batch's number
    batches = {int(p["batchId"]): sum(int(s.get("numRowsDroppedByWatermark", 0)) for s in p.get("stateOperators", []))
               for p in reports if "addBatch" in p["durationMs"]}
    new = sorted(b for b in batches if last is None or b > last)
    # a run that goes on from a checkpoint begins with a later batch than 0
    full = len(reports) >= _retained()
    first = last + 1 if last is not None else 0 if full else min(new, default=0)
    if (new and new[0] > first) or (full and not batches and last is None):
        raise RuntimeError(f"late rows are not known: progress reports from batch {first} on were lost")
    if new:
        last, total = new[-1], total + sum(batches[b] for b in new)
        _LATE[run] = (last, total)
    return total
