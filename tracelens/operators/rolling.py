"""Rolling aggregates with one output per input (A1, A2): J1 job event count.

A running frame over (timestamp, event_seq) per key: one exchange on the
key and one sort, then a streaming pass; nothing is buffered per key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..schema import ensure_seq
from .skew import running_count


def job_event_count(jobs: DataFrame, key: str = "job_id", **split) -> DataFrame:
    """Running number of events per job, one row per input event.
    Jobs with very many events are split by time (``skew.running_count``).

    Output: job_id, timestamp, event_seq, event_count.
    """
    jobs = ensure_seq(jobs).select(key, "timestamp", "event_seq")
    return running_count(jobs, [key], "event_count", **split).select(
        key, "timestamp", "event_seq", "event_count")
