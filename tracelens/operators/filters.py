"""Event-type filters.

Plain predicates on ``event_type``; Catalyst pushes them into the Parquet
scan (they show up under ``PushedFilters``) and prunes unused columns.
A NULL type (unknown code) never matches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import FAIL, FINISH, KILL, SCHEDULE, SUBMIT


def keep_types(df: DataFrame, *types: int, col: str = "event_type") -> DataFrame:
    """Keep rows whose event type is one of ``types``."""
    if not types:
        raise ValueError("keep_types needs at least one event type")
    if len(types) == 1:
        return df.where(F.col(col) == F.lit(types[0]))
    return df.where(F.col(col).isin(*types))


def filter_task_events(tasks: DataFrame, types=(SUBMIT, FINISH)) -> DataFrame:
    """Task events of the given types (default SUBMIT or FINISH)."""
    return keep_types(tasks, *types)


def submit_or_schedule(df: DataFrame) -> DataFrame:
    """P2 / P7."""
    return keep_types(df, SUBMIT, SCHEDULE)


def terminal_types(df: DataFrame) -> DataFrame:
    """FAIL, FINISH, KILL."""
    return keep_types(df, FAIL, FINISH, KILL)


def schedule_with_cpu(df: DataFrame) -> DataFrame:
    """SCHEDULE events with a positive CPU limit."""
    return keep_types(df, SCHEDULE).where(F.col("max_cpu") > 0)
