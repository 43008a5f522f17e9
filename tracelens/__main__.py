"""Command line: run a batch job over trace files.

    python -m tracelens task-statistics --tasks DIR [--window "1 minute"] [--by machine_id]
    python -m tracelens busy-machines --tasks DIR [--length ...] [--slide ...] [--threshold 15]
    python -m tracelens longest-session --tasks DIR --jobs DIR [--gap "10 minutes"]
    python -m tracelens job-event-count --jobs DIR
    python -m tracelens scheduling-latency --jobs DIR [--repeat latest|first]
    python -m tracelens max-task-completion --tasks DIR [--running]
    python -m tracelens filter-tasks --tasks DIR [--types 0,4]
    python -m tracelens rule-anomaly --tasks DIR --e1 0 --e2 1 --e3 5 --limit "10 seconds" [--epoch single|repeat]
    python -m tracelens invariant-anomaly --tasks DIR --training-end 2024-01-15
    python -m tracelens time-series-anomaly --tasks DIR [--length ...] [--slide ...] [--windows 3] [--diff 0.3]

Results are printed (``--show N`` rows, the console sink) or written as
Parquet with ``--out PATH``.  Uses the active Spark configuration
(``spark-submit`` / ``SPARK_HOME``); ``--local N`` starts a local session.
"""

from __future__ import annotations

import argparse
import sys


JOBS = ("task-statistics", "busy-machines", "longest-session", "job-event-count",
        "scheduling-latency", "max-task-completion", "filter-tasks", "rule-anomaly",
        "invariant-anomaly", "time-series-anomaly")


def _args(argv):
    p = argparse.ArgumentParser(prog="python -m tracelens")
    p.add_argument("job", choices=JOBS)
    p.add_argument("--tasks")
    p.add_argument("--jobs")
    p.add_argument("--out")
    p.add_argument("--show", type=int, default=20)
    p.add_argument("--local", type=int, default=0)
    p.add_argument("--mode", default="FAILFAST")
    p.add_argument("--window", default="1 minute")
    p.add_argument("--by")
    p.add_argument("--length")
    p.add_argument("--slide")
    p.add_argument("--threshold", type=int, default=15)
    p.add_argument("--gap", default="10 minutes")
    p.add_argument("--repeat", default="latest")
    p.add_argument("--running", action="store_true")
    p.add_argument("--types", default="0,4")
    p.add_argument("--e1", type=int, default=0)
    p.add_argument("--e2", type=int, default=1)
    p.add_argument("--e3", type=int, default=5)
    p.add_argument("--limit", default="10 seconds")
    p.add_argument("--epoch", default="single")
    p.add_argument("--training-end")
    p.add_argument("--windows", type=int, default=3)
    p.add_argument("--diff", type=float, default=0.3)
    return p.parse_args(argv)


def run(argv=None) -> int:
    a = _args(sys.argv[1:] if argv is None else argv)
    from pyspark.sql import SparkSession

    from .operators import anomaly, filters, pairs, patterns, rolling, sessions, windows
    from .sources.trace_files import read_job_events, read_task_events

    if a.local:
        from .session import local_session

        spark = local_session(cores=a.local, shuffle_partitions=a.local)
    else:
        spark = SparkSession.builder.appName(f"tracelens {a.job}").getOrCreate()

    def tasks():
        if not a.tasks:
            raise SystemExit("--tasks is required for this job")
        return read_task_events(spark, a.tasks, mode=a.mode)

    def jobs():
        if not a.jobs:
            raise SystemExit("--jobs is required for this job")
        return read_job_events(spark, a.jobs, mode=a.mode)

    jobs_table = {
        "task-statistics": lambda: windows.task_statistics(tasks(), a.window, by=a.by),
        "busy-machines": lambda: windows.busy_machines(tasks(), a.length or "15 minutes",
                                                       a.slide or "5 minutes", a.threshold),
        "longest-session": lambda: sessions.longest_session_per_job(tasks(), jobs(), a.gap),
        "job-event-count": lambda: rolling.job_event_count(jobs()),
        "scheduling-latency": lambda: pairs.job_scheduling_latency(jobs(), repeat=a.repeat),
        "max-task-completion": lambda: pairs.max_task_completion(tasks(), running=a.running),
        "filter-tasks": lambda: filters.filter_task_events(
            tasks(), tuple(int(x) for x in a.types.split(","))),
        "rule-anomaly": lambda: patterns.rule_anomaly(tasks(), a.e1, a.e2, a.e3, a.limit,
                                                      epoch=a.epoch),
        "invariant-anomaly": lambda: anomaly.invariant_anomaly(tasks(), a.training_end),
        "time-series-anomaly": lambda: anomaly.time_series_anomaly(
            tasks(), a.length or "5 seconds", a.slide or "2 seconds", a.windows, a.diff),
    }
    df = jobs_table[a.job]()
    if a.out:
        df.write.mode("overwrite").parquet(a.out)
    else:
        df.show(a.show, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(run())
