"""The reference's pinned fixtures (FIXTURES.md section 2) as batch tests.
Fixture times are milliseconds; the engine works in microseconds."""

from conftest import make_jobs, make_tasks

from tracelens.operators import anomaly, filters, pairs, patterns, rolling, sessions, windows
from tracelens.schema import FAIL, FINISH, KILL, LOST, SCHEDULE, SUBMIT, UPDATE_PENDING

MS = 1000


def test_job_event_count(spark):
    ev = [(1, 0), (2, 1), (1, 2), (3, 3), (3, 4), (1, 5)]
    jobs = make_jobs(spark, [dict(job=j, ts=t, etype=SUBMIT) for j, t in ev])
    out = rolling.job_event_count(jobs).orderBy("timestamp").collect()
    assert [(r.job_id, r.event_count) for r in out] == [(1, 1), (2, 1), (1, 2), (3, 1), (3, 2), (1, 3)]


def test_job_scheduling_latency(spark):
    ev = [(1, 0, SUBMIT), (2, 1, SUBMIT), (1, 5, SCHEDULE), (3, 6, FAIL), (3, 8, SCHEDULE),
          (1, 15, SUBMIT), (2, 16, SCHEDULE), (4, 17, SUBMIT), (4, 19, LOST), (4, 25, SCHEDULE)]
    jobs = make_jobs(spark, [dict(job=j, ts=t, etype=e) for j, t, e in ev])
    out = pairs.job_scheduling_latency(jobs).orderBy("timestamp").collect()
    assert [(r.job_id, r.latency // MS) for r in out] == [(1, 5), (2, 15), (4, 8)]


def test_max_task_completion_running(spark):
    ev = [(42, 0, 1, SUBMIT, 0), (42, 0, 1, FINISH, 1), (42, 0, 1, SUBMIT, 2), (42, 7, 3, SUBMIT, 3),
          (42, 7, 3, FINISH, 6), (42, 0, 1, FINISH, 12), (42, 1, 1, SUBMIT, 13), (42, 1, 1, FINISH, 33),
          (23, 9, 4, SUBMIT, 35), (23, 9, 4, SUBMIT, 63), (23, 9, 4, FINISH, 75)]
    tasks = make_tasks(spark, [dict(job=j, task=k, priority=p, etype=e, ts=t) for j, k, p, e, t in ev])
    out = pairs.max_task_completion(tasks, running=True).orderBy("timestamp").collect()
    assert [(r.priority, r.max_duration // MS) for r in out] == [(1, 1), (3, 3), (1, 10), (1, 20), (4, 12)]
    final = {r.priority: r.max_duration // MS for r in pairs.max_task_completion(tasks).collect()}
    assert final == {1: 20, 3: 3, 4: 12}


def test_filter_task_events(spark):
    types = [SUBMIT, FAIL, SUBMIT, FAIL, FINISH, FINISH, UPDATE_PENDING, SCHEDULE]
    tasks = make_tasks(spark, [dict(ts=i, etype=e) for i, e in enumerate(types)])
    out = filters.filter_task_events(tasks).orderBy("timestamp").collect()
    assert [r.timestamp // MS for r in out] == [0, 2, 4, 5]


STATS = [(1, FINISH, 10000), (2, FINISH, 11000), (3, FINISH, 23000), (1, FAIL, 40000), (3, FAIL, 58000),
         (3, FAIL, 59000), (4, KILL, 60000), (4, SUBMIT, 65000), (2, SUBMIT, 86000), (2, KILL, 92000),
         (2, KILL, 110000), (1, FAIL, 123000), (5, KILL, 130000), (5, FAIL, 140000), (9, KILL, 170000),
         (1, FINISH, 174000), (99, FINISH, 220000)]


def test_task_statistics_global(spark):
    tasks = make_tasks(spark, [dict(machine=m, etype=e, ts=t) for m, e, t in STATS])
    out = windows.task_statistics(tasks, "1 minute").collect()
    got = sorted((r.window_start // MS, r.finished, r.failed, r.killed) for r in out)
    assert got == [(0, 3, 3, 0), (60000, 0, 0, 3), (120000, 1, 2, 2), (180000, 1, 0, 0)]


def test_task_statistics_per_machine(spark):
    tasks = make_tasks(spark, [dict(machine=m, etype=e, ts=t) for m, e, t in STATS])
    out = windows.task_statistics(tasks, "1 minute", by="machine_id").collect()
    got = sorted((r.window_start // MS, r.machine_id, r.finished, r.failed, r.killed) for r in out)
    assert got == sorted([(0, 1, 1, 1, 0), (0, 2, 1, 0, 0), (0, 3, 1, 2, 0), (60000, 4, 0, 0, 1),
                          (60000, 2, 0, 0, 2), (120000, 1, 1, 1, 0), (120000, 5, 0, 1, 1),
                          (120000, 9, 0, 0, 1), (180000, 99, 1, 0, 0)])


def test_busy_machines(spark):
    sched = {1: [200000, 220000, 240000], 2: [210000, 260000, 320000],
             3: [215000, 265000, 266000, 267000, 268000], 4: [715000, 765000, 866000],
             5: [1115000, 1465000, 1466000]}
    rows = [dict(machine=m, etype=SCHEDULE, ts=t) for m, ts in sched.items() for t in ts]
    rows += [dict(machine=1, etype=SUBMIT, ts=t) for t in (100000, 110000, 130000)]
    rows += [dict(machine=2, etype=SUBMIT, ts=t) for t in (105000, 115000, 135000)]
    tasks = make_tasks(spark, rows)
    out = windows.busy_machines(tasks, "15 minutes", "5 minutes", threshold=3).orderBy("window_end")
    assert [(r.window_end // MS, r.busy_machines) for r in out.collect()] == [
        (300000, 2), (600000, 3), (900000, 4), (1200000, 1), (1500000, 2), (1800000, 1)]


def test_longest_session_per_job(spark):
    submits = {1: [10000, 11000, 23000, 640000, 658000, 659000, 659000, 659000, 1459000, 1459000],
               2: [30000, 42000, 842000], 3: [1200, 13000, 14000, 17000, 17400]}
    rows = [dict(job=j, etype=SUBMIT, ts=t) for j, ts in submits.items() for t in ts]
    rows += [dict(job=2, etype=KILL, ts=9002000), dict(job=2, etype=FINISH, ts=1100000)]
    tasks = make_tasks(spark, rows)
    jobs = make_jobs(spark, [dict(job=1, ts=123, etype=SUBMIT), dict(job=2, ts=4242, etype=SUBMIT),
                             dict(job=3, ts=999, etype=SUBMIT), dict(job=1, ts=1559000, etype=FINISH),
                             dict(job=2, ts=1332000, etype=FINISH), dict(job=3, ts=9000000, etype=FINISH)])
    out = sessions.longest_session_per_job(tasks, jobs, "10 minutes").collect()
    assert sorted((r.job_id, r.session_events) for r in out) == [(1, 5), (2, 2), (3, 5)]
    b = sessions.longest_session_per_job(tasks, jobs, "10 minutes", with_bounds=True).collect()
    assert sorted((r.job_id, r.session_start // MS, r.session_end // MS, r.session_events) for r in b) == [
        (1, 640000, 1259000, 5), (2, 30000, 642000, 2), (3, 1200, 617400, 5)]


def test_longest_session_needs_finish(spark):
    tasks = make_tasks(spark, [dict(job=7, etype=SUBMIT, ts=0)])
    jobs = make_jobs(spark, [dict(job=7, ts=0, etype=SUBMIT)])
    assert sessions.longest_session_per_job(tasks, jobs, "10 minutes").count() == 0


def test_session_gap_tie(spark):
    tasks = make_tasks(spark, [dict(job=1, etype=SUBMIT, ts=t * 1000) for t in (0, 600, 1201)])
    for fn in (sessions.job_sessions, sessions.job_sessions_windowed):
        out = fn(tasks, "10 minutes").orderBy("session_start").collect()
        assert [(r.session_start // MS, r.session_end // MS, r.session_events) for r in out] == [
            (0, 1200000, 2), (1201000, 1801000, 1)]


def test_rule_anomaly(spark):
    ev = [(1, SUBMIT, 5000), (2, SUBMIT, 7000), (3, SUBMIT, 8000), (2, SCHEDULE, 9000),
          (1, SCHEDULE, 10000), (2, KILL, 12000), (3, SCHEDULE, 13000), (1, FINISH, 14000),
          (1, KILL, 17000)]
    tasks = make_tasks(spark, [dict(job=j, task=j, etype=e, ts=t) for j, e, t in ev])
    out = patterns.rule_anomaly(tasks, 0, 1, 5, 10000 * MS).collect()
    assert len(out) == 1
    r = out[0]
    assert r.job_id == 2
    assert (r.first.timestamp // MS, r.second.timestamp // MS, r.third.timestamp // MS) == (7000, 9000, 12000)


def test_rule_anomaly_equal_types_give_nothing(spark):
    tasks = make_tasks(spark, [dict(job=1, etype=SUBMIT, ts=1), dict(job=1, etype=SUBMIT, ts=2)])
    assert patterns.rule_anomaly(tasks, 0, 0, 0, 10 * MS).count() == 0


def test_time_series_anomaly(spark):
    ev = [(5.0, 1000), (2.0, 3000), (8.0, 4900), (12.0, 8900), (1.0, 12900)]
    tasks = make_tasks(spark, [dict(machine=1, etype=SCHEDULE, max_cpu=c, ts=t) for c, t in ev])
    out = anomaly.time_series_anomaly(tasks, "5 seconds", "2 seconds", 3, 0.3).orderBy("window_end")
    got = [(r.machine_id, round(r.current_avg, 2), round(r.moving_avg, 2)) for r in out.collect()]
    assert got == [(1, 10.0, 6.67), (1, 6.5, 9.5), (1, 1.0, 6.5), (1, 1.0, 2.83)]


def test_invariant_anomaly(spark):
    submit = [(1, 3000), (2, 5000), (3, 11000), (4, 12000), (5, 21000), (6, 23000), (7, 30000), (8, 37000)]
    sched = [(2, 7000), (1, 9000), (4, 15000), (3, 19000), (6, 27000), (5, 28000), (7, 35000), (8, 38000)]
    rows = [dict(job=j, task=j, priority=1, etype=SUBMIT, ts=t) for j, t in submit]
    rows += [dict(job=j, task=j, priority=1, etype=SCHEDULE, ts=t) for j, t in sched]
    tasks = make_tasks(spark, rows)
    out = anomaly.invariant_anomaly(tasks, 10000 * MS).orderBy("timestamp").collect()
    assert [(r.priority, r.duration // MS) for r in out] == [(1, 8000), (1, 7000), (1, 1000)]


def test_pane_and_expand_sliding_windows_agree(spark):
    import random

    rnd = random.Random(5)
    rows = [dict(machine=rnd.randrange(6), etype=SCHEDULE, ts=rnd.randrange(0, 3_600_000),
                 max_cpu=rnd.random()) for _ in range(800)]
    tasks = make_tasks(spark, rows)
    for length, slide in (("15 minutes", "1 minute"), ("10 minutes", "4 minutes"), ("7 minutes", "7 minutes")):
        a = windows.sliding_sums(tasks, "machine_id", length, slide, value="max_cpu", panes=True)
        b = windows.sliding_sums(tasks, "machine_id", length, slide, value="max_cpu", panes=False)
        norm = lambda df: sorted((r.machine_id, r.window_start, r.window_end, r.n, round(r.total, 9))
                                 for r in df.collect())
        assert norm(a) == norm(b) and len(norm(a)) > 10, (length, slide)
    x = windows.busy_machines(tasks, "15 minutes", "1 minute", threshold=10, panes=True)
    y = windows.busy_machines(tasks, "15 minutes", "1 minute", threshold=10, panes=False)
    assert sorted(tuple(r) for r in x.collect()) == sorted(tuple(r) for r in y.collect())
