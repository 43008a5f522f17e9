"""Streaming forms against the reference fixtures (FIXTURES.md section 2).

Inputs arrive one micro-batch per file; a flush row far in the future that
passes every filter advances the watermark at the end (a bounded stream
has no final infinite watermark), and its own output is removed."""

import tempfile

from streaming_harness import job_record, run, task_record, write_batches

from tracelens.schema import FAIL, FINISH, KILL, LOST, SCHEDULE, SUBMIT
from tracelens.streaming import jobs as S

MS = 1000
FLUSH_JOB = 999_999
FAR = 10**10  # ms
# fixtures that begin at 0 are moved on by 1 ms: Spark's watermark begins at
# the epoch, a row at that very time is late


def _chunks(rows, n):
    return [rows[i:i + n] for i in range(0, len(rows), n)]


def test_job_event_count_stream(spark):
    d = tempfile.mkdtemp(prefix="tl-s-")
    ev = [(1, 0), (2, 1), (1, 2), (3, 3), (3, 4), (1, 5)]
    write_batches(d, _chunks([job_record(j, t + 1, SUBMIT) for j, t in ev], 2) + [[job_record(FLUSH_JOB, FAR, SUBMIT)]],
                  kind="job")
    out = run(spark, S.job_event_count_stream(S.read_job_stream(spark, d, max_files_per_trigger=1)))
    got = sorted((r.timestamp // MS, r.job_id, r.event_count) for r in out)
    assert [(j, c) for _, j, c in got] == [(1, 1), (2, 1), (1, 2), (3, 1), (3, 2), (1, 3)]


def test_job_scheduling_latency_stream(spark):
    d = tempfile.mkdtemp(prefix="tl-s-")
    ev = [(1, 0, SUBMIT), (2, 1, SUBMIT), (1, 5, SCHEDULE), (3, 6, FAIL), (3, 8, SCHEDULE),
          (1, 15, SUBMIT), (2, 16, SCHEDULE), (4, 17, SUBMIT), (4, 19, LOST), (4, 25, SCHEDULE)]
    write_batches(d, _chunks([job_record(j, t + 1, e) for j, t, e in ev], 3) + [[job_record(FLUSH_JOB, FAR, SUBMIT)]],
                  kind="job")
    out = run(spark, S.job_scheduling_latency_stream(S.read_job_stream(spark, d, max_files_per_trigger=1)))
    assert sorted((r.job_id, r.latency // MS) for r in out) == [(1, 5), (2, 15), (4, 8)]


def test_task_durations_stream(spark):
    d = tempfile.mkdtemp(prefix="tl-s-")
    ev = [(42, 0, 1, SUBMIT, 0), (42, 0, 1, FINISH, 1), (42, 0, 1, SUBMIT, 2), (42, 7, 3, SUBMIT, 3),
          (42, 7, 3, FINISH, 6), (42, 0, 1, FINISH, 12), (42, 1, 1, SUBMIT, 13), (42, 1, 1, FINISH, 33),
          (23, 9, 4, SUBMIT, 35), (23, 9, 4, SUBMIT, 63), (23, 9, 4, FINISH, 75)]
    rows = [task_record(job=j, task=k, priority=p, etype=e, ts=t + 1) for j, k, p, e, t in ev]
    write_batches(d, _chunks(rows, 4) + [[task_record(job=FLUSH_JOB, etype=SUBMIT, ts=FAR)]])
    out = run(spark, S.task_duration_stream(S.read_task_stream(spark, d, max_files_per_trigger=1)))
    assert sorted((r.priority, r.duration // MS) for r in out) == [(1, 1), (1, 10), (1, 20), (3, 3), (4, 12)]


STATS = [(1, FINISH, 10000), (2, FINISH, 11000), (3, FINISH, 23000), (1, FAIL, 40000), (3, FAIL, 58000),
         (3, FAIL, 59000), (4, KILL, 60000), (4, SUBMIT, 65000), (2, SUBMIT, 86000), (2, KILL, 92000),
         (2, KILL, 110000), (1, FAIL, 123000), (5, KILL, 130000), (5, FAIL, 140000), (9, KILL, 170000),
         (1, FINISH, 174000), (99, FINISH, 220000)]


def test_task_statistics_stream(spark):
    d = tempfile.mkdtemp(prefix="tl-s-")
    rows = [task_record(machine=m, etype=e, ts=t) for m, e, t in STATS]
    flush = [task_record(machine=FLUSH_JOB, etype=FINISH, ts=FAR)]
    write_batches(d, _chunks(rows, 5) + [flush])
    tasks = S.read_task_stream(spark, d, max_files_per_trigger=1)
    out = run(spark, S.task_statistics_stream(tasks, "1 minute"))
    got = sorted((r.window_start // MS, r.finished, r.failed, r.killed) for r in out
                 if r.window_start < FAR * MS - 60 * 10**6)
    assert got == [(0, 3, 3, 0), (60000, 0, 0, 3), (120000, 1, 2, 2), (180000, 1, 0, 0)]


def test_busy_machines_stream(spark):
    d = tempfile.mkdtemp(prefix="tl-s-")
    sched = {1: [200000, 220000, 240000], 2: [210000, 260000, 320000],
             3: [215000, 265000, 266000, 267000, 268000], 4: [715000, 765000, 866000],
             5: [1115000, 1465000, 1466000]}
    rows = sorted([task_record(machine=m, etype=SCHEDULE, ts=t) for m, ts in sched.items() for t in ts],
                  key=lambda r: r["timestamp"])
    flush = [task_record(machine=FLUSH_JOB, etype=SCHEDULE, ts=FAR)]
    write_batches(d, _chunks(rows, 4) + [flush])
    tasks = S.read_task_stream(spark, d, max_files_per_trigger=1)
    out = run(spark, S.busy_machines_stream(tasks, "15 minutes", "5 minutes", threshold=3))
    assert sorted((r.window_end // MS, r.busy_machines) for r in out) == [
        (300000, 2), (600000, 3), (900000, 4), (1200000, 1), (1500000, 2), (1800000, 1)]


def test_rule_anomaly_stream(spark):
    d = tempfile.mkdtemp(prefix="tl-s-")
    ev = [(1, SUBMIT, 5000), (2, SUBMIT, 7000), (3, SUBMIT, 8000), (2, SCHEDULE, 9000),
          (1, SCHEDULE, 10000), (2, KILL, 12000), (3, SCHEDULE, 13000), (1, FINISH, 14000),
          (1, KILL, 17000)]
    rows = [task_record(job=j, task=j, etype=e, ts=t) for j, e, t in ev]
    flush = [task_record(job=FLUSH_JOB, etype=SUBMIT, ts=FAR)]
    write_batches(d, _chunks(rows, 3) + [flush])
    tasks = S.read_task_stream(spark, d, max_files_per_trigger=1)
    out = run(spark, S.rule_anomaly_stream(tasks, SUBMIT, SCHEDULE, KILL, 10000 * MS))
    got = [(r.job_id, r.first.timestamp // MS, r.second.timestamp // MS, r.third.timestamp // MS) for r in out]
    assert got == [(2, 7000, 9000, 12000)]


def test_time_series_anomaly_stream(spark):
    d = tempfile.mkdtemp(prefix="tl-s-")
    ev = [(5.0, 1000), (2.0, 3000), (8.0, 4900), (12.0, 8900), (1.0, 12900)]
    rows = [task_record(machine=1, etype=SCHEDULE, max_cpu=c, ts=t) for c, t in ev]
    flush = [task_record(machine=FLUSH_JOB, etype=SCHEDULE, max_cpu=1.0, ts=FAR)]
    write_batches(d, _chunks(rows, 2) + [flush])
    tasks = S.read_task_stream(spark, d, max_files_per_trigger=1)
    out = run(spark, S.time_series_anomaly_stream(tasks, "5 seconds", "2 seconds", 3, 0.3))
    got = sorted((r.window_end, r.machine_id, round(r.current_avg, 2), round(r.moving_avg, 2))
                 for r in out if r.machine_id == 1)
    assert [g[1:] for g in got] == [(1, 10.0, 6.67), (1, 6.5, 9.5), (1, 1.0, 6.5), (1, 1.0, 2.83)]


def test_longest_session_stream(spark):
    dt, dj = tempfile.mkdtemp(prefix="tl-s-"), tempfile.mkdtemp(prefix="tl-s-")
    submits = {1: [10000, 11000, 23000, 640000, 658000, 659000, 659000, 659000, 1459000, 1459000],
               2: [30000, 42000, 842000], 3: [1200, 13000, 14000, 17000, 17400]}
    rows = sorted([task_record(job=j, etype=SUBMIT, ts=t) for j, ts in submits.items() for t in ts],
                  key=lambda r: r["timestamp"])
    rows += [task_record(job=2, etype=FINISH, ts=1100000)]
    write_batches(dt, [rows, [task_record(job=FLUSH_JOB, etype=SUBMIT, ts=FAR)]])
    jobs = [job_record(1, 123, SUBMIT), job_record(2, 4242, SUBMIT), job_record(3, 999, SUBMIT),
            job_record(2, 1332000, FINISH), job_record(1, 1559000, FINISH), job_record(3, 9000000, FINISH)]
    write_batches(dj, [jobs, [job_record(FLUSH_JOB, FAR, FINISH)]], kind="job")
    tasks = S.read_task_stream(spark, dt, max_files_per_trigger=1)
    jevents = S.read_job_stream(spark, dj, max_files_per_trigger=1)
    out = run(spark, S.longest_session_stream(tasks, jevents, "10 minutes"))
    assert sorted((r.job_id, r.session_events) for r in out if r.job_id != FLUSH_JOB) == [(1, 5), (2, 2), (3, 5)]


def test_max_task_completion_stream(spark):
    d = tempfile.mkdtemp(prefix="tl-s-")
    ev = [(42, 0, 1, SUBMIT, 0), (42, 0, 1, FINISH, 1), (42, 0, 1, SUBMIT, 2), (42, 7, 3, SUBMIT, 3),
          (42, 7, 3, FINISH, 6), (42, 0, 1, FINISH, 12), (42, 1, 1, SUBMIT, 13), (42, 1, 1, FINISH, 33),
          (23, 9, 4, SUBMIT, 35), (23, 9, 4, SUBMIT, 63), (23, 9, 4, FINISH, 75)]
    rows = [task_record(job=j, task=k, priority=p, etype=e, ts=t + 1) for j, k, p, e, t in ev]
    write_batches(d, _chunks(rows, 3) + [[task_record(job=FLUSH_JOB, etype=SUBMIT, ts=FAR)]])
    out = run(spark, S.max_task_completion_stream(S.read_task_stream(spark, d, max_files_per_trigger=1)))
    got = sorted((r.timestamp, r.priority, r.max_duration // MS) for r in out)
    assert [(p, m) for _, p, m in got] == [(1, 1), (3, 3), (1, 10), (1, 20), (4, 12)]


def test_invariant_anomaly_stream(spark):
    d = tempfile.mkdtemp(prefix="tl-s-")
    submit = [(1, 3000), (2, 5000), (3, 11000), (4, 12000), (5, 21000), (6, 23000), (7, 30000), (8, 37000)]
    sched = [(2, 7000), (1, 9000), (4, 15000), (3, 19000), (6, 27000), (5, 28000), (7, 35000), (8, 38000)]
    rows = [task_record(job=j, task=j, priority=1, etype=SUBMIT, ts=t) for j, t in submit]
    rows += [task_record(job=j, task=j, priority=1, etype=SCHEDULE, ts=t) for j, t in sched]
    rows.sort(key=lambda r: r["timestamp"])
    flush = [task_record(job=FLUSH_JOB, task=0, priority=1, etype=SUBMIT, ts=FAR),
             task_record(job=FLUSH_JOB, task=0, priority=1, etype=SCHEDULE, ts=FAR + 1)]
    write_batches(d, _chunks(rows, 4) + [flush])
    tasks = S.read_task_stream(spark, d, max_files_per_trigger=1)
    out = run(spark, S.invariant_anomaly_stream(tasks, 10000 * MS))
    got = sorted((r.timestamp, r.priority, r.duration // MS) for r in out if r.job_id != FLUSH_JOB)
    assert [(p, x) for _, p, x in got] == [(1, 8000), (1, 7000), (1, 1000)]


def test_trace_file_stream_task_statistics(spark):
    """S1 as a stream: gzipped trace lines arrive file by file."""
    import gzip
    import os

    from tracelens.sources.trace_files import stream_task_events

    d = tempfile.mkdtemp(prefix="tl-s-")
    lines = [f"{t * 1000},,1,0,{m},{e},u,1,1" for m, e, t in STATS]
    lines.append(f"{FAR * 1000},,1,0,{FLUSH_JOB},{FINISH},u,1,1")
    for i, chunk in enumerate(_chunks(lines, 6)):
        p = os.path.join(d, f"part-{i:05d}.csv.gz")
        with open(p, "wb") as f:
            f.write(gzip.compress(("\n".join(chunk) + "\n").encode()))
        os.utime(p, (1_600_000_000 + i, 1_600_000_000 + i))
    tasks = stream_task_events(spark, d, max_files_per_trigger=1).withWatermark("event_time", "0 seconds")
    out = run(spark, S.task_statistics_stream(tasks, "1 minute", by="machine_id"))
    got = sorted((r.window_start // MS, r.machine_id, r.finished, r.failed, r.killed) for r in out
                 if r.machine_id != FLUSH_JOB)
    assert got == sorted([(0, 1, 1, 1, 0), (0, 2, 1, 0, 0), (0, 3, 1, 2, 0), (60000, 4, 0, 0, 1),
                          (60000, 2, 0, 0, 2), (120000, 1, 1, 1, 0), (120000, 5, 0, 1, 1),
                          (120000, 9, 0, 0, 1), (180000, 99, 1, 0, 0)])


def test_disorder_within_delay_and_late_rows(spark):
    """Input shuffled within the watermark delay gives the batch result;
    a row later than the watermark is dropped and counted."""
    import random

    from tracelens.streaming.sinks import late_rows, start

    d = tempfile.mkdtemp(prefix="tl-s-")
    rows = [task_record(machine=m, etype=e, ts=t) for m, e, t in STATS]
    rnd = random.Random(3)
    batches = _chunks(rows, 5)
    for b in batches:
        rnd.shuffle(b)  # disorder inside a batch, all within the 60 s delay
    late = [task_record(machine=7, etype=FINISH, ts=1000)]  # far behind the watermark
    flush = [task_record(machine=FLUSH_JOB, etype=FINISH, ts=FAR)]
    write_batches(d, batches + [late, flush])
    tasks = S.read_task_stream(spark, d, delay="60 seconds", max_files_per_trigger=1)
    q = start(S.task_statistics_stream(tasks, "1 minute"), "memory", name="disorder_q",
              checkpoint=tempfile.mkdtemp(prefix="tl-ck-"))
    q.processAllAvailable()
    q.stop()
    out = spark.sql("SELECT * FROM disorder_q").collect()
    got = sorted((r.window_start // MS, r.finished, r.failed, r.killed) for r in out
                 if r.window_start < FAR * MS - 60 * 10**6)
    assert got == [(0, 3, 3, 0), (60000, 0, 0, 3), (120000, 1, 2, 2), (180000, 1, 0, 0)]
    assert late_rows(q) == 1


def test_longest_session_ignores_sessions_after_finish(spark):
    """Sessions that close after the job's finish timer fired are ignored."""
    dt, dj = tempfile.mkdtemp(prefix="tl-s-"), tempfile.mkdtemp(prefix="tl-s-"),
    b1 = [task_record(job=1, etype=SUBMIT, ts=t) for t in (0, 1000, 2000)]
    b2 = [task_record(job=1, etype=SUBMIT, ts=t) for t in (3_000_000, 3_001_000)]
    b3 = [task_record(job=FLUSH_JOB, etype=SUBMIT, ts=FAR)]
    write_batches(dt, [b1, b2, b3])
    write_batches(dj, [[job_record(1, 100_000, FINISH)], [job_record(2, 3_100_000, SUBMIT)],
                       [job_record(FLUSH_JOB, FAR, FINISH)]], kind="job")
    tasks = S.read_task_stream(spark, dt, max_files_per_trigger=1)
    jevents = S.read_job_stream(spark, dj, max_files_per_trigger=1)
    out = run(spark, S.longest_session_stream(tasks, jevents, "10 minutes"))
    assert sorted((r.job_id, r.session_events) for r in out if r.job_id != FLUSH_JOB) == [(1, 3)]


def test_longest_session_wait_for_open_session(spark):
    """Waiting one gap after the finish also counts the session that was
    still open at the finish."""
    def run_once(wait):
        dt, dj = tempfile.mkdtemp(prefix="tl-s-"), tempfile.mkdtemp(prefix="tl-s-")
        # session [0, 2000] (3 events); finish at 1500; flush far away
        write_batches(dt, [[task_record(job=1, etype=SUBMIT, ts=t) for t in (0, 1000, 2000)],
                           [task_record(job=FLUSH_JOB, etype=SUBMIT, ts=FAR)]])
        write_batches(dj, [[job_record(1, 1500, FINISH)], [job_record(FLUSH_JOB, FAR, FINISH)]], kind="job")
        out = run(spark, S.longest_session_stream(S.read_task_stream(spark, dt, max_files_per_trigger=1),
                                                  S.read_job_stream(spark, dj, max_files_per_trigger=1),
                                                  "10 minutes", wait_for_open_session=wait))
        return sorted((r.job_id, r.session_events) for r in out if r.job_id != FLUSH_JOB)

    assert run_once(True) == [(1, 3)]


def test_pair_stream_with_ttl(spark):
    """With a TTL the processor runs on processing time and the query keeps
    running (no-data batches evict expired slots): poll the sink, then stop."""
    import time

    d = tempfile.mkdtemp(prefix="tl-s-")
    ev = [(1, 0, SUBMIT), (1, 5, SCHEDULE), (2, 6, SUBMIT)]
    write_batches(d, [[job_record(j, t, e) for j, t, e in ev]], kind="job")
    out = S.job_scheduling_latency_stream(S.read_job_stream(spark, d), ttl="1 hour")
    q = (out.writeStream.format("memory").queryName("ttl_q")
         .option("checkpointLocation", tempfile.mkdtemp(prefix="tl-ck-")).start())
    try:
        rows = []
        for _ in range(120):
            rows = spark.sql("SELECT * FROM ttl_q").collect()
            if rows:
                break
            time.sleep(0.5)
    finally:
        q.stop()
    assert [(r.job_id, r.latency // MS) for r in rows] == [(1, 5)]


def test_rule_stream_ttl_clears_slots_without_e1(spark):
    """A SCHEDULE without a SUBMIT blocks the slot for ever in the reference;
    with a ttl it is cleared after that much event time, so a later epoch can
    use a new SCHEDULE."""
    def once(ttl):
        d = tempfile.mkdtemp(prefix="tl-s-")
        early = [task_record(job=1, task=1, etype=SCHEDULE, ts=1000)]
        later = [task_record(job=1, task=1, etype=e, ts=t) for e, t in
                 ((SUBMIT, 100000), (SCHEDULE, 101000), (KILL, 102000))]
        write_batches(d, [early, later, [task_record(job=FLUSH_JOB, etype=SUBMIT, ts=FAR)]])
        tasks = S.read_task_stream(spark, d, max_files_per_trigger=1)
        out = run(spark, S.rule_anomaly_stream(tasks, SUBMIT, SCHEDULE, KILL, 10000 * MS, ttl=ttl))
        return sorted((r.job_id, r.second.timestamp // MS) for r in out if r.job_id != FLUSH_JOB)

    assert once(None) == []
    assert once("30 seconds") == [(1, 101000)]


def test_compact_update_mode_forms(spark):
    d = tempfile.mkdtemp(prefix="tl-s-")
    ev = [(42, 0, 1, SUBMIT, 0), (42, 0, 1, FINISH, 1), (42, 0, 1, SUBMIT, 2), (42, 7, 3, SUBMIT, 3),
          (42, 7, 3, FINISH, 6), (42, 0, 1, FINISH, 12), (42, 1, 1, SUBMIT, 13), (42, 1, 1, FINISH, 33),
          (23, 9, 4, SUBMIT, 35), (23, 9, 4, SUBMIT, 63), (23, 9, 4, FINISH, 75)]
    rows = [task_record(job=j, task=k, priority=p, etype=e, ts=t + 1) for j, k, p, e, t in ev]
    write_batches(d, _chunks(rows, 4) + [[task_record(job=FLUSH_JOB, etype=SUBMIT, ts=FAR)]])
    tasks = S.read_task_stream(spark, d, max_files_per_trigger=1)
    out = run(spark, S.max_task_completion_stream(tasks, running=False), mode="update")
    final = {}
    for r in out:  # update mode: the last row per priority is the current maximum
        final[r.priority] = max(final.get(r.priority, 0), r.max_duration // MS)
    assert final == {1: 20, 3: 3, 4: 12}

    dj = tempfile.mkdtemp(prefix="tl-s-")
    jev = [(1, 0), (2, 1), (1, 2), (3, 3), (3, 4), (1, 5)]
    write_batches(dj, _chunks([job_record(j, t, SUBMIT) for j, t in jev], 2), kind="job")
    counts = run(spark, S.job_event_count_stream(S.read_job_stream(spark, dj, max_files_per_trigger=1),
                                                 compact=True), mode="update")
    last = {}
    for r in counts:
        last[r.job_id] = max(last.get(r.job_id, 0), r.event_count)
    assert last == {1: 3, 2: 1, 3: 2}


def test_stream_pairs_random_batches_equal_state_machine(spark):
    import random

    from test_pairs_random import state_machine

    rnd = random.Random(2)
    ev, t = [], 0
    for _ in range(600):
        t += rnd.randint(1, 4)
        ev.append((rnd.choice((0, 0, 1, 2, 3)), t, rnd.choice((0, 1))))
    d = tempfile.mkdtemp(prefix="tl-s-")
    rows = [job_record(k, t, e, ms=False) for k, t, e in ev]
    write_batches(d, _chunks(rows, 57), kind="job")
    for repeat in ("latest", "first"):  # in order of arrival, which here is the events'
        out = run(spark, S.job_scheduling_latency_stream(
            S.read_job_stream(spark, d, max_files_per_trigger=1), repeat=repeat, order="arrival"))
        got = {(r.job_id, r.timestamp, r.timestamp - r.latency) for r in out}
        assert got == state_machine(ev, repeat), repeat


def _shuffled_batches(rows, delay_us, size, seed):
    """Rows in an order of arrival up to ``delay_us`` behind their times."""
    import random

    rnd = random.Random(seed)
    order = sorted(rows, key=lambda r: r["timestamp"] + rnd.randrange(delay_us))
    return _chunks(order, size)


def test_event_order_of_shuffled_streams(spark):
    """Rows shuffled within the delay over 12 micro-batches: the pair matcher
    and the counter give what they give on ordered input."""
    import random

    from test_pairs_random import state_machine

    rnd = random.Random(7)
    ev, t = [], 0
    for _ in range(600):
        t += rnd.randint(1, 4)
        ev.append((rnd.choice((0, 0, 1, 2, 3)), t * 1000, rnd.choice((0, 1))))
    rows = [job_record(k, t, e, ms=False) for k, t, e in ev]
    d = tempfile.mkdtemp(prefix="tl-s-")
    batches = _shuffled_batches(rows, 150_000, 50, 1)
    assert [r for b in batches for r in b] != rows and len(batches) >= 12
    write_batches(d, batches + [[job_record(FLUSH_JOB, FAR, SUBMIT)]], kind="job")

    def jobs():
        return S.read_job_stream(spark, d, delay="300 milliseconds", max_files_per_trigger=1)

    for repeat in ("latest", "first"):
        out = run(spark, S.job_scheduling_latency_stream(jobs(), repeat=repeat))
        assert {(r.job_id, r.timestamp, r.timestamp - r.latency) for r in out} == state_machine(ev, repeat), repeat
    seen, want = {}, set()
    for k, t, _ in ev:
        seen[k] = seen.get(k, 0) + 1
        want.add((k, t, seen[k]))
    out = run(spark, S.job_event_count_stream(jobs()))
    assert {(r.job_id, r.timestamp, r.event_count) for r in out if r.job_id != FLUSH_JOB} == want
