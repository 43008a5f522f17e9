"""The rule job survives a stop and restart from its checkpoint, and
the repeat-epoch processor equals a plain state machine on random input."""

import random
import tempfile

from streaming_harness import run, task_record, write_batches

from tracelens.schema import KILL, SCHEDULE, SUBMIT
from tracelens.streaming import jobs as S

LIMIT = 200  # ms
FAR = 10**10


def rule_state_machine(events, e1, e2, e3, limit):
    """events: (key, ts, type) in time order -> set of (key, t1, t2, t3)."""
    slots, deadline, out = {}, {}, set()

    def close(k):
        s = slots.pop(k, {})
        deadline.pop(k, None)
        if all(e in s for e in (e1, e2, e3)):
            t1, t2, t3 = s[e1], s[e2], s[e3]
            if t1 < t2 < t3 and t3 - t1 <= limit:
                out.add((k, t1, t2, t3))

    for k, ts, typ in events:
        if k in deadline and ts > deadline[k]:
            close(k)
        s = slots.setdefault(k, {})
        if typ not in s:
            s[typ] = ts
            if typ == e1:
                deadline[k] = ts + limit
    for k in list(deadline):
        close(k)
    return out


def _random_events(seed, n=600, keys=6):
    rnd = random.Random(seed)
    t, ev = 0, []
    for _ in range(n):
        t += rnd.randint(1, 9)
        ev.append((rnd.randrange(keys), t, rnd.choice((SUBMIT, SCHEDULE, KILL, SUBMIT, 2))))
    return ev


def _rows(ev):
    return [task_record(job=k, task=0, etype=e, ts=t) for k, t, e in ev]


def _flush():
    return [task_record(job=10**6, task=0, etype=SUBMIT, ts=FAR)]


def test_repeat_epochs_match_state_machine(spark):
    ev = _random_events(11)
    d = tempfile.mkdtemp(prefix="tl-r-")
    rows = _rows(ev)
    write_batches(d, [rows[i:i + 50] for i in range(0, len(rows), 50)] + [_flush()])
    tasks = S.read_task_stream(spark, d, max_files_per_trigger=1)
    out = run(spark, S.rule_anomaly_stream(tasks, SUBMIT, SCHEDULE, KILL, LIMIT * 1000))
    got = {(r.job_id, r.first.timestamp // 1000, r.second.timestamp // 1000, r.third.timestamp // 1000)
           for r in out if r.job_id < 10**6}
    want = rule_state_machine(ev, SUBMIT, SCHEDULE, KILL, LIMIT)
    assert want and got == want


def _start(spark, src, sink, ck):
    tasks = S.read_task_stream(spark, src, max_files_per_trigger=1)
    q = S.start_rule_anomaly(tasks, sink, ck, SUBMIT, SCHEDULE, KILL, LIMIT * 1000)
    q.awaitTermination()


def _state(spark, checkpoint, name):
    """Keys that hold a value of a state variable, by the state data source."""
    return (spark.read.format("statestore").option("stateVarName", name).load(checkpoint)
            .select("key").distinct().count())


def _result(spark, sink):
    return sorted((r.job_id, r.first.timestamp, r.second.timestamp, r.third.timestamp)
                  for r in spark.read.parquet(sink).collect() if r.job_id < 10**6)


def test_restart_from_checkpoint(spark):
    ev = _random_events(5)
    rows = _rows(ev)
    batches = [rows[i:i + 60] for i in range(0, len(rows), 60)]
    base = tempfile.mkdtemp(prefix="tl-restart-")
    # one uninterrupted run
    write_batches(f"{base}/all", batches + [_flush()])
    _start(spark, f"{base}/all", f"{base}/out_all", f"{base}/ck_all")
    # the same input, stopped after half of it and restarted
    half = len(batches) // 2
    seq = write_batches(f"{base}/part", batches[:half])
    _start(spark, f"{base}/part", f"{base}/out_part", f"{base}/ck_part")
    # it stopped in the middle: rows wait in state, some slots are filled
    assert _state(spark, f"{base}/ck_part", "waiting") > 0 and _state(spark, f"{base}/ck_part", "slot0") > 0
    write_batches(f"{base}/part", batches[half:] + [_flush()], start_seq=seq, start_index=half)
    _start(spark, f"{base}/part", f"{base}/out_part", f"{base}/ck_part")
    # only the flush row is left waiting, as in the run without a stop
    assert _state(spark, f"{base}/ck_part", "waiting") == _state(spark, f"{base}/ck_all", "waiting") == 1
    once, twice = _result(spark, f"{base}/out_all"), _result(spark, f"{base}/out_part")
    assert once and once == twice
    assert set(once) == {(k, a * 1000, b * 1000, c * 1000)
                         for k, a, b, c in rule_state_machine(ev, SUBMIT, SCHEDULE, KILL, LIMIT)}


def test_batch_repeat_epochs_match_state_machine(spark):
    from conftest import make_tasks

    from tracelens.operators.patterns import rule_anomaly

    for seed in (11, 12):
        ev = _random_events(seed)
        tasks = make_tasks(spark, [dict(job=k, task=0, etype=e, ts=t) for k, t, e in ev], ms=False)
        out = rule_anomaly(tasks, SUBMIT, SCHEDULE, KILL, LIMIT, epoch="repeat").collect()
        got = {(r.job_id, r.first.timestamp, r.second.timestamp, r.third.timestamp) for r in out}
        want = rule_state_machine(ev, SUBMIT, SCHEDULE, KILL, LIMIT)
        assert want and got == want
