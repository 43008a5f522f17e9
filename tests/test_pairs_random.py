"""The window-function pair matcher against a plain one-slot state machine
on random A/B sequences (all three variants)."""

import random

from conftest import make_tasks

from tracelens.operators.pairs import pair_events


def state_machine(events, repeat="latest", directed=False, a=0, b=1):
    """events: list of (key, ts, type) in order -> set of (key, close_ts, partner_ts)."""
    slot, out = {}, set()
    for key, ts, typ in events:
        cur = slot.get(key)
        if directed:
            if typ == a:
                if cur is None or repeat == "latest":
                    slot[key] = ts
            elif cur is not None:
                out.add((key, ts, cur))
                del slot[key]
            continue
        if cur is None:
            slot[key] = (typ, ts)
        elif cur[0] == typ:
            if repeat == "latest":
                slot[key] = (typ, ts)
        else:
            out.add((key, ts, cur[1]))
            del slot[key]
    return out


def _events(seed, keys=40, n=900):
    rnd = random.Random(seed)
    ev, t = [], 0
    for _ in range(n):
        t += rnd.randint(1, 5)
        ev.append((rnd.randrange(keys), t, rnd.choice((0, 1, 0, 1, 1))))
    return ev


def _check(spark, seed, repeat, directed):
    ev = _events(seed)
    tasks = make_tasks(spark, [dict(job=k, ts=t, etype=e) for k, t, e in ev], ms=False)
    got = {(r.job_id, r.timestamp, r.partner_timestamp)
           for r in pair_events(tasks, ["job_id"], 0, 1, repeat=repeat, directed=directed).collect()}
    assert got == state_machine(ev, repeat, directed)


def test_latest(spark):
    for seed in (1, 2, 3):
        _check(spark, seed, "latest", False)


def test_first(spark):
    for seed in (4, 5, 6):
        _check(spark, seed, "first", False)


def test_directed(spark):
    for seed in (7, 8):
        _check(spark, seed, "latest", True)
        _check(spark, seed, "first", True)


def test_equal_timestamps_use_sequence(spark):
    # same timestamp, order given by event_seq only
    ev = [(1, 5, 0), (1, 5, 1), (1, 5, 1), (1, 5, 0)]
    tasks = make_tasks(spark, [dict(job=k, ts=t, etype=e) for k, t, e in ev], ms=False)
    out = pair_events(tasks, ["job_id"], 0, 1).orderBy("event_seq").collect()
    assert [(r.event_seq, r.partner_seq) for r in out] == [(1, 0), (3, 2)]


def test_batch_result_ignores_row_order(spark):
    ev = _events(21)
    rows = [dict(job=k, ts=t, etype=e) for k, t, e in ev]
    a = make_tasks(spark, rows, ms=False)
    # same events (same event_seq), different physical order
    from pyspark.sql import functions as F

    b = a.orderBy(F.rand(7)).repartition(5)
    ra = sorted(tuple(r) for r in pair_events(a, ["job_id"], 0, 1).collect())
    rb = sorted(tuple(r) for r in pair_events(b, ["job_id"], 0, 1).collect())
    assert ra == rb and len(ra) > 100


def test_stream_matcher_over_batches_equals_state_machine():
    """The processor's vectorised matcher, with the slot carried from one
    micro-batch to the next, against the state machine."""
    import numpy as np

    from tracelens.streaming.processors import match_pairs

    rnd = random.Random(1)
    for _ in range(2000):
        repeat = rnd.choice(["latest", "first"])
        n = rnd.randint(1, 14)
        ev = [(0, i, rnd.choice((0, 1))) for i in range(n)]
        cuts = sorted(rnd.sample(range(1, n), k=min(n - 1, rnd.randint(0, 3)))) if n > 1 else []
        slot, got, prev = None, set(), 0
        for c in cuts + [n]:
            part = ev[prev:c]
            prev = c
            typ = np.array([e for _, _, e in part])
            ts = np.array([t for _, t, _ in part])
            at, partner, (_, all_ts, _), slot = match_pairs(typ, ts, ts.copy(), slot, repeat)
            got |= {(0, int(all_ts[i]), int(all_ts[partner[i]])) for i in at}
        assert got == state_machine(ev, repeat), (repeat, ev, cuts)
