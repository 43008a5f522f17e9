"""Hot-key splitting gives the same results as the unsplit plans.  Tiny
thresholds force splitting; one key holds a third of all events."""

import random

from conftest import make_tasks
from pyspark.sql import functions as F
from test_pairs_random import state_machine

from tracelens.operators import skew
from tracelens.operators.pairs import max_task_completion, pair_events
from tracelens.operators.rolling import job_event_count

SPLIT = dict(hot_key_rows=30, chunk_rows=9)


def _skewed(seed, n=900, keys=20):
    rnd = random.Random(seed)
    ev, t = [], 0
    for _ in range(n):
        t += rnd.randint(0, 3)  # equal timestamps happen
        k = 0 if rnd.random() < 1 / 3 else rnd.randrange(1, keys)
        ev.append((k, t, rnd.choice((0, 1, 1, 0, 0))))
    return ev


def test_add_chunks_splits_hot_key(spark):
    ev = _skewed(1)
    tasks = make_tasks(spark, [dict(job=k, ts=t, etype=e) for k, t, e in ev], ms=False)
    d, n = skew.add_chunks(tasks, ["job_id"], **SPLIT)
    assert n > 5
    chunks = {r.job_id: r.c for r in d.groupBy("job_id").agg({"_chunk": "max"})
              .withColumnRenamed("max(_chunk)", "c").collect()}
    assert chunks[0] > 5


def test_pairs_latest_split_equals_state_machine(spark):
    for seed in (2, 3, 4):
        ev = _skewed(seed)
        tasks = make_tasks(spark, [dict(job=k, ts=t, etype=e) for k, t, e in ev], ms=False)
        got = {(r.job_id, r.event_seq, r.partner_seq) for r in
               pair_events(tasks, ["job_id"], 0, 1, **SPLIT).collect()}
        # the state machine in event_seq order (= list order, ts non-decreasing)
        want_ts = state_machine([(k, i, e) for i, (k, t, e) in enumerate(ev)])
        assert got == {(k, close, partner) for k, close, partner in want_ts}


def test_running_count_split(spark):
    ev = _skewed(5)
    from conftest import make_jobs

    jobs = make_jobs(spark, [dict(job=k, ts=t, etype=e) for k, t, e in ev], ms=False)
    got = {(r.job_id, r.event_seq, r.event_count) for r in job_event_count(jobs, **SPLIT).collect()}
    seen, want = {}, set()
    for i, (k, _, _) in enumerate(ev):
        seen[k] = seen.get(k, 0) + 1
        want.add((k, i, seen[k]))
    assert got == want


def test_running_max_split(spark):
    ev = _skewed(6)
    tasks = make_tasks(spark, [dict(job=k, task=0, priority=k % 2, ts=t, etype=(0 if e == 0 else 4))
                               for k, t, e in ev], ms=False)
    split = max_task_completion(tasks, running=True, **SPLIT)
    plain = max_task_completion(tasks, running=True, hot_key_rows=None)
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    assert rows(split) == rows(plain) and len(rows(plain)) > 50


def test_sessions_split(spark):
    from conftest import make_jobs

    from tracelens.operators.sessions import longest_session_per_job, session_ids

    rnd = random.Random(9)
    rows, t = [], 0
    for _ in range(700):
        t += rnd.choice((1, 2, 3, 40))  # gap 10: some steps break sessions
        rows.append(dict(job=0 if rnd.random() < 0.4 else rnd.randrange(1, 8), ts=t, etype=0))
    tasks = make_tasks(spark, rows, ms=False)
    a = sorted(tuple(r) for r in session_ids(tasks.select("job_id", "timestamp", "event_seq"),
                                             ["job_id"], 10, **SPLIT).collect())
    b = sorted(tuple(r) for r in session_ids(tasks.select("job_id", "timestamp", "event_seq"),
                                             ["job_id"], 10, hot_key_rows=None).collect())
    assert a == b
    jobs = make_jobs(spark, [dict(job=j, ts=0, etype=4) for j in range(8)])
    x = sorted(tuple(r) for r in longest_session_per_job(tasks, jobs, 10, **SPLIT).collect())
    # brute force
    best, last, cur = {}, {}, {}
    for r in rows:
        j = r["job"]
        cur[j] = cur.get(j, 0) + 1 if j in last and r["ts"] - last[j] <= 10 else 1
        last[j] = r["ts"]
        best[j] = max(best.get(j, 0), cur[j])
    assert x == sorted(best.items())


def test_pairs_all_modes_split_equal_state_machine(spark):
    for seed, repeat, directed in ((31, "first", False), (32, "latest", True), (33, "first", True),
                                   (34, "first", False)):
        ev = _skewed(seed)
        tasks = make_tasks(spark, [dict(job=k, ts=t, etype=e) for k, t, e in ev], ms=False)
        got = {(r.job_id, r.event_seq, r.partner_seq) for r in
               pair_events(tasks, ["job_id"], 0, 1, repeat=repeat, directed=directed, **SPLIT).collect()}
        want = state_machine([(k, i, e) for i, (k, t, e) in enumerate(ev)], repeat, directed)
        assert got == want, (seed, repeat, directed)


def test_rule_repeat_split_equals_state_machine(spark):
    from test_restart import rule_state_machine

    from tracelens.operators.patterns import rule_anomaly

    rnd = random.Random(41)
    ev, t = [], 0
    for _ in range(900):
        t += rnd.randint(1, 9)
        k = 0 if rnd.random() < 1 / 3 else rnd.randrange(1, 6)
        ev.append((k, t, rnd.choice((0, 1, 5, 0, 2))))
    tasks = make_tasks(spark, [dict(job=k, task=0, etype=e, ts=t) for k, t, e in ev], ms=False)
    split = dict(hot_key_rows=40, chunk_rows=15)
    out = rule_anomaly(tasks, 0, 1, 5, 200, epoch="repeat", **split).collect()
    got = {(r.job_id, r.first.timestamp, r.second.timestamp, r.third.timestamp) for r in out}
    want = rule_state_machine(ev, 0, 1, 5, 200)
    assert want and got == want
    # and the hot key was split
    from tracelens.operators.skew import plan_chunks
    assert plan_chunks(tasks, ["job_id", "task_index"], **split).chunks > 5


def test_chunks_are_balanced_for_bursty_keys(spark):
    rnd = random.Random(12)
    rows = [dict(job=0, ts=rnd.randrange(0, 100_000), etype=0) for _ in range(900)]
    rows += [dict(job=0, ts=rnd.randrange(100_000, 1_000_000), etype=1) for _ in range(100)]
    rows += [dict(job=k, ts=rnd.randrange(0, 1_000_000), etype=0) for k in range(1, 5) for _ in range(20)]
    tasks = make_tasks(spark, rows, ms=False)
    d, n = skew.add_chunks(tasks, ["job_id"], hot_key_rows=100, chunk_rows=50)
    sizes = [r["count"] for r in d.where("job_id = 0").groupBy("_chunk").count().collect()]
    assert n > 0 and len(sizes) >= 10 and max(sizes) <= 150, sorted(sizes)
    assert d.where("job_id <> 0 AND _chunk <> 0").count() == 0
    # and results stay exact on such a key
    ev = sorted([(r["job"], r["ts"], r["etype"]) for r in rows], key=lambda x: x[1])
    tasks2 = make_tasks(spark, [dict(job=k, ts=t, etype=e) for k, t, e in ev], ms=False)
    got = {(r.job_id, r.event_seq, r.partner_seq) for r in
           pair_events(tasks2, ["job_id"], 0, 1, hot_key_rows=100, chunk_rows=50).collect()}
    assert got == state_machine([(k, i, e) for i, (k, t, e) in enumerate(ev)])


def test_key_larger_than_the_chunk_budget_is_still_split(spark):
    rows = [dict(job=0, ts=i, etype=i % 2) for i in range(600)] + [dict(job=1, ts=i, etype=0) for i in range(5)]
    tasks = make_tasks(spark, rows, ms=False)
    # needs 600 / 10 = 60 chunks but the budget is 12: it gets 12 larger chunks
    d, n = skew.add_chunks(tasks, ["job_id"], hot_key_rows=50, chunk_rows=10, max_chunks=12)
    sizes = [r["count"] for r in d.where("job_id = 0").groupBy("_chunk").count().collect()]
    assert n == 12 and len(sizes) >= 8 and max(sizes) <= 120, sorted(sizes)


def test_one_timestamp_flood_is_cut_by_sequence(spark):
    # 600 events of key 0 at one timestamp (plus a few others): only the
    # event_seq order can split them
    rnd = random.Random(3)
    ev = [(0, 1000, rnd.choice((0, 1))) for _ in range(600)]
    ev += [(0, t, rnd.choice((0, 1))) for t in range(2000, 2100)]
    ev += [(k, t, 0) for k in range(1, 4) for t in range(10)]
    ev.sort(key=lambda x: x[1])
    tasks = make_tasks(spark, [dict(job=k, ts=t, etype=e) for k, t, e in ev], ms=False)
    split = dict(hot_key_rows=50, chunk_rows=40)
    d, n = skew.add_chunks(tasks, ["job_id"], **split)
    sizes = [r["count"] for r in d.where("job_id = 0").groupBy("_chunk").count().collect()]
    assert max(sizes) <= 120 and len(sizes) >= 8, sorted(sizes)
    got = {(r.job_id, r.event_seq, r.partner_seq) for r in
           pair_events(tasks, ["job_id"], 0, 1, repeat="first", **split).collect()}
    assert got == state_machine([(k, i, e) for i, (k, t, e) in enumerate(ev)], "first")
    from conftest import make_jobs

    jobs = make_jobs(spark, [dict(job=k, ts=t, etype=e) for k, t, e in ev], ms=False)
    counts = {(r.job_id, r.event_seq): r.event_count for r in job_event_count(jobs, **split).collect()}
    seen = {}
    for i, (k, _, _) in enumerate(ev):
        seen[k] = seen.get(k, 0) + 1
        assert counts[(k, i)] == seen[k]


def test_sketch_names_every_hot_key(spark, monkeypatch):
    """Few tracked keys, many cold ones: the hot ones are named, and nearly
    none of the others; the plan is that of exact counts."""
    from tracelens.operators import skew

    df = spark.range(200_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).when(F.col("id") % 20 == 1, F.lit(-2))
        .otherwise(F.col("id")).cast("long").alias("k"),
        F.col("id").alias("timestamp"), F.col("id").alias("event_seq"))
    monkeypatch.setattr(skew, "SKETCH_ITEMS", 512)
    named = {r[0] for r in skew.frequent_hashes(df, ["k"], 5000).collect()}
    hot = {r[0] for r in spark.createDataFrame([(-1,), (-2,)], "k long").select(F.xxhash64("k")).collect()}
    assert hot <= named and len(named) <= 4
    plan = skew.plan_chunks(df, ["k"], hot_key_rows=5000, chunk_rows=1000)
    assert {r["k"] for r in plan.frame.collect()} == {-1, -2}


def test_chunk_budget_is_shared(spark):
    """More hot keys than the budget serves whole: all are cut."""
    from tracelens.operators import skew

    df = spark.range(8000).select((F.col("id") % 8).alias("k"), F.col("id").alias("timestamp"),
                                  F.col("id").alias("event_seq"))
    plan = skew.plan_chunks(df, ["k"], hot_key_rows=100, chunk_rows=10, max_chunks=80)
    assert plan.frame.count() == 8 and plan.chunks <= 80
    out = skew.running_count(df, ["k"], "n", hot_key_rows=100, chunk_rows=10, max_chunks=80)
    want = df.groupBy("k").count().collect()
    assert {(r["k"], r["n"]) for r in out.groupBy("k").agg(F.max("n").alias("n")).collect()} == {tuple(r) for r in want}


def test_epoch_segments_of_dense_and_sparse_keys(spark):
    """Epoch starts are the chain of a plain walk, over segments of many
    epochs, gaps of just the limit, ties and keys of one e1."""
    from tracelens.operators.patterns import _epoch_starts
    from tracelens.operators.skew import plan_chunks

    lim = 5
    times = {1: [*range(200), *range(206, 260, 3), 265, 271, 271, 276, 400],
             2: [7], 3: [0, 6, 12, 18], 4: [0, 5, 10, 15], 5: [3] * 9 + [8, 9] * 4}
    rows = [(k, t, i) for k, ts in times.items() for i, t in enumerate(sorted(ts))]
    e = spark.createDataFrame(rows, "job_id long, timestamp long, event_seq long")
    want = set()
    for k, ts in times.items():
        end = None
        for i, t in enumerate(sorted(ts), 1):
            if end is None or t > end:
                want.add((k, i, t))
                end = t + lim
    for split in ({"hot_key_rows": None}, {"hot_key_rows": 20, "chunk_rows": 10}):
        plan = plan_chunks(e, ["job_id"], split_ties=False, **split)
        got = [(r["job_id"], r["_idx"], r["timestamp"]) for r in _epoch_starts(e, ["job_id"], lim, plan).collect()]
        assert len(got) == len(set(got)) and set(got) == want
