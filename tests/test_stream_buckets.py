"""The event-order processors work on buckets of keys: state, timers and calls
of a micro-batch follow the buckets, and results do not depend on them."""

import random
import tempfile

from streaming_harness import job_record, run, task_record, write_batches
from test_pairs_random import state_machine
from test_restart import FAR, LIMIT, _random_events, _rows, rule_state_machine

from tracelens.schema import KILL, SCHEDULE, SUBMIT
from tracelens.streaming import jobs as S

KEYS, FLUSH_JOB = 300, 10**6


def _job_folder(flush=True):
    rnd = random.Random(3)
    ev = [(rnd.randrange(KEYS), t * 1000, rnd.choice((SUBMIT, SCHEDULE))) for t in range(1, 1501)]
    order = sorted(ev, key=lambda e: e[1] + rnd.randrange(200_000))
    d = tempfile.mkdtemp(prefix="tl-b-")
    rows = [job_record(k, t, e, ms=False) for k, t, e in order]
    last = [[job_record(FLUSH_JOB, FAR, SUBMIT)]] if flush else []
    write_batches(d, [rows[i:i + 300] for i in range(0, len(rows), 300)] + last, kind="job")
    return ev, d


def test_state_follows_buckets_not_keys(spark):
    _, d = _job_folder(flush=False)
    ck, out = tempfile.mkdtemp(prefix="tl-b-ck-"), tempfile.mkdtemp(prefix="tl-b-out-")
    jobs = S.read_job_stream(spark, d, delay="300 milliseconds", max_files_per_trigger=1)
    q = (S.job_event_count_stream(jobs, buckets=4).writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination()
    for name in ("waiting", "count"):
        state = spark.read.format("statestore").option("stateVarName", name).load(ck)
        assert 0 < state.select("key").distinct().count() <= 4, name


def test_pairs_and_counts_of_any_buckets(spark):
    ev, d = _job_folder()
    seen, want = {}, set()
    for k, t, _ in ev:
        seen[k] = seen.get(k, 0) + 1
        want.add((k, t, seen[k]))
    for buckets in (1, 7):
        def jobs():
            return S.read_job_stream(spark, d, delay="300 milliseconds", max_files_per_trigger=1)

        out = run(spark, S.job_scheduling_latency_stream(jobs(), repeat="first", buckets=buckets))
        assert {(r.job_id, r.timestamp, r.timestamp - r.latency) for r in out} == state_machine(ev, "first")
        out = run(spark, S.job_event_count_stream(jobs(), buckets=buckets))
        assert {(r.job_id, r.timestamp, r.event_count) for r in out if r.job_id != FLUSH_JOB} == want


def test_rule_of_one_bucket_equals_state_machine(spark):
    ev = _random_events(23, n=900, keys=40)
    rows = _rows(ev)
    d = tempfile.mkdtemp(prefix="tl-b-")
    write_batches(d, [rows[i:i + 90] for i in range(0, len(rows), 90)] +
                  [[task_record(job=FLUSH_JOB, task=0, etype=SUBMIT, ts=FAR)]])
    out = run(spark, S.rule_anomaly_stream(S.read_task_stream(spark, d, max_files_per_trigger=1), SUBMIT, SCHEDULE,
                                           KILL, LIMIT * 1000, buckets=1))
    got = sorted((r.job_id, r.first.timestamp // 1000, r.second.timestamp // 1000, r.third.timestamp // 1000)
                 for r in out if r.job_id != FLUSH_JOB)
    want = sorted(rule_state_machine(ev, SUBMIT, SCHEDULE, KILL, LIMIT))
    assert want and got == want
