"""State of the pair streams follows the buckets, not the keys, and the
running maximum does not depend on the number of buckets."""

import random
import tempfile

from streaming_harness import run, task_record, write_batches
from test_restart import FAR
from test_stream_buckets import FLUSH_JOB, _job_folder

from tracelens.schema import FINISH, SUBMIT
from tracelens.streaming import jobs as S


def _state_groups(spark, ck, operator, names):
    return {n: spark.read.format("statestore").option("operatorId", operator).option("stateVarName", n).load(ck)
            .select("key").distinct().count() for n in names}


def _finished(out, folder):
    ck = tempfile.mkdtemp(prefix="tl-b-ck-")
    q = (out.writeStream.format("parquet").option("path", folder)
         .option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination()
    return ck


def _task_folder(flush):
    rnd = random.Random(5)
    ev = [(rnd.randrange(200), rnd.randrange(3), t * 1000, rnd.choice((SUBMIT, FINISH))) for t in range(1, 2001)]
    late = sorted(enumerate(ev), key=lambda e: e[1][2] + rnd.randrange(200_000))
    d = tempfile.mkdtemp(prefix="tl-b-")
    rows = [task_record(job=j, task=k, priority=j % 3, etype=e, ts=t, ms=False) for _, (j, k, t, e) in late]
    last = [[task_record(job=FLUSH_JOB, priority=9, etype=SUBMIT, ts=FAR)]] if flush else []
    write_batches(d, [rows[i:i + 400] for i in range(0, len(rows), 400)] + last)
    return ev, d


def _tasks(spark, d):
    return S.read_task_stream(spark, d, delay="300 milliseconds", max_files_per_trigger=1)


def test_running_max_pairs_keep_state_by_bucket(spark):
    _, d = _task_folder(flush=False)
    out = S.max_task_completion_stream(_tasks(spark, d), buckets=4)
    ck = _finished(out, tempfile.mkdtemp(prefix="tl-b-out-"))
    pairs, largest = 1, 0  # operator ids, from the sink
    for name, n in _state_groups(spark, ck, pairs, ("waiting", "slot")).items():
        assert 0 < n <= 4, name
    assert _state_groups(spark, ck, largest, ("best",)) == {"best": 3}  # one a priority


def test_running_max_of_any_buckets_equals_plain_walk(spark):
    ev, d = _task_folder(flush=True)
    slot, best, want = {}, {}, set()
    for j, k, t, e in ev:
        held = slot.get((j, k))
        if held is None or held[0] == e:
            slot[j, k] = (e, t)
            continue
        del slot[j, k]
        best[j % 3] = max(best.get(j % 3, 0), t - held[1])
        want.add((j % 3, t, best[j % 3]))
    assert len(want) > 300
    for buckets in (1, 7):
        out = run(spark, S.max_task_completion_stream(_tasks(spark, d), buckets=buckets))
        assert {(r.priority, r.timestamp, r.max_duration) for r in out} == want and len(out) == len(want)


def test_scheduling_latency_keeps_state_by_bucket(spark):
    _, d = _job_folder(flush=False)
    jobs = S.read_job_stream(spark, d, delay="300 milliseconds", max_files_per_trigger=1)
    ck = _finished(S.job_scheduling_latency_stream(jobs, buckets=4), tempfile.mkdtemp(prefix="tl-b-out-"))
    for name, n in _state_groups(spark, ck, 0, ("waiting", "slot")).items():
        assert 0 < n <= 4, name
