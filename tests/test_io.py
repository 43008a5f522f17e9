"""File readers (S1-S3) and wire formats."""

import gzip
import os
import tempfile

import pytest
from conftest import make_tasks

from tracelens.functions import codec
from tracelens.schema import FINISH, SUBMIT, TASK_COLUMNS, event_type_name
from tracelens.sources import trace_files


def _write(lines, gz=True):
    d = tempfile.mkdtemp(prefix="tl-io-")
    p = os.path.join(d, "part-00000.csv" + (".gz" if gz else ""))
    data = ("\n".join(lines) + "\n").encode()
    with open(p, "wb") as f:
        f.write(gzip.compress(data) if gz else data)
    return d


TASK_LINES = [
    "1000,,7,0,11,0,alice,2,9",                      # 9 tokens: limits default
    "2000,x,7,1,,1,alice,2,9,0.5,0.25,0.125",        # 12 tokens, empty machine
    "3000,,7,2,12,4,bob,1,3,0.1,0.2,0.3,1",          # 13 tokens
    "4000,,7,3,13,99,bob,1,3,0.1,0.2,0.3,0",         # unknown code -> null type
    "5000,,7,4,13,0,bob,1,3",
    "6000,,8,0,14,0,carol,1",                        # 8 tokens: error
    "abc,,8,0,14,0,carol,1,2",                       # not a number: error
    "7000,,9,0,15,1,dave,1,2,0.5,0.5,0.5,0,extra",   # 14 tokens: the extra one is ignored
]


def test_task_reader_permissive(spark):
    d = _write(TASK_LINES)
    parsed = trace_files.parse_task_lines(spark.read.text(d))
    rows = {r.timestamp: r for r in parsed.collect() if r._corrupt_record is None}
    assert set(rows) == {1000, 2000, 3000, 4000, 5000, 7000}
    assert rows[1000].max_cpu == 0.0 and rows[1000].different_machine is False
    assert rows[2000].machine_id == -1 and rows[2000].max_disk == 0.125 and rows[2000].missing_info == "x"
    assert rows[3000].different_machine is True and rows[3000].event_type == FINISH
    assert rows[4000].event_type is None
    bad = trace_files.bad_records(parsed).collect()
    assert len(bad) == 2


def test_task_reader_modes(spark):
    d = _write(TASK_LINES)
    df = trace_files.read_task_events(spark, d, mode="DROPMALFORMED")
    assert sorted(r.timestamp for r in df.collect()) == [1000, 2000, 3000, 4000, 5000, 7000]
    rows = {r.timestamp: r for r in df.collect()}
    assert rows[2000].machine_id == -1 and rows[2000].max_disk == 0.125 and rows[1000].max_cpu == 0.0
    assert rows[3000].different_machine is True and rows[4000].event_type is None
    assert set(df.columns) >= set(TASK_COLUMNS) | {"event_seq", "event_time"}
    with pytest.raises(Exception, match="Invalid event record"):
        trace_files.read_task_events(spark, d, mode="FAILFAST").collect()


def test_one_line_file_read_once(spark):
    d = _write(["1000,,7,0,11,0,alice,2,9"], gz=False)
    assert trace_files.read_task_events(spark, d).count() == 1


def test_job_reader(spark):
    d = _write([
        "1000,,7,0,alice,2,name,logical",
        "2000,,7,4,alice,2,name",            # 7 tokens: error
        "3000,,7,1,alice,2,name,",           # trailing empty dropped -> 7 tokens: error
        "4000,,8,1,bob,0,n,l",
    ])
    df = trace_files.read_job_events(spark, d, mode="DROPMALFORMED")
    with pytest.raises(Exception):  # the default
        trace_files.read_job_events(spark, d).collect()
    assert sorted(r.timestamp for r in df.collect()) == [1000, 4000]


def test_json_roundtrip(spark):
    tasks = make_tasks(spark, [dict(job=1, task=2, ts=3, etype=SUBMIT, machine=4, priority=5, max_cpu=0.5),
                               dict(job=6, task=7, ts=8, etype=FINISH, missing_info="")])
    enc = codec.encode(tasks, "json")
    rec = enc.first().value
    assert '"jobId":1' in rec and '"eventType":"SUBMIT"' in rec and '"maxCPU":0.5' in rec
    back = codec.decode(enc, "json").collect()
    assert sorted(tuple(r) for r in back) == sorted(tuple(r) for r in tasks.select(*TASK_COLUMNS).collect())


def test_text_roundtrip(spark):
    tasks = make_tasks(spark, [dict(job=1, task=2, ts=3, etype=SUBMIT, machine=4, priority=5, max_cpu=0.5),
                               dict(job=6, task=7, ts=8, etype=FINISH, missing_info="")])
    enc = codec.encode(tasks, "text")
    lines = sorted(r.value for r in enc.collect())
    assert lines[0] == "1,2,3000,4,SUBMIT,Kate,2,5,0.5,0.0,0.0,false,123"
    assert lines[1] == "6,7,8000,-1,FINISH,Kate,2,0,0.0,0.0,0.0,false"
    back = codec.decode(enc, "text").collect()
    assert sorted(tuple(r) for r in back) == sorted(tuple(r) for r in tasks.select(*TASK_COLUMNS).collect())


def test_event_type_names(spark):
    df = spark.range(10).select(event_type_name("id").alias("n"))
    names = [r.n for r in df.collect()]
    assert names[:3] == ["SUBMIT", "SCHEDULE", "EVICT"] and names[9] is None


def test_kafka_wiring_reports_missing_connector(spark):
    from tracelens.sources import kafka

    tasks = make_tasks(spark, [dict(job=1, task=0, ts=1, etype=SUBMIT)])
    try:
        spark.read.format("kafka").option("kafka.bootstrap.servers", "localhost:1").option(
            "subscribe", "t").load()
        pytest.skip("Kafka connector present")
    except Exception:  # noqa: BLE001
        pass
    with pytest.raises(kafka.KafkaUnavailable):
        kafka.read_task_topic(spark, "localhost:1", kafka.FILTERED_TOPIC, stream=False)
    with pytest.raises(kafka.KafkaUnavailable):
        kafka.export_filtered_tasks(tasks, "localhost:1")


def test_command_line_runs_a_job(tmp_path):
    import subprocess
    import sys as _sys

    d = _write([f"{t * 1000000},,7,0,{m},{e},u,1,1" for m, e, t in
                ((1, 4, 10), (2, 4, 11), (1, 3, 40), (3, 5, 70))])
    out = str(tmp_path / "stats")
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    r = subprocess.run([_sys.executable, "-m", "tracelens", "task-statistics", "--tasks", d,
                        "--by", "machine_id", "--out", out, "--local", "2"],
                       capture_output=True, text=True, cwd=repo, timeout=300)
    assert r.returncode == 0, r.stderr[-2000:]
    import pyarrow.parquet as pq

    rows = pq.read_table(out).to_pylist()
    assert sorted((x["window_start"] // 60_000_000, x["machine_id"], x["finished"], x["failed"], x["killed"])
                  for x in rows) == [(0, 1, 1, 1, 0), (0, 2, 1, 0, 0), (1, 3, 0, 0, 1)]


@pytest.mark.parametrize("job,extra", [
    ("longest-session", ["--gap", "10 minutes"]),
    ("rule-anomaly", ["--e1", "0", "--e2", "1", "--e3", "5", "--limit", "10 seconds", "--epoch", "repeat"]),
    ("scheduling-latency", ["--repeat", "first"]),
])
def test_command_line_jobs_run(job, extra):
    import subprocess
    import sys as _sys

    tasks = _write([f"{t * 1000},,{j},0,1,{e},u,1,1" for j, e, t in
                    ((1, 0, 5000), (1, 1, 9000), (1, 5, 12000), (2, 0, 1000))])
    jobs = _write([f"{t * 1000},,{j},{e},u,0,n,l" for j, e, t in
                   ((1, 0, 100), (1, 1, 900), (1, 4, 20000), (2, 0, 200))])
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    r = subprocess.run([_sys.executable, "-m", "tracelens", job, "--tasks", tasks, "--jobs", jobs,
                        "--local", "2", "--show", "5", *extra],
                       capture_output=True, text=True, cwd=repo, timeout=300)
    assert r.returncode == 0, r.stderr[-2000:]
    assert "+" in r.stdout  # a table was shown


def test_wire_modes_and_dead_letters(spark, tmp_path):
    from tracelens.functions import codec
    from tracelens.sources.trace_files import split_rejects

    good = ("1,2,3,4,SUBMIT,u,1,2,0.5,0.0,0.0,false", "1,2,3,4,KILL,u,1,2,0.5,0.0,0.0,true,info")
    bad = ("", "1,2,3,4,SUBMIT,u,1,2,0.5,0.0,0.0", "1,2,3,4,NOTHING,u,1,2,0.5,0.0,0.0,false",
           "1,2,3,,SUBMIT,u,1,2,0.5,0.0,0.0,false", "1,2,3,4,SUBMIT,u,1,2,x,0.0,0.0,false", None)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(good + bad)], "i int, value string")
    out = codec.decode(df, "text", keep=("i",), mode="PERMISSIVE")
    rows, rejects, counts = split_rejects(out, f"{tmp_path}/split")
    assert counts == {"accepted": 2, "rejected": 6}
    assert sorted(r["i"] for r in rows.collect()) == [0, 1] and "_corrupt_record" not in rows.columns
    assert {r["i"]: r["_corrupt_record"] for r in rejects.collect()} == {i: v or "" for i, v in enumerate(bad, 2)}
    assert codec.decode(df, "text", mode="DROPMALFORMED").count() == 2
    with pytest.raises(Exception, match="Invalid event record"):
        codec.decode(df, "text").collect()
    js = ['{"jobId":1,"taskIndex":2,"timestamp":3,"eventType":"SUBMIT","schedulingClass":1,"priority":2}',
          '{"jobId":1,"taskIndex":2,"timestamp":"no","eventType":"SUBMIT","schedulingClass":1,"priority":2}',
          "{", "[]", "", None, '{"jobId":1}']
    got = codec.decode(spark.createDataFrame([(v,) for v in js], "value string"), mode="PERMISSIVE").collect()
    assert [r["_corrupt_record"] is None for r in got] == [True] + [False] * 6
    assert (got[0]["machine_id"], got[0]["max_cpu"], got[0]["different_machine"]) == (-1, 0.0, False)
