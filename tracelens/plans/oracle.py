"""DuckDB oracle SQL for every driver query (written independently of the
Spark code: recursive CTEs for the state machines, plain group-bys for the
rest).  Tables are the driver's pre-registered views.

``T`` is the adapter of the ``events`` table to task events; all times are
BIGINT microseconds.
"""

from __future__ import annotations

DAY = 86_400_000_000

T = """
t AS (
  SELECT epoch_us(ts) AS "timestamp",
         user_id AS job_id,
         CAST(event_id % 3 AS INTEGER) AS task_index,
         CASE WHEN user_id % 20 = 0 THEN -1 ELSE user_id % 20 END AS machine_id,
         CASE event_type WHEN 'signup' THEN 0 WHEN 'click' THEN 1 WHEN 'error' THEN 3
                         WHEN 'purchase' THEN 4 WHEN 'view' THEN 5 END AS event_type,
         CAST(user_id % 12 AS INTEGER) AS priority,
         CAST(user_id % 4 AS INTEGER) AS scheduling_class,
         value AS max_cpu,
         event_id AS event_seq
  FROM events
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes)


ORACLE: dict[str, str] = {}

ORACLE["task_statistics_per_machine"] = _with(T) + f"""
SELECT ("timestamp" // {DAY}) * {DAY} AS window_start, machine_id,
       count(*) FILTER (WHERE event_type = 4) AS finished,
       count(*) FILTER (WHERE event_type = 3) AS failed,
       count(*) FILTER (WHERE event_type = 5) AS killed
FROM t WHERE event_type IN (3, 4, 5)
GROUP BY 1, 2
"""

ORACLE["task_statistics_global"] = _with(T) + f"""
SELECT ("timestamp" // {DAY}) * {DAY} AS window_start,
       count(*) FILTER (WHERE event_type = 4) AS finished,
       count(*) FILTER (WHERE event_type = 3) AS failed,
       count(*) FILTER (WHERE event_type = 5) AS killed
FROM t WHERE event_type IN (3, 4, 5)
GROUP BY 1
"""

ORACLE["filter_task_events"] = _with(T) + """
SELECT "timestamp", job_id, task_index, machine_id, event_type, priority,
       scheduling_class, max_cpu, event_seq
FROM t WHERE event_type IN (0, 4)
"""

ORACLE["busy_machines"] = _with(T, f"""
per_machine AS (
  SELECT machine_id, ("timestamp" // {DAY}) * {DAY} + o.k * {DAY} AS window_end, count(*) AS n
  FROM t, (SELECT range AS k FROM range(1, 4)) o
  WHERE event_type = 1
  GROUP BY 1, 2
)""") + """
SELECT window_end, count(*) AS busy_machines
FROM per_machine WHERE n >= 10
GROUP BY 1
"""

ORACLE["job_event_count"] = _with(T) + """
SELECT job_id, "timestamp", event_seq,
       count(*) OVER (PARTITION BY job_id ORDER BY "timestamp", event_seq
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS event_count
FROM t
"""


def _pairs(name: str, keys: list[str], ta: int, tb: int, repeat: str, carry: list[str],
           directed: bool = False) -> str:
    """Recursive CTE that walks each key's events one by one with the slot
    (type, ts, seq) as carried state; ``<name>`` holds the emitted pairs.
    ``directed``: only ``ta`` events fill the slot, a ``tb`` without a
    filled slot is ignored."""
    k = ", ".join(keys)
    on = " AND ".join(f"e.{c} = w.{c}" for c in keys)
    ek = ", ".join(f"e.{c}" for c in keys)
    cr = "".join(f", {c}" for c in carry)
    ecr = "".join(f", e.{c}" for c in carry)
    keep_ts, keep_seq = (('e."timestamp"', "e.event_seq") if repeat == "latest"
                         else ("w.s_ts", "w.s_seq"))
    if directed:
        s_type = f"""CASE WHEN w.s_type IS NULL THEN (CASE WHEN e.event_type = {ta} THEN e.event_type END)
              WHEN w.s_type = e.event_type THEN e.event_type END"""
        s_ts = f"""CASE WHEN w.s_type IS NULL THEN (CASE WHEN e.event_type = {ta} THEN e."timestamp" END)
              WHEN w.s_type = e.event_type THEN {keep_ts} END"""
        s_seq = f"""CASE WHEN w.s_type IS NULL THEN (CASE WHEN e.event_type = {ta} THEN e.event_seq END)
              WHEN w.s_type = e.event_type THEN {keep_seq} END"""
        first_type = f"CASE WHEN event_type = {ta} THEN event_type END"
        first_ts = f'CASE WHEN event_type = {ta} THEN "timestamp" END'
        first_seq = f"CASE WHEN event_type = {ta} THEN event_seq END"
    else:
        s_type = "CASE WHEN w.s_type IS NULL OR w.s_type = e.event_type THEN e.event_type END"
        s_ts = f"""CASE WHEN w.s_type IS NULL THEN e."timestamp"
              WHEN w.s_type = e.event_type THEN {keep_ts} END"""
        s_seq = f"""CASE WHEN w.s_type IS NULL THEN e.event_seq
              WHEN w.s_type = e.event_type THEN {keep_seq} END"""
        first_type, first_ts, first_seq = "event_type", '"timestamp"', "event_seq"
    return f"""
{name}_e AS (
  SELECT {k}, "timestamp", event_seq, event_type{cr},
         row_number() OVER (PARTITION BY {k} ORDER BY "timestamp", event_seq) AS rn
  FROM t WHERE event_type IN ({ta}, {tb})
),
{name}_walk AS (
  SELECT {k}, rn, {first_type} AS s_type, {first_ts} AS s_ts, {first_seq} AS s_seq,
         false AS emit, "timestamp", event_seq{cr}, NULL::BIGINT AS p_ts
  FROM {name}_e WHERE rn = 1
  UNION ALL
  SELECT {ek}, e.rn,
         {s_type},
         {s_ts},
         {s_seq},
         w.s_type IS NOT NULL AND w.s_type <> e.event_type,
         e."timestamp", e.event_seq{ecr}, w.s_ts
  FROM {name}_walk w JOIN {name}_e e ON {on} AND e.rn = w.rn + 1
),
{name} AS (
  SELECT {k}, "timestamp", event_seq{cr}, abs("timestamp" - p_ts) AS duration
  FROM {name}_walk WHERE emit
)"""


# In "latest" mode a repeated type refreshes the slot with the new event, in
# "first" mode the slot keeps what it holds.
ORACLE["job_scheduling_latency"] = "WITH RECURSIVE " + T.strip() + "," + _pairs(
    "p", ["job_id"], 0, 1, "latest", []) + """
SELECT job_id, "timestamp", event_seq, duration AS latency FROM p
"""

ORACLE["job_scheduling_latency_first"] = "WITH RECURSIVE " + T.strip() + "," + _pairs(
    "p", ["job_id"], 0, 1, "first", []) + """
SELECT job_id, "timestamp", event_seq, duration AS latency FROM p
"""

ORACLE["max_task_completion"] = "WITH RECURSIVE " + T.strip() + "," + _pairs(
    "p", ["job_id", "task_index"], 0, 4, "latest", ["priority"]) + """
SELECT priority, max(duration) AS max_duration FROM p GROUP BY priority
"""

ORACLE["max_task_completion_running"] = "WITH RECURSIVE " + T.strip() + "," + _pairs(
    "p", ["job_id", "task_index"], 0, 4, "latest", ["priority"]) + """
SELECT priority, "timestamp", event_seq,
       max(duration) OVER (PARTITION BY priority ORDER BY "timestamp", event_seq
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS max_duration
FROM p
"""

ORACLE["longest_session_per_job"] = _with(T, f"""
s AS (
  SELECT job_id, "timestamp", event_seq,
         CASE WHEN "timestamp" - lag("timestamp") OVER (PARTITION BY job_id ORDER BY "timestamp", event_seq)
                   > {3 * DAY} THEN 1 ELSE 0 END AS brk
  FROM t WHERE event_type = 0
)""", """
s2 AS (
  SELECT job_id, sum(brk) OVER (PARTITION BY job_id ORDER BY "timestamp", event_seq
                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid
  FROM s
)""", """
c AS (SELECT job_id, sid, count(*) AS n FROM s2 GROUP BY job_id, sid)""") + """
SELECT job_id, max(n) AS session_events FROM c
WHERE job_id IN (SELECT job_id FROM t WHERE event_type = 4)
GROUP BY job_id
"""

ORACLE["rule_anomaly_single"] = _with(T, """
f AS (
  SELECT job_id, task_index, event_type, "timestamp", event_seq,
         row_number() OVER (PARTITION BY job_id, task_index, event_type
                            ORDER BY "timestamp", event_seq) AS rn
  FROM t WHERE event_type IN (0, 1, 5)
)""") + f"""
SELECT a.job_id, a.task_index,
       a."timestamp" AS first_timestamp, a.event_seq AS first_seq,
       b."timestamp" AS second_timestamp, b.event_seq AS second_seq,
       c."timestamp" AS third_timestamp, c.event_seq AS third_seq
FROM f a
JOIN f b ON b.job_id = a.job_id AND b.task_index = a.task_index AND b.event_type = 1 AND b.rn = 1
JOIN f c ON c.job_id = a.job_id AND c.task_index = a.task_index AND c.event_type = 5 AND c.rn = 1
WHERE a.event_type = 0 AND a.rn = 1
  AND a."timestamp" < b."timestamp" AND b."timestamp" < c."timestamp"
  AND c."timestamp" - a."timestamp" <= {5 * DAY}
"""

TRAINING_END_US = 1_705_276_800_000_000  # 2024-01-15 00:00:00 UTC

ORACLE["invariant_anomaly"] = "WITH RECURSIVE " + T.strip() + "," + _pairs(
    "p", ["job_id", "task_index"], 0, 1, "latest", ["priority"]) + f""",
b AS (
  SELECT priority, min(duration) AS mn, max(duration) AS mx
  FROM p WHERE "timestamp" <= {TRAINING_END_US} GROUP BY priority
)
SELECT p.priority, p.job_id, p.task_index, p."timestamp", p.event_seq, p.duration
FROM p JOIN b ON b.priority = p.priority
WHERE p."timestamp" > {TRAINING_END_US} AND (p.duration > b.mx OR p.duration < b.mn)
"""

ORACLE["time_series_anomaly"] = _with(T, f"""
a AS (
  SELECT machine_id, ("timestamp" // {DAY}) * {DAY} + o.k * {DAY} AS window_end,
         avg(max_cpu) AS cur
  FROM t, (SELECT range AS k FROM range(1, 4)) o
  WHERE event_type = 1 AND max_cpu > 0
  GROUP BY 1, 2
)""", f"""
m AS (
  SELECT x.machine_id, x.window_end, x.cur, (z.cur + y.cur + x.cur) / 3 AS mov
  FROM a x
  JOIN a y ON y.machine_id = x.machine_id AND y.window_end = x.window_end - {DAY}
  JOIN a z ON z.machine_id = x.machine_id AND z.window_end = x.window_end - {2 * DAY}
)""") + """
SELECT machine_id, window_end, round(cur, 6) AS current_avg, round(mov, 6) AS moving_avg
FROM m WHERE 2 * abs(cur - mov) / (cur + mov) > 0.3
"""

_WIRE = _with(T) + """
SELECT event_seq, "timestamp", '' AS missing_info, job_id, task_index, machine_id, event_type,
       '' AS username, scheduling_class, priority, max_cpu,
       CAST(0 AS DOUBLE) AS max_ram, CAST(0 AS DOUBLE) AS max_disk, false AS different_machine
FROM t
"""
ORACLE["task_event_json"] = _WIRE
ORACLE["task_event_text"] = _WIRE

ORACLE["dead_letters"] = _with(T, """
d AS (SELECT source, event_seq, event_seq % 7 <> 0 AND event_seq % 11 <> 0 AS accepted, "timestamp", job_id, event_type
      FROM t, (SELECT unnest(['task_line', 'job_line', 'json', 'text']) AS source))""") + """
SELECT source, event_seq, accepted, CASE WHEN accepted THEN "timestamp" END AS "timestamp",
       CASE WHEN accepted THEN job_id END AS job_id, CAST(CASE WHEN accepted THEN event_type END AS BIGINT) AS event_type,
       count(*) FILTER (WHERE NOT accepted) OVER (PARTITION BY source) AS all_rejected
FROM d
"""

ORACLE["rule_anomaly_repeat"] = "WITH RECURSIVE " + T.strip() + f""",
e AS (SELECT job_id, task_index, "timestamp", event_seq, event_type FROM t WHERE event_type IN (0, 1, 5)),
s1 AS (SELECT job_id, task_index, "timestamp" AS ts FROM e WHERE event_type = 0),
nx AS (
  SELECT a.job_id, a.task_index, a.ts, min(b.ts) AS nts
  FROM s1 a LEFT JOIN s1 b
    ON b.job_id = a.job_id AND b.task_index = a.task_index AND b.ts > a.ts + {5 * DAY}
  GROUP BY a.job_id, a.task_index, a.ts
),
chain AS (
  SELECT job_id, task_index, min(ts) AS ts FROM s1 GROUP BY job_id, task_index
  UNION ALL
  SELECT c.job_id, c.task_index, nx.nts
  FROM chain c JOIN nx ON nx.job_id = c.job_id AND nx.task_index = c.task_index AND nx.ts = c.ts
  WHERE nx.nts IS NOT NULL
),
ep AS (
  SELECT e.job_id, e.task_index, e."timestamp", e.event_seq, e.event_type, min(c.ts) AS epoch
  FROM e JOIN chain c
    ON c.job_id = e.job_id AND c.task_index = e.task_index AND c.ts + {5 * DAY} >= e."timestamp"
  GROUP BY e.job_id, e.task_index, e."timestamp", e.event_seq, e.event_type
),
f AS (
  SELECT *, row_number() OVER (PARTITION BY job_id, task_index, epoch, event_type
                               ORDER BY "timestamp", event_seq) AS rn
  FROM ep
)
SELECT a.job_id, a.task_index,
       a."timestamp" AS first_timestamp, a.event_seq AS first_seq,
       b."timestamp" AS second_timestamp, b.event_seq AS second_seq,
       c."timestamp" AS third_timestamp, c.event_seq AS third_seq
FROM f a
JOIN f b ON b.job_id = a.job_id AND b.task_index = a.task_index AND b.epoch = a.epoch
        AND b.event_type = 1 AND b.rn = 1
JOIN f c ON c.job_id = a.job_id AND c.task_index = a.task_index AND c.epoch = a.epoch
        AND c.event_type = 5 AND c.rn = 1
WHERE a.event_type = 0 AND a.rn = 1
  AND a."timestamp" < b."timestamp" AND b."timestamp" < c."timestamp"
  AND c."timestamp" - a."timestamp" <= {5 * DAY}
"""

# Stream forms over the whole table in one micro-batch: same results as batch.
ORACLE["job_event_count_stream"] = ORACLE["job_event_count"]
ORACLE["job_scheduling_latency_stream"] = ORACLE["job_scheduling_latency"]
ORACLE["max_task_completion_running_stream"] = ORACLE["max_task_completion_running"]
for _name in ("rule_anomaly_repeat", "task_statistics_per_machine", "busy_machines", "invariant_anomaly",
              "time_series_anomaly"):
    ORACLE[f"{_name}_stream"] = ORACLE[_name]

ORACLE["job_scheduling_latency_directed"] = "WITH RECURSIVE " + T.strip() + "," + _pairs(
    "p", ["job_id"], 0, 1, "latest", [], directed=True) + """
SELECT job_id, "timestamp", event_seq, duration AS latency FROM p
"""

ORACLE["task_sessions"] = _with(T, f"""
s AS (
  SELECT job_id, "timestamp", event_seq,
         CASE WHEN "timestamp" - lag("timestamp") OVER (PARTITION BY job_id ORDER BY "timestamp", event_seq)
                   > {3 * DAY} THEN 1 ELSE 0 END AS brk
  FROM t WHERE event_type = 0
)""", """
s2 AS (
  SELECT job_id, "timestamp", sum(brk) OVER (PARTITION BY job_id ORDER BY "timestamp", event_seq
                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid
  FROM s
)""") + f"""
SELECT job_id, min("timestamp") AS session_start, max("timestamp") + {3 * DAY} AS session_end,
       count(*) AS session_events
FROM s2 GROUP BY job_id, sid
"""

ORACLE["cpu_window_means"] = _with(T) + f"""
SELECT machine_id, ("timestamp" // {DAY}) * {DAY} + o.k * {DAY} AS window_end,
       round(avg(max_cpu), 6) AS current_avg
FROM t, (SELECT range AS k FROM range(1, 4)) o
WHERE event_type = 1 AND max_cpu > 0
GROUP BY 1, 2
"""

ORACLE["task_statistics_from_trace_files"] = ORACLE["task_statistics_per_machine"]

HOUR = 3_600_000_000

ORACLE["busy_machines_hourly"] = _with(T, f"""
per_machine AS (
  SELECT machine_id, ("timestamp" // {HOUR}) * {HOUR} - o.k * {HOUR} + {DAY} AS window_end, count(*) AS n
  FROM t, (SELECT range AS k FROM range(0, 24)) o
  WHERE event_type = 1
  GROUP BY 1, 2
)""") + """
SELECT window_end, count(*) AS busy_machines
FROM per_machine WHERE n >= 5
GROUP BY 1
"""

ORACLE["longest_session_bounds"] = _with(T, f"""
s AS (
  SELECT job_id, "timestamp", event_seq,
         CASE WHEN "timestamp" - lag("timestamp") OVER (PARTITION BY job_id ORDER BY "timestamp", event_seq)
                   > {3 * DAY} THEN 1 ELSE 0 END AS brk
  FROM t WHERE event_type = 0
)""", """
s2 AS (
  SELECT job_id, "timestamp", sum(brk) OVER (PARTITION BY job_id ORDER BY "timestamp", event_seq
                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid
  FROM s
)""", f"""
c AS (
  SELECT job_id, min("timestamp") AS session_start, max("timestamp") + {3 * DAY} AS session_end,
         count(*) AS session_events
  FROM s2 GROUP BY job_id, sid
)""", """
r AS (
  SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY session_events DESC, session_start) AS rn
  FROM c
)""") + """
SELECT job_id, session_start, session_end, session_events FROM r
WHERE rn = 1 AND job_id IN (SELECT job_id FROM t WHERE event_type = 4)
"""
