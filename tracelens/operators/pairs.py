"""The alternating-pair matcher, and the jobs built on it.

The reference runs a one-slot state machine per key: an empty slot stores
the event; an event of the same type replaces it (``repeat="latest"``) or is
ignored (``repeat="first"``); an event of the other type emits
``abs(t2 - t1)`` and empties the slot.

Here the same result comes from window functions over one sort per key.
Cut the key's events (ordered by timestamp, event_seq) into runs of equal
type.  The slot is open when run r starts unless run r-1 closed it, i.e.
``open(r) = NOT open(r-1) OR len(r-1) >= 2`` with ``open(1) = false``.  With
``j`` the last earlier run of length >= 2 (or -1 when there is none) that
recurrence has the closed form ``open(r) = (r - 1 - j) even``.  A pair is
emitted at the first row of every open run.  Run number and ``j`` are a
running sum and a running max, so the whole matcher is a few window
expressions that share one exchange and one sort; no Python, no state.

With ``directed=True`` only ``type_a -> type_b`` pairs count (a lone
``type_b`` is ignored): every run of ``type_a`` that is followed by a run of
``type_b`` gives one pair.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schema import FINISH, SCHEDULE, SUBMIT, ensure_seq
from .filters import keep_types
from .skew import CHUNK, CHUNK_ROWS, HOT_KEY_ROWS, add_chunks, running_max


def pair_events(df: DataFrame, keys: Sequence[str], type_a: int, type_b: int,
                repeat: str = "latest", directed: bool = False,
                carry: Sequence[str] = (), hot_key_rows: int | None = HOT_KEY_ROWS,
                chunk_rows: int = CHUNK_ROWS, chunk_plan=None) -> DataFrame:
    """Match alternating ``type_a`` / ``type_b`` events per key.

    Output: keys, timestamp, event_seq, event_type (of the closing event),
    carry columns (of the closing event), partner_timestamp, partner_seq,
    duration (``abs`` of the time difference, microseconds).

    Keys with more than ``hot_key_rows`` events are split into time chunks
    (``skew.add_chunks``); ``hot_key_rows=None`` turns splitting off and
    ``chunk_plan`` reuses a plan from ``skew.plan_chunks``.
    """
    if repeat not in ("latest", "first"):
        raise ValueError("repeat must be 'latest' or 'first'")
    keys = list(keys)
    carry = [c for c in carry if c not in keys]
    d = keep_types(ensure_seq(df), type_a, type_b).select(
        *keys, "timestamp", "event_seq", "event_type", *carry)
    d, hot = add_chunks(d, keys, hot_key_rows=hot_key_rows, chunk_rows=chunk_rows, plan=chunk_plan)
    out = _match(d, keys, type_a, type_b, repeat, directed, hot)
    return out.select(*keys, "timestamp", "event_seq", "event_type", *carry,
                      F.col("_partner.ts").alias("partner_timestamp"),
                      F.col("_partner.seq").alias("partner_seq"),
                      F.abs(F.col("timestamp") - F.col("_partner.ts")).alias("duration"))


def _here():
    return F.struct(F.col("timestamp").alias("ts"), F.col("event_seq").alias("seq"))


def _pair(ts: str, seq: str):
    return F.struct(F.col(ts).alias("ts"), F.col(seq).alias("seq"))


def _match(d: DataFrame, keys, type_a, type_b, repeat, directed, hot) -> DataFrame:
    """All four variants, per (key, chunk), stitched across chunk borders.

    Local (per chunk) values: ``_chg`` (row starts a run), run number
    ``_run``, ``_long`` (largest run number of a non-first row before this
    row).  Summary A gives each hot chunk, from the chunks before it:
    ``_cont`` (its first row continues the previous chunk's last run),
    ``_roff`` (run number offset), ``_jb`` (largest run number of a
    non-first row in earlier chunks), the previous chunk's last event and
    type.  That yields, per row, the global run start ``g_chg`` and
    ``open`` (the slot is full when the run starts), hence the emitting
    rows; ``latest`` pairs with the previous row.

    ``first`` pairs with the last "filler" before the emitting row: the
    event that filled the slot.  Undirected, that is the first non-emitting
    row of a run (the first row of a run entered empty, else its second
    row); directed, the first row of a ``type_a`` run.  "Last filler" is a
    running last-non-null, carried across chunks by summary B.  For chunk 0
    (every key that was not split) no summary applies and all formulas
    reduce to plain running windows.
    """
    w = Window.partitionBy(*keys, CHUNK).orderBy("timestamp", "event_seq")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    cw = Window.partitionBy(*keys).orderBy(CHUNK)
    cw_before = cw.rowsBetween(Window.unboundedPreceding, -1)
    et = F.col("event_type")

    d = (d.withColumn("_pt", F.lag("event_type").over(w))
          .withColumn("_prev", F.lag(_here()).over(w))
          .withColumn("_rn", F.row_number().over(w)))
    d = d.withColumn("_chg", F.col("_pt").isNull() | (F.col("_pt") != et))
    d = d.withColumn("_run", F.sum(F.col("_chg").cast("long")).over(upto))
    d = d.withColumn("_long", F.max(F.when(~F.col("_chg"), F.col("_run"))).over(before))
    first = F.col("_rn") == 1

    if hot:
        summ = (d.where(F.col(CHUNK) > 0).groupBy(*keys, CHUNK).agg(
            F.max(F.when(first, et)).alias("_tf"),
            F.max_by("event_type", "_rn").alias("_tl"),
            F.max_by("timestamp", "_rn").alias("_lts"),
            F.max_by("event_seq", "_rn").alias("_lseq"),
            F.max("_run").alias("_nchg"),
            F.max(F.when(~F.col("_chg"), F.col("_run"))).alias("_mx")))
        summ = (summ.withColumn("_plts", F.lag("_lts").over(cw))
                    .withColumn("_plseq", F.lag("_lseq").over(cw))
                    .withColumn("_ptl", F.lag("_tl").over(cw))
                    .withColumn("_cont", F.coalesce(F.lag("_tl").over(cw) == F.col("_tf"), F.lit(False))))
        summ = summ.withColumn("_inc", F.col("_nchg") - F.col("_cont").cast("long"))
        summ = summ.withColumn("_rend", F.sum("_inc").over(
            cw.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        summ = summ.withColumn("_roff", F.col("_rend") - F.col("_inc") - F.col("_cont").cast("long"))
        summ = summ.withColumn("_jc", F.greatest(F.col("_roff") + F.col("_mx"),
                                                 F.when(F.col("_cont"), F.col("_roff") + 1)))
        summ = summ.withColumn("_jb", F.max("_jc").over(cw_before))
        summ = summ.select(*keys, CHUNK, "_cont", "_roff", "_jb", "_plts", "_plseq", "_ptl")
        # one row per hot chunk: bounded by the chunk budget of add_chunks
        d = d.join(F.broadcast(summ), keys + [CHUNK], "left")
    else:
        d = (d.withColumn("_cont", F.lit(False)).withColumn("_roff", F.lit(0).cast("long"))
              .withColumn("_jb", F.lit(None).cast("long"))
              .withColumn("_plts", F.lit(None).cast("long")).withColumn("_plseq", F.lit(None).cast("long"))
              .withColumn("_ptl", F.lit(None).cast("int")))

    cont = F.coalesce(F.col("_cont"), F.lit(False))
    roff = F.coalesce(F.col("_roff"), F.lit(0).cast("long"))
    g_chg = F.when(first, ~cont).otherwise(F.col("_chg"))
    g_pt = F.when(first, F.col("_ptl")).otherwise(F.col("_pt"))
    g_run = roff + F.col("_run")
    g_long = F.greatest(F.col("_jb"), F.when(~first & cont, roff + 1), roff + F.col("_long"))
    if directed:
        emit = g_chg & (et == type_b) & (g_pt == type_a)
    else:
        emit = g_chg & (((g_run - 1 - F.coalesce(g_long, F.lit(-1))) % 2) == 0)
    d = d.withColumn("_gchg", g_chg).withColumn("_emit", F.coalesce(emit, F.lit(False)))

    if repeat == "latest":
        partner = F.when(first, _pair("_plts", "_plseq")).otherwise(F.col("_prev"))
        return d.where(F.col("_emit")).withColumn("_partner", partner)

    # ---- repeat == "first": last filler strictly before the emitting row
    def filler(prev_emit):
        if directed:
            return F.col("_gchg") & (et == type_a)
        return ~F.col("_emit") & (F.col("_gchg") | (prev_emit & ~F.col("_gchg")))

    if hot:
        d = d.withColumn("_lemit_l", F.lag("_emit").over(w))
        rest = filler(F.coalesce(F.col("_lemit_l"), F.lit(False))) & ~first
        summ_b = (d.where(F.col(CHUNK) > 0).groupBy(*keys, CHUNK).agg(
            F.max_by("_emit", "_rn").alias("_lemit"),
            F.max_by("timestamp", F.when(rest, F.col("_rn"))).alias("_rts"),
            F.max_by("event_seq", F.when(rest, F.col("_rn"))).alias("_rseq"),
            F.max(F.when(first, F.col("_emit"))).alias("_femit"),
            F.max(F.when(first, F.col("_gchg"))).alias("_fchg"),
            F.max(F.when(first, et)).alias("_ftype"),
            F.max(F.when(first, F.col("timestamp"))).alias("_fts"),
            F.max(F.when(first, F.col("event_seq"))).alias("_fseq")))
        summ_b = summ_b.withColumn("_plemit", F.coalesce(F.lag("_lemit").over(cw), F.lit(False)))
        if directed:
            fcand = F.col("_fchg") & (F.col("_ftype") == type_a)
        else:
            fcand = ~F.col("_femit") & (F.col("_fchg") | (F.col("_plemit") & ~F.col("_fchg")))
        last_in_chunk = F.when(F.col("_rts").isNotNull(), _pair("_rts", "_rseq")) \
            .otherwise(F.when(fcand, _pair("_fts", "_fseq")))
        summ_b = summ_b.withColumn("_clast", last_in_chunk)
        summ_b = summ_b.select(*keys, CHUNK, "_plemit",
                               F.last("_clast", ignorenulls=True).over(cw_before).alias("_pcand"))
        d = d.join(F.broadcast(summ_b), keys + [CHUNK], "left")
        prev_emit = F.when(first, F.coalesce(F.col("_plemit"), F.lit(False))) \
            .otherwise(F.coalesce(F.col("_lemit_l"), F.lit(False)))
    else:
        d = d.withColumn("_pcand", F.lit(None).cast("struct<ts:bigint,seq:bigint>"))
        prev_emit = F.coalesce(F.lag("_emit").over(w), F.lit(False))
    d = d.withColumn("_fill", filler(prev_emit))
    d = d.withColumn("_lf", F.last(F.when(F.col("_fill"), _here()), ignorenulls=True).over(before))
    return d.where(F.col("_emit")).withColumn("_partner", F.coalesce(F.col("_lf"), F.col("_pcand")))


def job_scheduling_latency(jobs: DataFrame, repeat: str = "latest",
                           directed: bool = False, **split) -> DataFrame:
    """Submit-to-schedule latency per job.

    Output: job_id, timestamp, event_seq (of the closing event), latency.
    """
    p = pair_events(jobs, ["job_id"], SUBMIT, SCHEDULE, repeat=repeat, directed=directed, **split)
    return p.select("job_id", "timestamp", "event_seq", F.col("duration").alias("latency"))


def task_durations(tasks: DataFrame, type_a: int = SUBMIT, type_b: int = FINISH,
                   repeat: str = "latest", **split) -> DataFrame:
    """Durations of (job, task) pairs; the closing event supplies the priority."""
    return pair_events(tasks, ["job_id", "task_index"], type_a, type_b, repeat=repeat,
                       carry=["priority"], **split)


def max_task_completion(tasks: DataFrame, running: bool = False,
                        repeat: str = "latest", **split) -> DataFrame:
    """Longest submit-to-finish duration per priority.

    ``running=False`` (default, scales with any number of priorities): one
    row per priority, ``priority, max_duration``.  ``running=True``: the
    reference's rolling form, one row per completed task in event-time order,
    ``priority, timestamp, event_seq, max_duration``.
    """
    d = task_durations(tasks, SUBMIT, FINISH, repeat=repeat, **split)
    if not running:
        return d.groupBy("priority").agg(F.max("duration").alias("max_duration"))
    # Few priorities, so at scale every priority is a hot key: split by time.
    # The chunk plan comes from the FINISH events (about one per pair), a
    # plain scan, instead of running the pair matcher twice.
    r = running_max(d.select("priority", "timestamp", "event_seq", "duration"), ["priority"],
                    "duration", "max_duration", plan_from=keep_types(tasks, FINISH), **split)
    return r.select("priority", "timestamp", "event_seq", "max_duration")
