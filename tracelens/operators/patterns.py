"""Three-step sequence rule with a time limit.

Per (job, task) the first event of each of the types e1, e2, e3 fills a
slot; the triple is reported when ``t1 < t2 < t3`` and ``t3 - t1 <= limit``.

``epoch="single"`` is what a bounded run of the reference computes (one
final watermark fires every timer at the end, so each key has one epoch):
the slots are three ``min_by`` aggregates with a FILTER, a declarative
aggregate that Spark combines map-side, so a hot key costs one partial row
per map task.

``epoch="repeat"`` is the event-time semantics of the stream: the first e1
after the previous epoch opens an epoch that ends at t(e1) + limit; the
slots are the first event of each type inside the epoch.  The epoch starts
form a forward chain over the e1 events (``next(i)`` = first e1 later than
``t_i + limit``).  An e1 more than the limit after the one before it opens
an epoch in any case, so each key falls into segments at such gaps, found
from the pointers alone (``next(i) = i + 1``); only pointers inside a
segment are followed, by doubling: round k joins the members found so far
with the 2^k-step pointers and drops those that leave their segment, until
none is left (log2 of the epochs of the densest segment, often no round at
all), each round's result checkpointed to cut lineage.  Events are then assigned to
the epoch whose end is the first one at or after them (a running minimum
over a descending sort), and the single-epoch slot aggregation runs per
(key, epoch).  The per-key running count and both as-of lookups split hot
keys into time chunks (``skew``), so no key needs a single task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import ensure_seq
from .filters import keep_types

DEFAULT_KEYS = ("job_id", "task_index")


def _limit_micros(limit) -> int:
    if isinstance(limit, (int,)):
        return int(limit)
    from ..functions.time import interval_micros

    return interval_micros(limit)


def rule_anomaly(tasks: DataFrame, e1: int, e2: int, e3: int, limit,
                 keys: Sequence[str] = DEFAULT_KEYS, epoch: str = "single", **split) -> DataFrame:
    """J9.  ``limit`` is microseconds or an interval string; ``epoch`` is
    ``"single"`` or ``"repeat"`` (see the module doc).

    Output: keys, first, second, third -- structs of the whole events.
    """
    keys = list(keys)
    lim = _limit_micros(limit)
    t = keep_types(ensure_seq(tasks), e1, e2, e3)
    if epoch == "repeat":
        t = _assign_epochs(t, keys, e1, lim, **split)
        keys = keys + ["_epoch"]
    elif epoch != "single":
        raise ValueError("epoch must be 'single' or 'repeat'")
    payload = [c for c in t.columns if c not in ("event_time",)]
    row = F.struct(*[F.col(c) for c in payload])
    order = F.struct("timestamp", "event_seq")
    et = F.col("event_type")
    slots = t.groupBy(*keys).agg(
        F.min_by(F.when(et == e1, row), F.when(et == e1, order)).alias("first"),
        F.min_by(F.when(et == e2, row), F.when(et == e2, order)).alias("second"),
        F.min_by(F.when(et == e3, row), F.when(et == e3, order)).alias("third"),
    )
    t1, t2, t3 = (F.col(f"{s}.timestamp") for s in ("first", "second", "third"))
    out = slots.where((t1 < t2) & (t2 < t3) & (t3 - t1 <= F.lit(lim)))
    return out.drop("_epoch") if epoch == "repeat" else out


def _epoch_starts(starts: DataFrame, keys: list[str], lim: int, plan) -> DataFrame:
    """e1 events (keys, timestamp, event_seq) -> the chain of epoch starts:
    (keys, _idx, timestamp) of the e1 events that open an epoch."""
    from ..session import ensure_checkpoint_dir
    from .skew import min_item_after, running_count

    ensure_checkpoint_dir(starts.sparkSession)  # the shared folder; set only when missing
    e = running_count(starts, keys, "_idx", plan=plan)  # 1, 2, ... per key in time order
    # next(i): first e1 strictly later than t_i + limit
    probes = e.select(*keys, (F.col("timestamp") + F.lit(lim)).alias("_t"), F.lit(False).alias("_item"),
                      F.col("_idx").alias("_src"), F.lit(None).cast("long").alias("_val"))
    items = e.select(*keys, F.col("timestamp").alias("_t"), F.lit(True).alias("_item"),
                     F.lit(None).cast("long").alias("_src"), F.col("_idx").alias("_val"))
    nxt = (min_item_after(probes.unionByName(items), keys, "_t", "_item", "_val", "_next",
                          items_first_at_tie=True, plan=plan)
           .where(~F.col("_item")).select(*keys, F.col("_src").alias("_idx"), "_next", "_t"))
    nxt = nxt.checkpoint()
    # a segment begins where the e1 before lies more than the limit back; its
    # first e1 opens an epoch whatever came before
    heads = (nxt.where(F.col("_idx") == 1).select(*keys, "_idx")
             .unionByName(nxt.where(F.col("_next") == F.col("_idx") + 1)
                          .select(*keys, F.col("_next").alias("_idx"))))
    # pointers inside dense segments; those into the next segment are finished
    jump = (nxt.where(F.col("_next") > F.col("_idx") + 1).select(*keys, "_idx", "_next")
            .join(heads.withColumnRenamed("_idx", "_next"), keys + ["_next"], "left_anti")
            .select(*keys, "_idx", "_next").checkpoint())
    members = heads
    while not jump.isEmpty():
        found = members.join(jump, keys + ["_idx"]).select(*keys, F.col("_next").alias("_idx"))
        members = members.unionByName(found).checkpoint()
        # doubled pointers; those that leave their segment are dropped
        onward = jump.withColumnsRenamed({"_idx": "_mid", "_next": "_far"})
        jump = (jump.withColumnRenamed("_next", "_mid").join(onward, keys + ["_mid"])
                .select(*keys, "_idx", F.col("_far").alias("_next")).checkpoint())
    return members.join(nxt.select(*keys, "_idx", (F.col("_t") - F.lit(lim)).alias("timestamp")), keys + ["_idx"])


def _assign_epochs(t: DataFrame, keys: list[str], e1: int, lim: int, **split) -> DataFrame:
    """Add ``_epoch`` (the start index of the epoch) to every event that lies
    in a closed epoch; events after the last epoch end are dropped."""
    from .skew import min_item_after, plan_chunks

    # at equal times the as-of lookups decide by kind, not by event_seq, so
    # one timestamp must stay in one chunk
    plan = plan_chunks(t, keys, split_ties=False, **split)
    starts = _epoch_starts(t.where(F.col("event_type") == e1).select(*keys, "timestamp", "event_seq"),
                           keys, lim, plan)
    ends = starts.select(*keys, (F.col("timestamp") + F.lit(lim)).alias("_t"),
                         F.lit(True).alias("_item"), F.col("_idx").alias("_val"))
    ev = (t.withColumn("_t", F.col("timestamp")).withColumn("_item", F.lit(False))
           .withColumn("_val", F.lit(None).cast("long")))
    # an event at exactly an epoch end belongs to that epoch
    tagged = min_item_after(ev.unionByName(ends, allowMissingColumns=True), keys, "_t", "_item",
                            "_val", "_epoch", items_first_at_tie=False, plan=plan)
    return (tagged.where(~F.col("_item") & F.col("_epoch").isNotNull())
            .drop("_t", "_item", "_val"))
