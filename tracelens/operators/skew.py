"""Hot-key splitting for the per-key sequential operators.

Running counts and maxima, the pair matcher, session numbering and the
as-of lookups of repeated rule epochs walk each key's events in order, so a
plain ``Window.partitionBy(key)`` puts a key that holds a third of the data
into one task.  Here:

1. A frequent-items sketch (``approx_top_k`` over key hashes, merged from one
   sketch a partition) names the keys that may have more than
   ``hot_key_rows`` events; only their rows are counted exactly, so no
   statistic is shuffled for the other keys.  Only the hot keys' (key, first
   time, bucket width) rows reach the driver, never the data.  The list is
   bounded: at most ``max_chunks`` chunks in total, shared in proportion.
2. Each hot key is cut into chunks of about ``chunk_rows`` events
   (``_chunk`` >= 1, contiguous in (timestamp, event_seq) order; equal
   timestamps stay together): FINE time buckets per chunk are counted and
   the chunk borders placed by cumulative count, so uneven event rates
   still give even chunks.  Other keys keep ``_chunk = 0``.
3. The operator runs per (key, _chunk) -- the hot key is now spread over
   many tasks -- and a per-chunk summary (one row per hot chunk, size known
   from step 1) carries state across chunk borders through a prefix over
   chunks; it is joined back by broadcast.

Ordinary keys never touch the summary, so the result equals the plain
plan for any choice of hot keys: splitting changes speed, not results.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Keys with more events than this are split (per-task sort stays small).
HOT_KEY_ROWS = 2_000_000
# Sketches (by key hash) and the keys that each tracks.  A key is surely named
# if it has more than about 5 / SKETCH_ITEMS of its sketch's events; one that is
# not stays whole, which costs time, not results.
SKETCHES = 64
SKETCH_ITEMS = 10_000
# Target events per chunk of a hot key.
CHUNK_ROWS = 1_000_000
# Bound on the number of chunks (= rows of every broadcast summary).
MAX_CHUNKS = 100_000

CHUNK = "_chunk"


class ChunkPlan:
    """Where hot keys are cut.

    ``frame``: hot keys with first time, fine-bucket width and count (a
    small local relation); ``params``: fine buckets that hold more than
    ``chunk_rows`` events at one single timestamp, with the ``event_seq``
    range they are cut in (local, small); ``lookup``: (key, fine bucket,
    sub-bucket) -> chunk, at most FINE x 2 x the chunk budget rows;
    ``chunks``: number of hot chunks planned."""

    def __init__(self, keys, frame=None, lookup=None, chunks: int = 0, params=None,
                 seq: str | None = None):
        self.keys, self.frame, self.lookup, self.chunks = list(keys), frame, lookup, chunks
        self.params, self.seq = params, seq


# Fine time buckets per planned chunk; chunk borders fall on fine-bucket
# borders chosen by cumulative counts, so a key whose events are unevenly
# spread in time still gets chunks of about ``chunk_rows`` events.
FINE = 8


def _fine_bucket(ts):
    f = F.floor((F.col(ts) - F.col("_lo")) / F.col("_fw")).cast("long")
    return F.least(F.greatest(f, F.lit(0)), F.col("_nf") - 1)


def _sub_bucket(seq):
    # a hashed event_seq spans the whole long range: the difference needs more
    ahead = F.col(seq).cast("decimal(20,0)") - F.col("_smin").cast("decimal(20,0)")
    s = F.floor(ahead / F.col("_sw").cast("decimal(20,0)")).cast("long")
    return F.least(F.greatest(s, F.lit(0)), F.col("_ns") - 1)


def frequent_hashes(df: DataFrame, keys: Sequence[str], least: int) -> DataFrame:
    """(_h): hashes of the keys that may have more than ``least`` rows of
    ``df``, at most SKETCHES x SKETCH_ITEMS.  Counts from the sketches are
    never too small for a key that they name."""
    h = df.select(F.xxhash64(*keys).alias("_h"))
    top = (h.groupBy(F.pmod("_h", F.lit(SKETCHES)).alias("_part"))
           .agg(F.expr(f"approx_top_k(_h, {SKETCH_ITEMS}, {SKETCH_ITEMS})").alias("_top")))
    return (top.select(F.explode(F.filter("_top", lambda t: t["count"] > least)).alias("_t"))
            .select(F.col("_t.item").alias("_h")))


def plan_chunks(df: DataFrame, keys: Sequence[str], hot_key_rows: int | None = HOT_KEY_ROWS,
                chunk_rows: int = CHUNK_ROWS, max_chunks: int = MAX_CHUNKS,
                ts: str = "timestamp", seq: str = "event_seq",
                split_ties: bool = True) -> ChunkPlan:
    """Find hot keys of ``df`` (any frame with the keys and ``ts``; it may be
    a cheaper stand-in for the rows that will be split -- the plan only
    steers where work runs, never what it computes) and place their chunk
    borders by event counts.

    ``split_ties``: a fine bucket with more than ``chunk_rows`` events all at
    one timestamp (a flood) is cut further by ``seq`` -- within one
    timestamp the order is ``seq`` alone, so the chunks stay contiguous.
    Operators whose ties have their own meaning (as-of lookups) pass False.
    """
    keys = list(keys)
    if hot_key_rows is None:
        return ChunkPlan(keys)
    stats = (df.join(F.broadcast(frequent_hashes(df, keys, hot_key_rows)), F.xxhash64(*keys) == F.col("_h"), "left_semi")
             .groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min(ts).alias("_lo"), F.max(ts).alias("_hi"))
             .where(F.col("_n") > hot_key_rows))
    # a hot key has more than hot_key_rows events, so there are at most
    # total / hot_key_rows of them; take the largest within the chunk budget
    cand = stats.orderBy(F.desc("_n")).limit(max_chunks // 2).collect()
    wanted = [max(2, -(-r["_n"] // chunk_rows)) for r in cand]
    # beyond the budget every key gets its share of it: larger chunks for all
    share = min(1.0, max_chunks / max(1, sum(wanted)))
    rows, budget = [], max_chunks
    for r, n_chunks in zip(cand, wanted):
        n_chunks = max(2, int(n_chunks * share))
        budget -= n_chunks
        n_fine = FINE * n_chunks
        width = max(1, -(-(r["_hi"] - r["_lo"] + 1) // n_fine))
        rows.append(tuple(r[k] for k in keys) + (r["_lo"], width, n_fine))
    if not rows:
        return ChunkPlan(keys)
    schema = T.StructType([df.schema[k] for k in keys] + [
        T.StructField("_lo", T.LongType()), T.StructField("_fw", T.LongType()),
        T.StructField("_nf", T.LongType())])
    spark = df.sparkSession
    hot = spark.createDataFrame(rows, schema)
    ties = split_ties and seq in df.columns
    with_f = df.join(F.broadcast(hot), keys).withColumn("_f", _fine_bucket(ts))
    bucket_aggs = [F.count(F.lit(1)).alias("_c")]
    if ties:
        bucket_aggs += [F.min(ts).alias("_tmin"), F.max(ts).alias("_tmax"),
                        F.min(seq).alias("_smin"), F.max(seq).alias("_smax")]
    counts = with_f.groupBy(*keys, "_f").agg(*bucket_aggs)
    from ..session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)  # the shared folder; set only when missing

    params = None
    if ties:
        # read twice below (flood check, chunk table): one row per fine
        # bucket, at most FINE x the chunk budget -- computed once
        counts = counts.checkpoint()
        flood = counts.where((F.col("_c") > chunk_rows) & (F.col("_tmin") == F.col("_tmax")))
        # largest floods first, within their own budget of max_chunks chunks,
        # so the lookup table stays at most FINE x 2 x max_chunks rows
        found = flood.orderBy(F.desc("_c")).limit(max_chunks).collect()
        prow, tie_budget = [], max_chunks
        for r in found:
            if tie_budget < 2:
                break
            n_tie = min(tie_budget, -(-r["_c"] // chunk_rows))
            tie_budget -= n_tie
            n_sub = FINE * n_tie
            sw = max(1, -(-(r["_smax"] - r["_smin"] + 1) // n_sub))
            prow.append(tuple(r[k] for k in keys) + (r["_f"], r["_smin"], sw, n_sub))
        if prow:
            pschema = T.StructType([df.schema[k] for k in keys] + [
                T.StructField("_f", T.LongType()), T.StructField("_smin", T.LongType()),
                T.StructField("_sw", T.LongType()), T.StructField("_ns", T.LongType())])
            params = spark.createDataFrame(prow, pschema)

    dense = hot.select(*keys, F.explode(F.sequence(F.lit(0).cast("long"), F.col("_nf") - 1)).alias("_f"))
    if params is None:
        dense = dense.withColumn("_s", F.lit(0).cast("long"))
        cnt = counts.select(*keys, "_f", F.lit(0).cast("long").alias("_s"), "_c")
    else:
        dense = (dense.join(F.broadcast(params.select(*keys, "_f", "_ns")), keys + ["_f"], "left")
                 .select(*keys, "_f", F.explode(F.sequence(F.lit(0).cast("long"),
                                                           F.coalesce(F.col("_ns"), F.lit(1)) - 1)).alias("_s")))
        sub = (with_f.join(F.broadcast(params), keys + ["_f"])
               .groupBy(*keys, "_f", _sub_bucket(seq).alias("_s")).agg(F.count(F.lit(1)).alias("_c")))
        flat = (counts.join(F.broadcast(params.select(*keys, "_f")), keys + ["_f"], "left_anti")
                .select(*keys, "_f", F.lit(0).cast("long").alias("_s"), "_c"))
        cnt = flat.unionByName(sub)
    t = dense.join(cnt, keys + ["_f", "_s"], "left")
    before = F.coalesce(F.sum(F.coalesce(F.col("_c"), F.lit(0))).over(
        Window.partitionBy(*keys).orderBy("_f", "_s").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0))
    lookup = t.select(*keys, "_f", "_s", (F.floor(before / F.lit(chunk_rows)).cast("long") + 1).alias(CHUNK))
    # bounded (see ChunkPlan); checkpointed so applying the plan does not
    # recompute the statistics
    return ChunkPlan(keys, hot, lookup.checkpoint(), max_chunks - budget, params,
                     seq if params is not None else None)


def apply_chunks(df: DataFrame, plan: ChunkPlan, ts: str = "timestamp") -> DataFrame:
    if plan.frame is None:
        return df.withColumn(CHUNK, F.lit(0).cast("long"))
    d = df.join(F.broadcast(plan.frame), plan.keys, "left")
    d = d.withColumn("_f", F.when(F.col("_fw").isNotNull(), _fine_bucket(ts)))
    if plan.params is not None:
        if plan.seq not in df.columns:
            raise ValueError(f"this chunk plan cuts ties by {plan.seq!r}, which the frame lacks")
        d = d.join(F.broadcast(plan.params), plan.keys + ["_f"], "left")
        d = d.withColumn("_s", F.when(F.col("_sw").isNotNull(), _sub_bucket(plan.seq))
                         .otherwise(F.lit(0).cast("long"))).drop("_smin", "_sw", "_ns")
    else:
        d = d.withColumn("_s", F.lit(0).cast("long"))
    d = d.join(F.broadcast(plan.lookup), plan.keys + ["_f", "_s"], "left")
    return (d.withColumn(CHUNK, F.coalesce(F.col(CHUNK), F.lit(0).cast("long")))
            .drop("_lo", "_fw", "_nf", "_f", "_s"))


def add_chunks(df: DataFrame, keys: Sequence[str], hot_key_rows: int | None = HOT_KEY_ROWS,
               chunk_rows: int = CHUNK_ROWS, max_chunks: int = MAX_CHUNKS,
               ts: str = "timestamp", plan: ChunkPlan | None = None,
               plan_from: DataFrame | None = None, split_ties: bool = True) -> tuple[DataFrame, int]:
    """Add ``_chunk``; return (frame, number of hot chunks)."""
    if plan is None:
        plan = plan_chunks(df if plan_from is None else plan_from, keys, hot_key_rows,
                           chunk_rows, max_chunks, ts, split_ties=split_ties)
    return apply_chunks(df, plan, ts), plan.chunks


def _prefix_window(keys):
    return Window.partitionBy(*keys).orderBy(CHUNK)


def running_count(df: DataFrame, keys: Sequence[str], out: str, order=("timestamp", "event_seq"),
                  **split) -> DataFrame:
    """Running number of rows per key in ``order``; hot keys split.
    ``split``: arguments of ``add_chunks``."""
    keys = list(keys)
    d, hot = add_chunks(df, keys, **split)
    w = Window.partitionBy(*keys, CHUNK).orderBy(*order)
    d = d.withColumn("_local", F.row_number().over(w).cast("long"))
    if not hot:
        return d.withColumnRenamed("_local", out).drop(CHUNK)
    sizes = (d.where(F.col(CHUNK) > 0).groupBy(*keys, CHUNK)
             .agg(F.count(F.lit(1)).alias("_size")))
    offs = sizes.select(*keys, CHUNK, F.coalesce(
        F.sum("_size").over(_prefix_window(keys).rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).cast("long").alias("_off"))
    d = d.join(F.broadcast(offs), keys + [CHUNK], "left")
    return (d.withColumn(out, F.col("_local") + F.coalesce(F.col("_off"), F.lit(0)))
            .drop("_local", "_off", CHUNK))


def running_max(df: DataFrame, keys: Sequence[str], value: str, out: str,
                order=("timestamp", "event_seq"), **split) -> DataFrame:
    """Running maximum of ``value`` per key in ``order``; hot keys split.
    ``split``: arguments of ``add_chunks``."""
    keys = list(keys)
    d, hot = add_chunks(df, keys, **split)
    w = (Window.partitionBy(*keys, CHUNK).orderBy(*order)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    d = d.withColumn("_local", F.max(value).over(w))
    if not hot:
        return d.withColumnRenamed("_local", out).drop(CHUNK)
    tops = d.where(F.col(CHUNK) > 0).groupBy(*keys, CHUNK).agg(F.max(value).alias("_top"))
    before = tops.select(*keys, CHUNK, F.max("_top").over(
        _prefix_window(keys).rowsBetween(Window.unboundedPreceding, -1)).alias("_before"))
    d = d.join(F.broadcast(before), keys + [CHUNK], "left")
    return (d.withColumn(out, F.greatest(F.col("_local"), F.col("_before")))
            .drop("_local", "_before", CHUNK))


def min_item_after(df: DataFrame, keys: Sequence[str], t: str, is_item: str, value: str,
                   out: str, items_first_at_tie: bool, plan: ChunkPlan | None = None,
                   **split) -> DataFrame:
    """For every row, the smallest ``value`` among the *item* rows
    (``is_item`` true) of the same key that come after it in time.

    At equal ``t`` an item counts as "after" unless ``items_first_at_tie``
    (then only strictly later items count).  Computed per (key, chunk) with
    a running minimum over a descending sort; the rest comes from later
    chunks through a suffix minimum over a one-row-per-hot-chunk summary.
    """
    keys = list(keys)
    if plan is None:
        d, hot = add_chunks(df, keys, ts=t, split_ties=False, **split)
    else:
        d, hot = apply_chunks(df, plan, ts=t), plan.chunks
    # descending order: at equal t the rows that are "after" come first
    tie = F.col(is_item).cast("int")
    tie = F.desc(tie) if not items_first_at_tie else F.asc(tie)
    w = (Window.partitionBy(*keys, CHUNK).orderBy(F.desc(t), tie)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    d = d.withColumn("_local", F.min(F.when(F.col(is_item), F.col(value))).over(w))
    if not hot:
        return d.withColumnRenamed("_local", out).drop(CHUNK)
    # every hot chunk (with or without items) gets the minimum of the later ones
    mins = (d.where(F.col(CHUNK) > 0).groupBy(*keys, CHUNK)
            .agg(F.min(F.when(F.col(is_item), F.col(value))).alias("_cmin")))
    later = mins.select(*keys, CHUNK, F.min("_cmin").over(
        Window.partitionBy(*keys).orderBy(F.desc(CHUNK))
        .rowsBetween(Window.unboundedPreceding, -1)).alias("_later"))
    d = d.join(F.broadcast(later), keys + [CHUNK], "left")
    return (d.withColumn(out, F.coalesce(F.col("_local"), F.col("_later")))
            .drop("_local", "_later", CHUNK))
