"""Sharding by weighted rendezvous hashing of stable record keys.

Each (key, shard) pair has a fixed score ``-ln(u) / weight`` with ``u`` in
(0, 1] from the first 13 hex digits of ``md5("<key>:<shard>")``; the smallest
score wins.  A new shard can only win rows over from the others, so growing
from n to n+1 shards moves about 1/(n+1) of the rows, all into the new shard.
DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import checkpointed, table

#: Rows that one window partition numbers.
CELL_ROWS = 200_000


def pair_score(key: Column, shard: Column, weight: Column) -> Column:
    digits = F.substring(F.md5(F.concat(key, F.lit(":"), shard.cast("string")).cast("binary")), 1, 13)
    u = (F.conv(digits, 16, 10).cast("double") + 1) / float(1 << 52)
    return -F.log(u) / weight


def choose_shard(key: Column, weights: Sequence[float]) -> tuple[Column, Column]:
    """(score, shard) struct of the winner among shards 0 .. len(weights)-1
    (equal scores: the smaller shard) and the score function of one shard."""
    ws = F.array(*[F.lit(float(w)) for w in weights])
    scores = F.transform(F.sequence(F.lit(0), F.lit(len(weights) - 1)),
                         lambda s: F.struct(pair_score(key, s, F.element_at(ws, s + 1)).alias("score"),
                                            s.alias("shard")))
    return F.array_min(scores)


def shard_records(df: DataFrame, key_col: str, text_col: str, weights: Sequence[float],
                  grown_weight: float | None = 1.0, cell_rows: int = CELL_ROWS) -> DataFrame:
    """(key, size, text_crc32, shard, slot, grown_shard) for each row of df.

    ``size`` is the text's UTF-8 bytes plus 8 (null text: 8, its crc32 that of
    no bytes).  ``grown_shard`` is the shard after one more shard of
    ``grown_weight`` joins (None: null).  ``slot`` numbers a shard's rows from
    0 without gaps in the order of (md5 of the key, key, size, crc32); equal
    rows get different slots.  A null key counts as the key "null".  An empty
    table gives no rows.  Other columns of df are ignored.

    Slots are numbered per cell (a range of the key's md5) and shifted by the
    rows of the cells before, so no task sees a whole shard.  A cell that
    copies of one key crowd is cut further by row position.
    """
    key = F.coalesce(F.col(key_col).cast("string"), F.lit("null"))
    body = F.coalesce(F.col(text_col), F.lit(""))
    rows = df.select(F.col(key_col).alias("key"), (F.octet_length(body) + 8).cast("long").alias("size"),
                     F.crc32(body.cast("binary")).alias("text_crc32"), key.alias("_k"))
    best = choose_shard(F.col("_k"), weights)
    rows = rows.withColumn("_best", best).withColumn("shard", F.col("_best.shard"))
    if grown_weight is None:
        grown = F.lit(None).cast("int")
    else:
        new = pair_score(F.col("_k"), F.lit(len(weights)), F.lit(float(grown_weight)))
        grown = F.when(new < F.col("_best.score"), F.lit(len(weights))).otherwise(F.col("shard"))
    rows = (rows.withColumn("grown_shard", grown)
            .withColumn("_h", F.md5(F.col("_k").cast("binary")))
            .withColumn("_at", F.monotonically_increasing_id())
            .drop("_best", "_k"))
    rows = checkpointed(rows)
    n = rows.count()
    cells = max(1, min(1 << 28, -(-n // (cell_rows * len(weights)))))
    rows = rows.withColumn("_cell", F.floor(F.conv(F.substring("_h", 1, 7), 16, 10).cast("long")
                                            * cells / float(1 << 28)).cast("long"))
    per_cell = rows.groupBy("shard", "_cell").agg(F.count(F.lit(1)).alias("_n"))
    # a cell that stays crowded holds copies of one key
    cuts = per_cell.select("shard", "_cell", F.ceil(F.col("_n") / (4 * cell_rows)).alias("_cuts"))
    rows = rows.join(cuts, ["shard", "_cell"]).withColumn("_cut", F.pmod("_at", "_cuts"))
    counts = rows.groupBy("shard", "_cell", "_cut").agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy("shard").orderBy("_cell", "_cut").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select("shard", "_cell", "_cut", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inner = W.partitionBy("shard", "_cell", "_cut").orderBy("_h", "key", "size", "text_crc32", "_at")
    numbered = rows.withColumn("_i", F.row_number().over(inner) - 1)
    return (numbered.join(starts, ["shard", "_cell", "_cut"])
            .select("key", "size", "text_crc32", "shard", (F.col("_start") + F.col("_i")).cast("long").alias("slot"),
                    "grown_shard"))


SHARDS = 24


def op9_rendezvous_shards(spark, sf_dir):
    out = shard_records(table(spark, sf_dir, "documents"), "doc_id", "text", [1.0] * SHARDS)
    return out.select(F.col("key").alias("doc_id"), "size", "text_crc32", F.lit("key").alias("law"),
                      "shard", "slot", "grown_shard")
