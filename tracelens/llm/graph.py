"""Connected components of an edge table, with joins and checkpoints only."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed


#: Edges that one task contracts; nodes that it holds at once.
TASK_EDGES = 1 << 20


def contracted(edges: DataFrame) -> DataFrame:
    """(u, v) edges that connect what ``edges`` (u, v) of each partition
    connect: every node of a partition and the smallest one it reaches there.
    A task that meets more than TASK_EDGES nodes sends them in parts."""

    def star(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        names, at = np.unique(np.r_[u, v], return_inverse=True)
        return names, names[lowest(at[:len(u)], at[len(u):], len(names))]

    def batch_of(u, v):
        return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        u = v = np.empty(0, np.int64)
        held = 0
        for batch in batches:
            u, v = np.r_[u, batch.column(0).to_numpy()], np.r_[v, batch.column(1).to_numpy()]
            if len(u) >= held + TASK_EDGES:
                u, v = star(u, v)
                held = len(u)
                if held >= TASK_EDGES:
                    yield batch_of(u, v)
                    u = v = np.empty(0, np.int64)
                    held = 0
        if len(u):
            yield batch_of(*star(u, v))

    return edges.select("u", "v").mapInArrow(run, "u long, v long")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable over undirected edges.

    Partitions first contract the edges that they hold, then again in
    partitions of about TASK_EDGES edges; where one such partition holds all,
    that is the result.  The others go on by alternating large-star and
    small-star steps.  Each step takes the minimum
    of a node's neighbours by a partial aggregate and joins it back, so a node
    with very many neighbours is never gathered in one place.  Self loops keep
    isolated nodes; null ends are ignored.  The steps end when the edge set
    no longer changes (count and hash sum).
    """
    e = edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v"))
    e = checkpointed(contracted(e.where("u IS NOT NULL AND v IS NOT NULL")))
    parts = max(1, math.ceil(e.count() / TASK_EDGES))
    e = checkpointed(contracted(e.coalesce(parts)))
    if e.rdd.getNumPartitions() <= 1 and e.count() < TASK_EDGES:
        return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    nodes = checkpointed(e.select(F.col("u").alias("node")).distinct())
    e = e.where("u > v").distinct()

    def signature(df):
        r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v") % 1_000_000_007).alias("s")).first()
        return r["n"], r["s"]

    last = signature(e)
    while last[0]:
        both = e.union(e.select("v", "u"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u > v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = (joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(joined.select("u", "m")).where("u > v").distinct())
        e = checkpointed(small)
        now = signature(e)
        if now == last:
            break
        last = now
    low = e.groupBy("u").agg(F.min("v").alias("m"))
    return (nodes.join(low, nodes["node"] == low["u"], "left")
            .select("node", F.coalesce("m", "node").alias("component")))


def lowest(p: np.ndarray, q: np.ndarray, n: int) -> np.ndarray:
    """Smallest node reachable over the edges (p, q), of each node."""
    low = np.arange(n)
    while True:
        m = np.minimum(low[p], low[q])
        new = low.copy()
        np.minimum.at(new, p, m)
        np.minimum.at(new, q, m)
        new = new[new]
        if (new == low).all():
            return low
        low = new
