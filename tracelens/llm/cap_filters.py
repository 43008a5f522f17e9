"""Near-duplicate embeddings by spherical-cap filters.

Filter directions are the words of random product codes: a vector, rotated
at random, is cut in two halves, each half has a small set of Gaussian code
words, and every pair of them is a direction.  A vector is decoded to all
directions whose inner product with it exceeds a threshold; vectors that meet
in a direction are verified.  Number of directions and threshold follow from
the number of vectors, so that a pair at the similarity bound is expected to
share ``COMMON`` directions and the work per vector is least.

Vectors and directions are rounded to grids on which their inner products are
exact in double precision, so a vector exceeds the same directions in every
matrix it is decoded in, and a pair's first shared direction is one direction.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, table
from .graph import components, lowest
from .vectors import cosines, matrix, unit, usable

SIMILARITY = 0.93
#: Expected directions that a pair at the bound shares.
COMMON = 40
#: Vectors of one block of a crowded direction.
BLOCK = 1024
#: Step to which unit vectors and directions are rounded before they are multiplied.
GRID = 2.0 ** -18
#: Seconds that a direction of one label costs as a group, a vector in it, and a pair of vectors.
GROUP_S, ROW_S, PAIR_S = 2.5e-3, 20e-6, 2e-8


def tail(t: float) -> float:
    return 0.5 * math.erfc(t / math.sqrt(2))


def filter_plan(n: int, similarity: float, common: int = COMMON) -> tuple[int, float]:
    """(code words per half, threshold) for n vectors that may meet."""
    best = None
    for t in np.arange(0.4, 5, 0.1):
        x = t + (np.arange(400) + 0.5) * 0.015
        miss = np.array([tail((t - similarity * v) / math.sqrt(1 - similarity ** 2)) for v in x])
        both = float((np.exp(-x * x / 2) / math.sqrt(2 * math.pi) * miss * 0.015).sum())
        words = math.ceil(math.sqrt(common / both))
        met = words ** 2 * tail(t)
        cost = met * (ROW_S + n * tail(t) * PAIR_S) + GROUP_S * words ** 2 / max(n, 1)
        if best is None or cost < best[0]:
            best = cost, words, float(t)
    return best[1], best[2]


@functools.lru_cache(maxsize=16)
def code(length: int, words: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """(length, words) code words of either half, rotated back to the vectors'
    axes and rounded to GRID."""
    rng = np.random.default_rng([seed, length])
    rotation, _ = np.linalg.qr(rng.normal(size=(length, length)))
    half = length // 2
    first, second = rng.normal(size=(words, half)), rng.normal(size=(words, length - half))
    return (np.rint(rotation[:, :half] @ first.T / GRID) * GRID,
            np.rint(rotation[:, half:] @ second.T / GRID) * GRID)


def decode(x: np.ndarray, words: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, direction) of every direction that a unit row exceeds, ascending.

    A row's list is made from the few code words of either half that can reach
    the threshold with the best word of the other.  Products are whole
    multiples of GRID squared and sums stay far below 2 ** 53 of them, so no
    order of summation changes a bit.
    """
    first, second = code(x.shape[1], words)
    x = np.rint(x / GRID) * GRID
    a, b = x @ first, x @ second
    some_a = a > threshold - 1e-9 - b.max(axis=1, keepdims=True)
    some_b = b > threshold - 1e-9 - a.max(axis=1, keepdims=True)
    rows, ways = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for r in np.flatnonzero(some_a.any(axis=1) & some_b.any(axis=1)):
        i, j = np.flatnonzero(some_a[r]), np.flatnonzero(some_b[r])
        over = np.nonzero(a[r, i][:, None] + b[r, j][None, :] > threshold)
        ways.append(i[over[0]] * words + j[over[1]])
        rows.append(np.full(len(over[0]), r))
    return np.concatenate(rows), np.concatenate(ways)


def meet_earlier(x: np.ndarray, p: np.ndarray, q: np.ndarray, way: int, words: int, threshold: float) -> np.ndarray:
    """True for each pair of unit rows (p, q) that shares a direction before way."""
    ends, at = np.unique(np.concatenate([p, q]), return_inverse=True)
    row, seen = decode(x[ends], words, threshold)
    row, seen = row[seen < way], seen[seen < way]
    _, place, times = np.unique(seen, return_inverse=True, return_counts=True)
    column = np.cumsum(times > 1) - 1  # a direction of one row is shared by none
    twice = times[place] > 1
    bits = np.zeros((len(ends), int((times > 1).sum())), bool)
    bits[row[twice], column[place[twice]]] = True
    bits = np.packbits(bits, axis=1)
    return (bits[at[:len(p)]] & bits[at[len(p):]]).any(axis=1)


def linked_vectors(df: DataFrame, id_col: str, vector_col: str, label_col: str, similarity: float = SIMILARITY,
                   common: int = COMMON, block: int = BLOCK) -> DataFrame:
    """(id, n_links, component_id, kept) of each row of df.

    Vectors of equal label are linked when their cosine, in double precision,
    is at least ``similarity``.  A vector that is null, empty, zero or holds
    null or non-finite components, or whose label is null, links with
    nothing; nor do vectors of different lengths.  Rows that repeat an id
    count as vectors of their own.  A null id counts as a link but names no
    component unless all of the component's are null.  An empty table gives
    no rows.

    Equal vectors of a label are one vector with a weight.  A pair is counted
    in the first direction it shares; a crowded direction is cut in blocks
    that meet pairwise, and pairs are only counted, never written out.
    """
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"), F.col(label_col).alias("label"),
                     (usable(vector_col) & F.col(label_col).isNotNull()).alias("ok"))
    distinct = rows.where("ok").groupBy("label", "v").agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("copies"))
    reps = checkpointed(distinct.withColumn("rep", F.monotonically_increasing_id()))
    most = reps.groupBy("label", F.size("v")).count().agg(F.max("count")).first()[0] or 1
    words, threshold = filter_plan(int(most), similarity, common)

    def emit(batches):
        for b in batches:
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                lists, sizes = part.column(1), part.column(1).value_lengths().to_numpy()
                for size in np.unique(sizes):
                    pick = np.flatnonzero(sizes == size)
                    at, way = decode(unit(matrix(lists.take(pa.array(pick)))), words, threshold)
                    take = pa.array(pick[at])
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).take(take), lists.take(take), part.column(2).take(take),
                         part.column(3).take(take), pa.array(way.astype(np.int32)),
                         pa.array(np.full(len(at), size, np.int32))],
                        ["rep", "v", "label", "copies", "way", "length"])

    kind = reps.schema["v"].dataType.simpleString()
    mark = reps.schema["label"].dataType.simpleString()
    met = reps.select("rep", "v", "label", "copies").mapInArrow(
        emit, f"rep long, v {kind}, label {mark}, copies long, way int, length int")
    keys = ["label", "length", "way"]
    sizes = (met.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
             .withColumn("blocks", F.ceil(F.col("n") / block).cast("int")))
    dealt = met.join(sizes, keys).withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumn("x", F.least("own", "other")).withColumn("y", F.greatest("own", "other"))

    def meet(key, t):
        way, same = key[2].as_py(), key[3].as_py() == key[4].as_py()
        rep, copies = t["rep"].to_numpy(), t["copies"].to_numpy()
        x = matrix(t["v"])
        u = unit(x)
        mine = np.flatnonzero(t["own"].to_numpy() == key[3].as_py())
        theirs = mine if same else np.flatnonzero(t["own"].to_numpy() == key[4].as_py())
        links, low = np.zeros(len(rep), np.int64), np.arange(len(rep))
        found = []
        for a in range(0, len(mine), 256):
            part = mine[a:a + 256]
            i, j = np.nonzero(u[part] @ u[theirs].T >= similarity - 1e-9)
            i, j = part[i], theirs[j]
            if same:
                i, j = i[i < j], j[i < j]
            for s in range(0, len(i), 100_000):
                p, q = i[s:s + 100_000], j[s:s + 100_000]
                ok = cosines(x[p], x[q]) >= similarity
                p, q = p[ok], q[ok]
                if way and len(p):
                    new = ~meet_earlier(u, p, q, way, words, threshold)
                    p, q = p[new], q[new]
                links += np.bincount(p, copies[q], len(rep)).astype(np.int64)
                links += np.bincount(q, copies[p], len(rep)).astype(np.int64)
                if len(p):
                    found.append(spanning(p, q, len(rep)))
        if found:
            p, q = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
            low = lowest(p, q, len(rep))
        has = np.flatnonzero(links > 0)
        return pa.table({"rep": pa.array(rep[has]), "links": pa.array(links[has]), "to": pa.array(rep[low[has]])})

    some = checkpointed(dealt.select("rep", "v", "copies", *keys, "own", "x", "y").groupBy(*keys, "x", "y").applyInArrow(
        meet, "rep long, links long, to long"))
    edges = some.select(F.col("rep").alias("a"), F.col("to").alias("b")).distinct()
    parts = components(edges).withColumnRenamed("node", "rep")
    per = reps.join(some.groupBy("rep").agg(F.sum("links").alias("links")), "rep", "left")
    per = checkpointed(per.join(parts, "rep", "left").select(
        "rep", "label", "v", "low", "copies", F.coalesce("links", F.lit(0)).alias("links"),
        F.coalesce("component", "rep").alias("component")))
    lows = per.groupBy("component").agg(F.min("low").alias("component_id"))
    per = per.join(lows, "component").select("label", "v", (F.col("links") + F.col("copies") - 1).alias("n_links"),
                                             "component_id")
    out = rows.join(per, ["label", "v"], "left")
    out = out.withColumn("n_links", F.when(F.col("ok"), F.coalesce("n_links", F.lit(0))).otherwise(F.lit(0)).cast("long"))
    out = out.withColumn("component_id", F.when(F.col("ok"), F.coalesce("component_id", "id")).otherwise(F.col("id")))
    return out.select("id", "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def spanning(p: np.ndarray, q: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """At most n edges that connect what the edges (p, q) connect."""
    low = lowest(p, q, n)
    own = np.flatnonzero(low != np.arange(n))
    return own, low[own]


def op4_cap_filters(spark, sf_dir):
    out = linked_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label")
    return out.withColumnRenamed("id", "vec_id")
