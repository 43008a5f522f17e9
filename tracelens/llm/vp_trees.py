"""Nearest neighbours by vantage-point trees, one per shard.

Vectors of length one are compared by their chord, a metric whose order is
that of the cosine.  A tree node holds a vantage point and the range of its
distances to either half of its points.  A search skips a half when the
triangle inequality shows that it is farther than the best found so far; the
shown distance is multiplied by ``factor`` first, so a factor above one skips
more and a factor of one is exact.  Every row is indexed.  A leaf's points are
compared in single precision; all that can be among a query's k best within
its rounding are compared by their cosines in double precision and by their
ids, so no tie is lost.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import release, table
from .vectors import cosines, matrix, unit, usable

#: Least vectors of a tree (where there are as many), most points of one leaf, and
#: queries that walk a tree together.
SHARD_VECTORS, LEAF, BLOCK = 4096, 512, 8192
#: Most numbers in the vectors of one tree and in the queries of one task.
TREE_NUMBERS, ASK_NUMBERS = 1 << 22, 1 << 23
#: Trees for each core, for even work.
TREES_A_CORE = 2
#: Pairs whose cosines are computed at once, queries of one product with a leaf, and
#: vectors that are copied at once.
PAIRS, TILE, PART = 1 << 16, 1024, 8192


def build_tree(x: np.ndarray, seed: int = 1) -> dict[str, np.ndarray]:
    """Arrays of a vantage-point tree over distinct unit rows.  Node i has
    points order[begin[i]:end[i]], children left[i] and right[i] (-1: leaf),
    the vantage point vantage[i] and its distances to either child's points as
    ranges.  points: the rows in that order, in single precision."""
    rng = np.random.default_rng(seed)
    order = np.arange(len(x))
    begin, end, left, right, vantage, spans = [0], [len(x)], [-1], [-1], [-1], [[0.0] * 4]
    todo = [0]
    while todo:
        i = todo.pop()
        a, b = begin[i], end[i]
        if b - a <= LEAF:
            continue
        vantage[i] = order[a + int(rng.integers(b - a))]
        d = np.concatenate([chords(x[vantage[i]][None], x[order[j:min(b, j + PART)]])[0] for j in range(a, b, PART)])
        sort = np.argsort(d, kind="stable")
        order[a:b] = order[a:b][sort]
        d = d[sort]
        half = len(d) // 2
        spans[i] = [d[0], d[half - 1], d[half], d[-1]]
        for lo, hi, side in ((a, a + half, left), (a + half, b, right)):
            side[i] = len(begin)
            todo.append(len(begin))
            begin.append(lo)
            end.append(hi)
            left.append(-1)
            right.append(-1)
            vantage.append(-1)
            spans.append([0.0] * 4)
    points = np.empty(x.shape, np.float32)
    for i in range(0, len(x), PART):
        points[i:i + PART] = x[order[i:i + PART]]
    return {"x": x, "order": order, "points": points, "begin": np.array(begin), "end": np.array(end), "left": np.array(left),
            "right": np.array(right), "vantage": np.array(vantage), "spans": np.array(spans)}


def chords(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, 2 - 2 * (q @ x.T)))


def cosine_rounding(dims: int, dtype: type = np.float64) -> float:
    """No cosine of two unit vectors, rounded to ``dtype`` and multiplied in
    it, is farther than this from its true value."""
    return 2 * float(np.finfo(dtype).eps) * (dims + 8)


def rounding(dims: int) -> float:
    """No chord of two unit vectors is computed farther than this from its
    true length (the square root of the error of its square)."""
    return math.sqrt(2 * cosine_rounding(dims))


def walk(tree: dict, q: np.ndarray, limit: Callable[[np.ndarray], np.ndarray],
         see: Callable[[np.ndarray, int, int], None], factor: float) -> None:
    """Show ``see`` (query rows, begin, end) of every leaf that can hold points
    within ``limit`` of a unit query row.  Each query goes down its nearer
    halves first, for a limit; then all queries walk down together, and a half
    is entered by those that cannot skip it."""
    x = tree["x"]
    slack = 4 * rounding(x.shape[1]) if len(x) else 0.0
    home = np.full(len(q), -1)

    def sides(i, rows):
        """The rows' distances to the vantage point; the node's halves."""
        lo1, hi1, lo2, hi2 = tree["spans"][i]
        return (chords(q[rows], x[tree["vantage"][i]][None])[:, 0],
                ((tree["left"][i], lo1, hi1), (tree["right"][i], lo2, hi2)))

    def show(i, rows):
        if len(rows):
            see(rows, int(tree["begin"][i]), int(tree["end"][i]))

    def descend(i, rows):
        if tree["left"][i] < 0:
            home[rows] = i
            show(i, rows)
            return
        d, ((left, _, hi), (right, lo, _)) = sides(i, rows)
        nearer = d <= (hi + lo) / 2
        for child, go in ((left, nearer), (right, ~nearer)):
            if go.any():
                descend(child, rows[go])

    def visit(i, rows):
        if tree["left"][i] < 0:
            show(i, rows[home[rows] != i])
            return
        d, halves = sides(i, rows)
        for child, lo, hi in halves:
            away = np.maximum(0, np.maximum(lo - d, d - hi))
            go = away * factor <= limit(rows) + slack
            if go.any():
                visit(child, rows[go])

    if len(q) and len(x):
        descend(0, np.arange(len(q)))
        visit(0, np.arange(len(q)))


def ranked(tree: dict, ask: np.ndarray, q: np.ndarray, k: int,
           factor: float = 1.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, id, cosine) of the k nearest ids of each query, its own id
    left out, ties to the smaller id.  ``tree`` holds the original vectors and
    the ids that share each."""
    x, order, points, original = tree["x"], tree["order"], tree["points"], tree["original"]
    asked = unit(q)
    single = asked.astype(np.float32)
    near, names = np.full((len(ask), k), -np.inf), np.zeros((len(ask), k), np.int64)
    owned = np.searchsorted(tree["owner"], np.arange(len(x) + 1))

    def floor(rows, dtype):
        """What a cosine computed in ``dtype`` has at least, if its pair can
        be among the k best."""
        least = (near[rows, -1] - 2 * cosine_rounding(q.shape[1], dtype)).astype(dtype)
        return np.nextafter(least, dtype(-np.inf))

    def offer(rows, p):
        """Rank original vectors p for query rows."""
        score = cosines(q[rows], original[p])
        good = score >= near[rows, -1]
        rows, p, score = rows[good], p[good], score[good]
        # each vector stands for its ids
        n = owned[p + 1] - owned[p]
        who, score = np.repeat(rows, n), np.repeat(score, n)
        ids = tree["ids"][np.repeat(owned[p] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        other = (ids != ask[who]) & ((score > near[who, -1]) | (ids < names[who, -1]))
        changed = np.unique(who[other])
        had, place = np.nonzero(near[changed] > -np.inf)
        who, ids, score = (np.concatenate(c) for c in (
            (who[other], changed[had]), (ids[other], names[changed[had], place]),
            (score[other], near[changed[had], place])))
        # an id of several vectors counts once, by its nearest
        sort = np.lexsort((-score, ids, who))
        who, ids, score = who[sort], ids[sort], score[sort]
        new = np.ones(len(who), bool)
        new[1:] = (who[1:] != who[:-1]) | (ids[1:] != ids[:-1])
        who, ids, score = who[new], ids[new], score[new]
        sort = np.lexsort((ids, -score, who))
        who, ids, score = who[sort], ids[sort], score[sort]
        place = np.arange(len(who)) - np.searchsorted(who, who)
        best = place < k
        near[who[best], place[best]] = score[best]
        names[who[best], place[best]] = ids[best]

    def hits(c, least, most):
        """Rows and columns of the cosines that reach their row's least;
        none if there are more than ``most``."""
        row = np.flatnonzero(c.max(axis=1) >= least)
        reach = c[row] >= least[row, None]
        if np.count_nonzero(reach) > most:
            return None
        at, col = np.divmod(np.flatnonzero(reach), c.shape[1])
        return row[at], col

    def see(rows, a, b):
        held, many = [], 0

        def rank_held():
            at, p = (np.concatenate(h) for h in zip(*held))
            for j in range(0, len(at), PAIRS):
                offer(at[j:j + PAIRS], order[a + p[j:j + PAIRS]])

        for i in range(0, len(rows), TILE):
            some = rows[i:i + TILE]
            c = single[some] @ points[a:b].T
            # queries with fewer than k so far: their nearest of the leaf first, for a limit
            few, depth = np.flatnonzero(near[some, -1] == -np.inf), k + 1
            while len(few) and depth < b - a:
                top = np.argpartition(c[few], b - a - depth, axis=1)[:, b - a - depth:]
                row, p = np.repeat(few, depth), top.ravel()
                for j in range(0, len(row), PAIRS):
                    offer(some[row[j:j + PAIRS]], order[a + p[j:j + PAIRS]])
                c[row, p] = -np.inf  # done
                # ids repeated over vectors left fewer than k: look deeper
                few, depth = few[near[some[few], -1] == -np.inf], 2 * depth
            found = hits(c, floor(some, np.float32), c.size // 16)
            if found is None:  # too close for single precision
                found = hits(asked[some] @ x[order[a:b]].T, floor(some, np.float64), c.size)
            row, p = found
            held.append((some[row], p))
            many += len(row)
            if many > PAIRS or i + TILE >= len(rows):
                rank_held()
                held, many = [], 0

    walk(tree, asked, lambda rows: np.sqrt(np.maximum(0, 2 - 2 * near[rows, -1])), see, factor)
    row, place = np.nonzero(near > -np.inf)
    return row, names[row, place], near[row, place]


def shard_tree(ids: np.ndarray, x: np.ndarray, k: int) -> dict[str, np.ndarray]:
    """Tree over the distinct rows of x with the k + 1 smallest ids of each."""
    first, same = np.unique(x, axis=0, return_index=True, return_inverse=True)[1:]
    original, same = x[first], same.ravel()
    del x
    one = np.empty_like(original)
    for i in range(0, len(one), PART):
        one[i:i + PART] = unit(original[i:i + PART])
    sort = np.lexsort((ids, same))
    same, ids = same[sort], ids[sort]
    new = np.ones(len(ids), bool)
    new[1:] = (same[1:] != same[:-1]) | (ids[1:] != ids[:-1])
    same, ids = same[new], ids[new]
    keep = np.arange(len(same)) - np.searchsorted(same, same) <= k
    return {"original": original, "ids": ids[keep], "owner": same[keep], **build_tree(one)}


def layout(rows: int, numbers: int, asked: int, cores: int, shard_vectors: int = SHARD_VECTORS) -> tuple[int, int]:
    """Trees for a table of so many rows and numbers in their vectors, and
    blocks of queries for so many numbers in theirs."""
    return (max(1, math.ceil(numbers / TREE_NUMBERS), min(math.ceil(rows / shard_vectors), TREES_A_CORE * cores)),
            max(1, math.ceil(asked / ASK_NUMBERS)))


def nearest(df: DataFrame, id_col: str, vector_col: str, queries: Column, k: int = 5, factor: float = 1.0,
            shard_vectors: int = SHARD_VECTORS) -> DataFrame:
    """(query_id, rank, id, score): the k rows of largest cosine to each row
    that ``queries`` marks, the row itself left out, ties to the smaller id.

    Vectors that are null, empty, zero or hold null or non-finite components
    take no part, as queries or as neighbours; only vectors of equal length
    are compared.  A query with fewer neighbours has fewer rows.  Rows that
    repeat an id: the id is one point of each of its distinct vectors, never
    its own neighbour.  A null id takes no part.  Equal vectors count once in
    a tree with their k + 1 smallest ids.  An empty table gives no rows.

    A task has one tree and the queries that walk it.  Trees grow with the
    table up to ``TREE_NUMBERS``, so that queries are sent to few of them.
    """
    def part(rows):
        return (rows.where(F.col(id_col).isNotNull()).where(usable(vector_col))
                .select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"), F.size(vector_col).alias("length")))

    numbers = F.greatest(F.size(vector_col), F.lit(0)).cast("long")
    n = df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(numbers), F.lit(0)).alias("numbers"),
               F.coalesce(F.sum(F.when(queries, numbers)), F.lit(0)).alias("asked")).first()
    shards, blocks = layout(n["rows"], n["numbers"], n["asked"], df.sparkSession.sparkContext.defaultParallelism,
                            shard_vectors)

    def search(points: pa.Table, asks: pa.Table) -> pa.Table:
        found = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
        if len(points) and len(asks):
            tree = shard_tree(points["id"].to_numpy(), matrix(points["v"]), k)
            for i in range(0, len(asks), BLOCK):
                some = asks.slice(i, BLOCK)
                ask = some["id"].to_numpy()
                who, ids, score = ranked(tree, ask, matrix(some["v"]), k, factor)
                found.append((ask[who], ids, score))
            del tree
            release()
        return pa.table([np.concatenate(c) for c in zip(*found)], ["query_id", "id", "score"])

    def all_of(count):
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    def one_of(count, seed):
        return F.pmod(F.xxhash64("id", "v", F.lit(seed)), F.lit(count)).cast("int")

    # so many partitions that few hold two cells
    cell, tasks = ["length", "shard", "block"], 4 * shards * blocks
    # a row that repeats meets its copies in its shard
    points = (part(df).select("id", "v", "length", one_of(shards, 0).alias("shard"), all_of(blocks).alias("block"))
              .repartition(tasks, *cell).distinct())
    asks = (part(df.where(queries)).distinct()
            .select("id", "v", "length", one_of(blocks, 1).alias("block"), all_of(shards).alias("shard"))
            .repartition(tasks, *cell))
    found = (points.groupBy(*cell).cogroup(asks.groupBy(*cell))
             .applyInArrow(search, "query_id long, id long, score double")
             .groupBy("query_id", "id").agg(F.max("score").alias("score")))
    best = W.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "id", "score")


def op10_vp_trees(spark, sf_dir):
    out = nearest(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", F.col("vec_id") % 50 == 0)
    return out.select("query_id", "rank", F.col("id").alias("vec_id"), "score")
