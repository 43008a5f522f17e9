"""op10: a task searches one tree for all queries, with the same results."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracelens.llm import vp_trees
from tracelens.llm.vectors import cosines, unit

VECTORS = "id long, v array<float>, asks boolean"


@pytest.fixture(scope="module")
def spark():
    from tracelens.session import local_session

    return local_session(cores="*", shuffle_partitions=8)


def brute(ids, x, ask, q, k):
    """(id, score) of the k nearest of one query."""
    best = {}
    for i, c in zip(ids.tolist(), cosines(np.repeat(q[None], len(x), axis=0), x).tolist()):
        if i != ask:
            best[i] = max(c, best.get(i, -2.0))
    return sorted(best.items(), key=lambda e: (-e[1], e[0]))[:k]


def mixed_vectors(rng, n, dims):
    """Loose vectors, a tight group, rescaled and equal copies, neighbours in
    the last place of single precision."""
    x = rng.normal(size=(n, dims)).astype(np.float32)
    x[n // 2:] = (x[0] + 0.01 * rng.normal(size=(n - n // 2, dims))).astype(np.float32)
    x[n // 8:n // 4] = x[1] * rng.uniform(0.1, 9, (n // 4 - n // 8, 1)).astype(np.float32)
    x[n // 4:n // 3] = x[2]
    near = np.arange(n // 3, n // 2 - 10)
    x[near] = x[3]
    x[near, near % dims] = np.nextafter(x[near, near % dims], np.float32(9))
    return x.astype(np.float64)


def test_ranked_is_exact_at_any_block(monkeypatch):
    rng = np.random.default_rng(5)
    for leaf, tile, pairs, repeated in ((8, 16, 32, 1), (512, 1024, 1 << 16, 1), (32, 1024, 64, 9), (3, 7, 1, 40)):
        monkeypatch.setattr(vp_trees, "LEAF", leaf)
        monkeypatch.setattr(vp_trees, "TILE", tile)
        monkeypatch.setattr(vp_trees, "PAIRS", pairs)
        x = mixed_vectors(rng, 400, 12)
        ids = rng.permutation(400) // repeated - 20
        tree = vp_trees.shard_tree(ids, x, 5)
        assert len(tree["original"]) < 400 and len(tree["order"]) == len(tree["original"])
        ask = rng.permutation(400)[:60]
        who, got, score = vp_trees.ranked(tree, ids[ask], x[ask], 5)
        for r, a in enumerate(ask):
            assert list(zip(got[who == r].tolist(), score[who == r].tolist())) == brute(ids, x, ids[a], x[a], 5)


def test_walk_shows_each_leaf_to_all_queries_together():
    """No leaf is shown more than twice, whatever the number of queries, and no
    query sees a leaf twice; halves out of reach are skipped."""
    rng = np.random.default_rng(6)
    centres = unit(rng.normal(size=(40, 24)))
    x = unit(centres[rng.integers(0, 40, 6000)] + 0.02 * rng.normal(size=(6000, 24)))
    tree = vp_trees.build_tree(x)
    q, seen = x[:2000], []
    limit = np.full(2000, 0.05)
    vp_trees.walk(tree, q, lambda rows: limit[rows], lambda rows, a, b: seen.append((a, b, rows)), 1.0)
    leaves = int((tree["left"] < 0).sum())
    assert leaves >= 6000 / vp_trees.LEAF and len(seen) <= 2 * leaves
    shown = np.zeros((2000, 6000), np.int8)
    for a, b, rows in seen:
        shown[np.ix_(rows, tree["order"][a:b])] += 1
    assert shown.max() == 1
    assert shown[vp_trees.chords(q, x) <= 0.05].all()
    assert shown.mean() < 0.5


def test_trees_grow_with_the_table():
    """360 times sf0.1: queries go to a few trees for each core, not to one
    for each 4,096 vectors; a tree and a block of queries stay in bounds."""
    assert vp_trees.layout(0, 0, 0, 8) == (1, 1)
    assert vp_trees.layout(51_282, 51_282 * 64, 1_026 * 64, 6) == (12, 1)
    assert vp_trees.layout(717_948, 717_948 * 64, 14_364 * 64, 6) == (12, 1)
    for rows, dims, cores in ((10**8, 64, 6), (10**6, 1536, 6), (10**6, 3, 2000)):
        trees, blocks = vp_trees.layout(rows, rows * dims, rows // 50 * dims, cores)
        assert rows * dims / trees <= vp_trees.TREE_NUMBERS and rows // 50 * dims / blocks <= vp_trees.ASK_NUMBERS
        assert trees <= max(vp_trees.TREES_A_CORE * cores, math.ceil(rows * dims / vp_trees.TREE_NUMBERS))


def test_trees_are_not_sent_to_each_block(spark):
    df = spark.createDataFrame([(i, [1.0, float(i)], True) for i in range(40)], VECTORS)
    plan = vp_trees.nearest(df, "id", "v", F.col("asks"))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "CoGroup" in plan


def test_nearest_over_trees_and_blocks(spark, monkeypatch):
    rng = np.random.default_rng(7)
    x = mixed_vectors(rng, 600, 12)
    ids = np.where(np.arange(600) < 500, np.arange(600), np.arange(600) - 350)  # some ids have two vectors
    asks = rng.random(600) < 0.2
    rows = [(int(i), v, bool(a)) for i, v, a in zip(ids, x.tolist(), asks)]
    rows += [rows[5]] * 30 + [(None, [1.0] * 12, True), (7000, [0.0] * 12, True), (7001, [1.0, 2.0], True)]
    df = spark.createDataFrame(rows, VECTORS).repartition(5)
    want = {}
    for i, v in zip(ids[asks].tolist(), x[asks]):
        for j, c in brute(ids, x, i, v, 5):
            want.setdefault(i, {})[j] = max(c, want.get(i, {}).get(j, -2.0))
    want = {i: sorted(e.items(), key=lambda e: (-e[1], e[0]))[:5] for i, e in want.items()}
    for trees, asked in ((1 << 22, 1 << 23), (900, 300), (2000, 1 << 23)):
        monkeypatch.setattr(vp_trees, "TREE_NUMBERS", trees)
        monkeypatch.setattr(vp_trees, "ASK_NUMBERS", asked)
        got = {}
        for r in vp_trees.nearest(df, "id", "v", F.col("asks")).orderBy("query_id", "rank").collect():
            got.setdefault(r["query_id"], []).append((r["id"], r["score"]))
        assert got == want


def test_row_that_asks_in_one_copy_only(spark):
    """A row and its copy that does not ask are one neighbour."""
    rows = [(i, [1.0, 2.0], a) for i in (1, 2) for a in (True, False)] + [(3, [1.0, 2.0], False), (4, [2.0, 1.0], False)]
    out = vp_trees.nearest(spark.createDataFrame(rows, VECTORS), "id", "v", F.col("asks"), k=2).orderBy("query_id", "rank")
    assert [(r["query_id"], r["id"]) for r in out.collect()] == [(1, 2), (1, 3), (2, 1), (2, 3)]
