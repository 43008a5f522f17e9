"""Whole-job fixes of the llm operators: growth, verification, equal rows."""

import collections
import hashlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def docs_of(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_prefixes_stay_as_input_grows():
    """Nearly all windows of 30 GB of skewed words are dealt by a prefix."""
    from tracelens.llm import suffix_repeats as S

    paths = 5_000_000_000
    cells = S.cell_count(30 * 10**9, S.GROUP_PATHS)
    rng = np.random.default_rng(0)
    counts = np.stack([np.bincount(rng.integers(0, cells, n), paths / n * 2 * rng.random(n), cells).astype(np.int64)
                       for n in (20_000, 200_000, 2_000_000, 4_000_000)])
    plan, groups = S.assign_groups(counts, S.GROUP_PATHS)
    assert cells >= 4 * groups
    assert (plan[-1] >= 0)[counts[-1] > 0].mean() > 0.99


def test_hits_are_verified():
    """A path whose fingerprint is known but whose second hash is not stays."""
    from tracelens.llm import suffix_repeats as S
    from tracelens.llm.common import pack

    texts = pa.array([" ".join(f"a{i}" for i in range(13)), " ".join(f"b{i}" for i in range(13))])
    _, _, paths, _, start = S.path_hashes(texts, 13)
    checks = S.check_hashes(texts, 13)[start]
    order = np.argsort(paths)
    for wrong in (0, 1):
        c = checks.copy()
        c[wrong] ^= np.uint64(1)
        # the wrong one stands before the right one of the same path
        p, c = np.r_[paths, paths[wrong]], np.r_[checks, c[wrong]]
        c[wrong] = c[wrong] ^ np.uint64(2)
        hits = pa.table({"paths": [pack(p)[:S.PATH_BYTES * 3]], "checks": [pack(c)], "low": [S.pack_ids(np.array([5, 5, 5]))]})
        gone, _ = S.covered_words(texts, np.array([7, 7]), hits, 13)
        assert gone[13 * wrong:13 * wrong + 13].sum() == 0 and gone.sum() == 13
    assert len(order) == 2


def test_repeats_by_every_prefix_length(spark):
    """Groups of very few paths, so that all prefix lengths and the whole
    depth are used, against brute force."""
    from tracelens.llm.suffix_repeats import kept_digest, remove_repeats

    rng = np.random.default_rng(4)
    pool = [" ".join(f"w{x}" for x in rng.integers(0, 9, 40)) for _ in range(12)]
    texts = [" ".join(pool[int(i)] for i in rng.integers(0, 12, 3)) + f" e{k} " + "same " * 30 for k in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    seen = {}
    for i, t in enumerate(texts):
        w = t.split()
        for k in range(len(w) - 12):
            seen.setdefault(tuple(w[k:k + 13]), i)
    want = {}
    for i, t in enumerate(texts):
        w = t.split()
        gone = [False] * len(w)
        for k in range(len(w) - 12):
            if seen[tuple(w[k:k + 13])] < i:
                gone[k:k + 13] = [True] * 13
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        want[i] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    got = kept_digest(remove_repeats(df, "doc_id", "text", group_paths=5)).collect()
    assert {r["id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got} == want


def test_language_model_learns_from_all_documents(spark):
    """What the first documents (by hash) do not hold is learned too."""
    from tracelens.llm.gru_lm import score_documents

    first = [r["id"] for r in spark.range(200).orderBy(F.xxhash64("id"), "id").limit(2).collect()]
    names, rng = [f"w{k}q" for k in range(8)], np.random.default_rng(2)
    rows = [(i, " ".join(rng.choice(names, 300) if i in first else [names[(i + k) % 8] for k in range(300)])) for i in range(200)]
    df = spark.createDataFrame(rows + [(999, rows[next(i for i in range(200) if i not in first)][1])], "id long, text string")
    got = score_documents(df, "id", "text", F.col("id") != 999, train_docs=2).where("id = 999").first()
    assert got["score"] > 0.6 * got["base_score"]


def test_long_training_texts_are_cut_not_skipped(spark, monkeypatch):
    from tracelens.llm import gru_lm as G

    monkeypatch.setattr(G, "TRAIN_WORDS", 100)
    df = spark.createDataFrame([(1, "a " * 500, True), (2, "b " * 10, True), (3, "c " * 500, True)], "id long, text string, train boolean")
    assert [(len(h), whole) for h, _, whole in G.training_sample(df, 500)] == [(45, False), (10, True), (45, False)]
    seq, marks = G.with_ends(np.full(1000, 5), np.array([0, 990, 1000]))
    seen, fresh, target = G.stream_lanes(seq, marks, 256)
    assert (target >= 0).sum() == 1002 and fresh.sum() == 2


def test_pair_marginals_match_enumeration():
    """Expected label pairs against all label sequences of short chains."""
    import itertools

    from tracelens.llm.crf_langid import chain_marginals

    rng = np.random.default_rng(5)
    for n in (1, 2, 6):
        e, trans = rng.random((n, 3)) + 0.05, rng.random((3, 3)) + 0.05
        starts = np.zeros(n, bool)
        starts[0] = True
        want = np.zeros((n - 1, 3, 3))
        whole = 0.0
        for ys in itertools.product(range(3), repeat=n):
            w = np.prod([e[t, y] for t, y in enumerate(ys)]) * np.prod([trans[a, b] for a, b in zip(ys, ys[1:])])
            whole += w
            for t, (a, b) in enumerate(zip(ys, ys[1:])):
                want[t, a, b] += w
        p, got = chain_marginals(e, starts, trans, pairs=True)
        assert np.allclose(got, want / whole)
        assert np.allclose(p, chain_marginals(e, starts, trans))


def test_word_runs_cover_the_whole_text():
    from tracelens.llm.crf_langid import word_runs

    rng = np.random.default_rng(2)
    words = [str(i) for i in range(10_000)]
    short = word_runs(words[:120], 150, rng)
    assert [w for r in short for w in r] == words[:120]
    runs = word_runs(words, 150, rng)
    assert sum(map(len, runs)) == 150 and any(int(r[0]) > 5000 for r in runs)
    assert all(int(r[-1]) - int(r[0]) == len(r) - 1 for r in runs)
    assert word_runs([], 150, rng) == []


def test_vp_ties_among_rescaled_copies(spark):
    """Rescaled copies of one vector tie, up to rounding, at any number of them."""
    from tracelens.llm.vectors import cosines
    from tracelens.llm.vp_trees import build_tree, nearest, ranked
    from tracelens.llm.vectors import unit

    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 16)).astype(np.float32)
    copies = rng.permutation(3000)[:400]
    x[copies] = (x[copies[0]] * rng.uniform(0.1, 9, 400).astype(np.float32)[:, None]).astype(np.float32)
    x = x.astype(np.float64)
    ids = rng.permutation(3000)
    _, first, same = np.unique(x, axis=0, return_index=True, return_inverse=True)
    owner = np.sort(same.ravel())
    tree = {**build_tree(unit(x[first])), "original": x[first], "owner": owner,
            "ids": ids[np.argsort(same.ravel(), kind="stable")]}
    ask = np.concatenate([copies[:8], rng.permutation(3000)[:40]])
    who, got, score = ranked(tree, ids[ask], x[ask], 5)
    for r, a in enumerate(ask):
        c = cosines(np.repeat(x[a][None], 3000, axis=0), x)
        order = [i for i in np.lexsort((ids, -c)) if i != a][:5]
        assert list(got[who == r]) == list(ids[order])
        assert np.array_equal(score[who == r], c[order])
    # one id that holds most of the near vectors counts once
    rows = [(i, [1.0, i / 1000]) for i in range(30)] + [(0, [1.0, 0.0001 * j]) for j in range(1, 40)]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    out = nearest(df, "id", "v", F.col("id") == 1, k=5).orderBy("rank").collect()
    assert len({r["id"] for r in out}) == 5 and 1 not in {r["id"] for r in out}
    assert [r["rank"] for r in out] == [1, 2, 3, 4, 5]


def test_directions_do_not_depend_on_the_matrix():
    from tracelens.llm import cap_filters as cf
    from tracelens.llm.vectors import unit

    x = unit(np.random.default_rng(3).normal(size=(300, 24)))
    words, threshold = cf.filter_plan(3000, 0.93)
    row, way = cf.decode(x, words, threshold)
    first, second = cf.code(24, words)
    g = np.rint(x / cf.GRID) * cf.GRID
    every = ((g @ first)[:, :, None] + (g @ second)[:, None, :] > threshold).reshape(300, -1)
    assert (np.nonzero(every)[0] == row).all() and (np.nonzero(every)[1] == way).all()
    for pick in ([5], [5, 17, 80], list(range(0, 300, 7)), list(range(299, 40, -1))):
        at, some = cf.decode(x[pick], words, threshold)
        for k, r in enumerate(pick):
            assert (some[at == k] == way[row == r]).all()

    p, q = np.triu_indices(40, 1)
    for cut in (1, words, words * words // 2, words * words):
        want = (every[p, :cut] & every[q, :cut]).any(axis=1)
        assert (cf.meet_earlier(x, p, q, cut, words, threshold) == want).all()
