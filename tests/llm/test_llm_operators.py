"""The llm operators against brute force, and their edge cases."""

import collections
import hashlib
import math
import sys
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, bucket int, id int, _h string"
LONG = " ".join(f"w{i % 977}" for i in range(30_000))


@pytest.fixture(scope="module")
def odd(spark):
    """Null, empty, very long and repeated rows, and clashing columns."""
    texts = [None, "", "   \t\n", "12 34 !!", LONG, LONG, "a b c", "a b c", "ein wort", "x" * 50_000]
    rows = [(i, t, "en" if i % 2 else None, "s", 1, 7, 8, "z") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows + [(None, "a b c", "de", None, None, None, None, None), rows[6]], DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def docs_of(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def words(t):
    return (t or "").encode().split()


def test_langid_accuracy_and_edges(spark, odd, empty):
    from tracelens.llm.crf_langid import label_words, op1_crf_langid, predict_language, train_crf, train_langid

    got = op1_crf_langid(spark, SF).join(docs_of(spark).select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) >= 0.95 * len(got)
    model = train_langid(docs_of(spark), "doc_id", "text", "lang")
    out = {r["doc_id"]: r["p"] for r in predict_language(odd, "text", model, "p").collect()}
    assert all(out[i]["lang"] == "und" and out[i]["score"] == 0 for i in range(4))
    assert all(0 <= p["score"] <= 1 for p in out.values())
    assert predict_language(empty, "text", model, "p").count() == 0
    assert label_words(odd, "doc_id", "text", model).count() == odd.count()
    assert train_crf([]).labels == ["und"]


def test_chain_marginals_match_enumeration():
    import itertools

    from tracelens.llm.crf_langid import chain_marginals

    rng = np.random.default_rng(0)
    e, trans = rng.random((9, 3)) + .1, rng.random((3, 3)) + .1
    starts = np.zeros(9, bool)
    starts[[0, 5]] = True
    want = []
    for a, b in ((0, 5), (5, 9)):
        p = np.zeros((b - a, 3))
        for path in itertools.product(range(3), repeat=b - a):
            w = np.prod([e[a + t, y] for t, y in enumerate(path)]) * np.prod([trans[x, y] for x, y in zip(path, path[1:])])
            for t, y in enumerate(path):
                p[t, y] += w
        want.append(p / p.sum(axis=1, keepdims=True))
    assert np.allclose(chain_marginals(e, starts, trans), np.concatenate(want))


def test_bagminhash_signature_is_unbiased():
    import pyarrow as pa

    from tracelens.llm import bagminhash as B

    base = [f"w{i}" for i in range(600)]
    other = base[:]
    other[::29] = ["x"] * len(other[::29])
    texts = pa.array([" ".join(base + ["rep"] * 20), " ".join(other + ["rep"] * 40)])
    doc, key, count = B.shingles(texts)
    sig = B.signatures(doc, key, count, 2, 4096)
    exact = B.weighted_jaccard(texts.slice(0, 1), texts.slice(1, 1), 5)[0]
    assert abs((sig[0] == sig[1]).mean() - exact) < 0.04


def test_near_duplicates_match_all_pairs(spark, odd, empty):
    from tracelens.llm.bagminhash import near_duplicates

    rows = docs_of(spark).select("doc_id", "text").collect()
    bags = {}
    for r in rows:
        w = (r["text"] or "").split()
        bags[r["doc_id"]] = collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else (
            collections.Counter([tuple(w)]) if w else collections.Counter())
    low = {i: i for i in bags}
    ids = sorted(bags)
    changed = True
    near = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:]
            if bags[a] and sum((bags[a] & bags[b]).values()) >= .8 * sum((bags[a] | bags[b]).values()) - 1e-9]
    while changed:
        changed = False
        for a, b in near:
            m = min(low[a], low[b])
            changed |= low[a] != m or low[b] != m
            low[a] = low[b] = m
    got = {r["id"]: r["class_id"] for r in near_duplicates(docs_of(spark), "doc_id", "text").collect()}
    assert got == low
    out = {r["id"]: (r["class_id"], r["kept"]) for r in near_duplicates(odd, "doc_id", "text").collect()}
    assert out[5] == (4, False) and out[7] == (6, False) and out[1] == (1, True) and out[0] == (0, True)
    assert out[None] == (6, True) or out[None][1]
    assert near_duplicates(empty, "doc_id", "text").count() == 0


def test_classes_that_meet_across_buckets():
    """Members far from the leader but near others of its class are linked."""
    import pyarrow as pa

    from tracelens.llm.bagminhash import weighted_jaccard

    assert weighted_jaccard(pa.array(["a b c", None]), pa.array(["a b c", "x"]), 5).tolist() == [1.0, 0.0]


def test_repeats_match_brute_force(spark, odd, empty):
    from tracelens.llm.suffix_repeats import kept_digest, remove_repeats

    def brute(rows):
        seen = {}
        for i, t in rows:
            w = words(t)
            for k in range(len(w) - 12):
                g = tuple(w[k:k + 13])
                seen[g] = min(seen.get(g, i), i)
        out = {}
        for i, t in rows:
            w = words(t)
            gone = [False] * len(w)
            for k in range(len(w) - 12):
                if seen[tuple(w[k:k + 13])] < i:
                    gone[k:k + 13] = [True] * 13
            out[i] = (len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone) if not g)).hexdigest())
        return out

    rows = [(r["doc_id"], r["text"]) for r in docs_of(spark).select("doc_id", "text").collect()]
    # a small group limit makes prefixes of every length
    for limit in (1_000_000, 300):
        got = kept_digest(remove_repeats(docs_of(spark), "doc_id", "text", group_paths=limit)).collect()
        assert {r["id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got} == brute(rows)
    out = {r["id"]: r for r in remove_repeats(odd, "doc_id", "text").collect()}
    assert out[5]["n_removed"] == 30_000 and out[4]["n_removed"] == 0 and out[5]["kept_text"] == ""
    assert out[0]["n_words"] == 0 and out[0]["kept_text"] is None
    assert remove_repeats(empty, "doc_id", "text").count() == 0


def test_language_model_base_and_edges(spark, odd, empty):
    from tracelens.llm.gru_lm import op5_gru_lm, score_documents

    lower = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    toks = {r["doc_id"]: [w.translate(lower) for w in words(r["text"])] + [None]
            for r in docs_of(spark).select("doc_id", "text").collect()}
    c = collections.Counter(w for i, ws in toks.items() if zlib.crc32(str(i).encode()) % 7 != 2 for w in ws)
    n, v = sum(c.values()), len(c)
    rows = op5_gru_lm(spark, SF).collect()
    for r in rows:
        ws = toks[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(ws), sum(c[w] > 0 for w in ws), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws))
    assert sum(r["score"] for r in rows if r["held_out"]) > sum(r["base_score"] for r in rows if r["held_out"])
    out = score_documents(odd, "doc_id", "text", F.lit(True)).collect()
    assert len(out) == odd.count() and all(math.isfinite(r["score"]) for r in out)
    assert score_documents(odd, "doc_id", "text", F.lit(False)).where("n_known > 0").count() == 0
    assert score_documents(empty, "doc_id", "text", F.lit(True)).count() == 0


def test_gru_gradient_matches_differences():
    from tracelens.llm import gru_lm as G

    rng = np.random.default_rng(0)
    p = {k: v.astype(float) for k, v in G.new_network().items()}
    seen, target = rng.integers(0, G.CLASSES, (4, 3)), rng.integers(0, G.CLASSES, (4, 3))
    fresh = np.zeros((4, 3), bool)
    fresh[2, 1] = True
    h = rng.normal(size=(3, G.HIDDEN))
    _, grad, _ = G.gradients(p, h, seen, fresh, target)
    for name, at in (("U", (3, 20)), ("W", (2, 5)), ("E", (int(seen[0, 0]), 40)), ("U", (1, 2))):
        step = {k: v.copy() for k, v in p.items()}
        step[name][at] += 1e-5
        more = G.gradients(step, h, seen, fresh, target)[0]
        step[name][at] -= 2e-5
        less = G.gradients(step, h, seen, fresh, target)[0]
        assert grad[name][at] == pytest.approx((more - less) / 2e-5 / target.size, abs=1e-5)


def test_toxicity_edges_and_signal(spark, odd, empty):
    from tracelens.llm.zstd_toxicity import score_toxicity, train_distance

    # clean texts of the table, every other one with marked words put in
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy("doc_id")
    texts = [r["text"] for r in table.collect() if len(words(r["text"])) > 30]
    rows = []
    for i, t in enumerate(texts):
        w = t.split()
        if i % 2:
            for k in range(5, len(w), 12):
                w[k] = ("wretchling", "dolthead", "scoundrelish")[k % 3]
        rows.append((i % 2, " ".join(w)))
    half = len(rows) // 2
    model = train_distance(rows[:half])
    s = model.start().scores([t for _, t in rows[half:]] + [""])
    y = np.array([y for y, _ in rows[half:]])
    pairs = s[:-1][y == 1][:, None] > s[:-1][y == 0][None]
    assert pairs.mean() > 0.9 and s[-1] == 0
    assert score_toxicity(odd, "text", model, "s").where("s BETWEEN 0 AND 1").count() == odd.count()
    assert score_toxicity(empty, "text", model, "s").count() == 0
    assert score_toxicity(odd, "text", model, "s").where("doc_id IN (0, 1, 2) AND s = 0").count() == 3
    assert train_distance([]).start().scores(["x"])[0] < 0.5


def test_bpe_matches_library(spark, odd):
    import random

    from tokenizers import Tokenizer

    from tracelens.llm.ss_packing import WordTokens, word_bpe_path
    from tracelens.llm.trie_bpe import TrieBpe, byte_bpe_path, decode_documents, digest_documents, encode_documents

    rnd = random.Random(3)
    pool = [chr(c) for c in [*range(1, 0x250), *range(0x300, 0x400), 0x3A3, 0x130, 0x1F600, 0x4E00, 0x208F, 0x558]]
    texts = ["".join(rnd.choice(pool) for _ in range(rnd.randint(0, 40))) for _ in range(800)]
    texts += ["".join(rnd.choice("labtion =-_. \n") for _ in range(50)) for _ in range(800)]
    texts += ["a<|endoftext|>b", "x\x1cy \x85z", "llll rrrr  it's", " " * 30, "=" * 99]
    bpe, lib = TrieBpe(byte_bpe_path()), Tokenizer.from_file(byte_bpe_path())
    for t in texts:
        ids = lib.encode(t, add_special_tokens=False).ids
        assert bpe.encode(t) == ids
        assert bpe.decode(ids).decode(errors="replace") == lib.decode(ids, skip_special_tokens=False)
    word, lib = WordTokens(word_bpe_path()), Tokenizer.from_file(word_bpe_path())
    for t, raw in zip(texts, word.encode(texts)):
        assert np.frombuffer(raw, "<u4").tolist() == lib.encode(t, add_special_tokens=False).ids
    ids = encode_documents(odd.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]), "doc_id", "text", byte_bpe_path())
    back = {r["id"]: r["text"] for r in decode_documents(ids, "id", "ids", byte_bpe_path()).collect()}
    assert back[4] == LONG and back[0] == ""
    assert digest_documents(odd, "doc_id", "text", byte_bpe_path()).count() == odd.count()


def test_packing_is_gapless_and_tight(spark, odd, empty):
    from tracelens.llm.ss_packing import op8_sum_of_squares_packing, pack_documents, word_bpe_path

    for out in (op8_sum_of_squares_packing(spark, SF).withColumnRenamed("doc_id", "id"),
                pack_documents(odd, "doc_id", "text", word_bpe_path())):
        rows = out.collect()
        by = collections.defaultdict(list)
        for r in rows:
            by[r["sequence_id"]].append((r["offset"], r["length"]))
        for parts in by.values():
            end = 0
            for off, n in sorted(parts):
                assert off == end
                end += n
            assert end <= 4096
        assert len(by) <= math.ceil(sum(r["length"] for r in rows) / 4096) * 1.05 + 1
    assert pack_documents(empty, "doc_id", "text", word_bpe_path()).count() == 0


def test_rendezvous_law_and_slots(spark, odd, empty):
    from tracelens.llm.rendezvous import op9_rendezvous_shards, shard_records

    rows = op9_rendezvous_shards(spark, SF).collect()
    for r in rows:
        u = [int(hashlib.md5(f"{r['doc_id']}:{s}".encode()).hexdigest()[:13], 16) for s in range(25)]
        assert r["shard"] == max(range(24), key=lambda s: u[s])
        assert r["grown_shard"] == max(range(25), key=lambda s: u[s])
    for cell in (200_000, 1):
        got = shard_records(odd, "doc_id", "text", [1.0, 2.0, 1.0], cell_rows=cell).collect()
        by = collections.defaultdict(list)
        for r in got:
            by[r["shard"]].append(r["slot"])
        assert len(got) == odd.count() and all(sorted(v) == list(range(len(v))) for v in by.values())
    assert shard_records(empty, "doc_id", "text", [1.0]).count() == 0


VECTORS = "vec_id long, v array<float>, label int, length int, rep long"


def odd_vectors(spark):
    nan = float("nan")
    rows = [(0, [1., 0., 0., 0.], 1), (1, [1., 0., 0., 0.], 1), (2, [2., 0., 0., 0.], 1), (3, [0., 0., 0., 0.], 1),
            (4, None, 1), (5, [nan, 1., 0., 0.], 1), (6, [None, 1., 0., 0.], 1), (7, [1., 0., 0., 0.], None),
            (8, [1., .1, 0., 0.], 1), (9, [1., 0., 0., 0.], 2), (10, [1., 0.], 1), (11, [], 1), (50, [0., 1., 0., 0.], 1)]
    return spark.createDataFrame([(*r, 1, 2) for r in rows], VECTORS)


def test_cap_filters_match_all_pairs(spark):
    from tracelens.llm.cap_filters import linked_vectors

    e = spark.read.parquet(f"{SF}/embeddings.parquet").toPandas()
    x = np.stack(e.embedding.values).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = (x @ x.T >= .93) & (e.label.values[:, None] == e.label.values[None])
    np.fill_diagonal(near, False)
    low = e.vec_id.values.copy()
    for _ in range(len(low)):
        low = np.minimum(low, np.where(near, low[None], 1 << 60).min(axis=1))
    want = {int(i): (int(n), int(c)) for i, n, c in zip(e.vec_id, near.sum(axis=1), low)}
    for block in (1024, 8):
        got = linked_vectors(spark.read.parquet(f"{SF}/embeddings.parquet"), "vec_id", "embedding", "label", block=block)
        assert {r["id"]: (r["n_links"], r["component_id"]) for r in got.collect()} == want
    out = {r["id"]: (r["n_links"], r["component_id"]) for r in linked_vectors(odd_vectors(spark), "vec_id", "v", "label").collect()}
    assert out[0] == out[1] == out[2] == out[8] == (3, 0)
    assert all(out[i] == (0, i) for i in (3, 4, 5, 6, 7, 9, 10, 11, 50))
    assert linked_vectors(odd_vectors(spark).limit(0), "vec_id", "v", "label").count() == 0


def test_vp_trees_match_brute_force(spark):
    from tracelens.llm.vp_trees import nearest

    e = spark.read.parquet(f"{SF}/embeddings.parquet")
    p = e.toPandas()
    x = np.stack(p.embedding.values).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    want = {}
    for i in np.flatnonzero(p.vec_id.values % 50 == 0):
        s = x @ x[i]
        s[i] = -9
        want[int(p.vec_id[i])] = p.vec_id.values[np.lexsort((p.vec_id.values, -np.round(s, 12)))[:5]].tolist()

    def found(**kw):
        out = collections.defaultdict(list)
        for r in nearest(e, "vec_id", "embedding", F.col("vec_id") % 50 == 0, **kw).orderBy("query_id", "rank").collect():
            out[r["query_id"]].append(r["id"])
        return out

    assert found() == want and found(shard_vectors=100) == want
    loose = found(factor=1.2)
    assert sum(len(set(loose[q]) & set(want[q])) for q in want) >= 0.5 * 5 * len(want)
    out = nearest(odd_vectors(spark), "vec_id", "v", F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect()
    assert [r["id"] for r in out if r["query_id"] == 0] == [1, 2, 7, 9, 8]
    assert nearest(odd_vectors(spark).limit(0), "vec_id", "v", F.lit(True)).count() == 0


def test_components_of_a_path(spark):
    from tracelens.llm.graph import components

    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 100), (None, 3)], "a long, b long")
    out = {r["node"]: r["component"] for r in components(edges).collect()}
    assert out == {**{i: 0 for i in range(41)}, 100: 100}


def test_pipeline_stages(spark, odd):
    sys.path.insert(0, "/root/repo")
    import corpus_pipeline as P

    docs = docs_of(spark)
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        before = docs.count()
        docs = spark.createDataFrame(out.collect(), docs.schema)
        assert 0 < docs.count() <= before
    assert P.STAGES[-1][1](spark, docs, SF).select("doc_id").distinct().count() == docs.count()


def test_components_over_several_parts(spark, monkeypatch):
    from tracelens.llm import graph

    monkeypatch.setattr(graph, "TASK_EDGES", 8)
    rng = np.random.default_rng(5)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 60, (45, 2))]
    low = graph.lowest(np.array([a for a, _ in edges]), np.array([b for _, b in edges]), 60)
    out = {r["node"]: r["component"] for r in graph.components(
        spark.createDataFrame(edges + [(None, 3)], "a long, b long").repartition(4)).collect()}
    assert out == {n: int(low[n]) for e in edges for n in e}
