"""Whole-token counts, periodic runs and pivot codes against the library and
brute force, and their edge cases."""

import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, id int, runs string, n_tokens string, seed int, lang string"


def rows_of(texts):
    return [(i, t, 1, "r", "n", 2, None) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    from tracelens.llm.trie_bpe import byte_bpe_path

    return Tokenizer.from_file(byte_bpe_path())


# --- op11 -----------------------------------------------------------------

def test_proven_strings_encode_as_one_token(tokenizer):
    from tracelens.llm.whole_tokens import byte_bpe_path, prove

    whole, *_ = prove(open(byte_bpe_path(), encoding="utf-8").read())
    pick = sorted(whole)[::41]
    pick = [w for w, pre in zip(pick, map(tokenizer.pre_tokenizer.pre_tokenize_str, pick)) if len(pre) == 1]
    assert len(pick) > 800
    assert all(len(e.ids) == 1 for e in tokenizer.encode_batch(pick, add_special_tokens=False))


def test_merges_of_short_and_long_words_agree(monkeypatch):
    from tracelens.llm import whole_tokens as W

    _, rank, byte_id, _ = W.prove(open(W.byte_bpe_path(), encoding="utf-8").read())
    merges = W.Merges(rank, byte_id)
    rng = random.Random(3)
    words = ["".join(rng.choice("aeiostrnlhé xX") for _ in range(rng.randint(0, 24))).encode() for _ in range(500)]
    scans = [merges.tokens(w) for w in words]
    monkeypatch.setattr(W, "SHORT_WORD", 0)
    assert scans == [merges.tokens(w) for w in words]


def test_counts_equal_the_library(spark, tokenizer):
    from tracelens.llm.whole_tokens import byte_bpe_path, count_tokens, op11_whole_token_counts

    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = op11_whole_token_counts(spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        n = len(tokenizer.encode(docs[r["doc_id"]] or "", add_special_tokens=False).ids)
        assert (r["n_tokens"], r["n_bytes"], r["over_limit"]) == (n, len((docs[r["doc_id"]] or "").encode()), n > 512)
    odd = [None, "", " ", "\n\n  a", "<|endoftext|>", "a <|endoftext|><|endoftext|>b", "x" * 60_000, "z q" * 9,
           "日本語 ñ ß ​  x", "\U0001e6c0 a", "same", "same", " ".join(f"w{i}" for i in range(30_000))]
    df = spark.createDataFrame(rows_of(odd) + [(None, "same", None, None, None, None, None)], DOCS)
    out = count_tokens(df, "text", byte_bpe_path())
    assert out.columns == df.columns
    for r in out.collect():
        assert r["n_tokens"] == len(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids)
    assert count_tokens(df.limit(0), "text", byte_bpe_path()).count() == 0


def test_pieces_split_like_the_whole():
    import regex

    from tracelens.llm.trie_bpe import SPLIT_PATTERN
    from tracelens.llm.whole_tokens import pieces

    rng = random.Random(5)
    for _ in range(300):
        text = "".join(rng.choice(["a", "é", " ", "  ", "\n", "'s", "1", "?", " "]) for _ in range(60))
        parts = list(pieces(text, rng.randint(1, 12)))
        assert "".join(parts) == text
        assert [w for p in parts for w in regex.findall(SPLIT_PATTERN, p)] == regex.findall(SPLIT_PATTERN, text)


# --- op12 -----------------------------------------------------------------

def brute_runs(words):
    """All (start, length, period) by definition."""
    n, out = len(words), set()
    same = {q: [i >= q and words[i] == words[i - q] for i in range(n)] for q in range(1, n // 3 + 1)}
    for q, s in same.items():
        i = q
        while i < n:
            if not s[i]:
                i += 1
                continue
            end = i
            while end < n and s[end]:
                end += 1
            start = i - q
            if end - start >= max(24, 3 * q) and not any(all(same[d][start + d:end]) for d in range(1, q)):
                out.add((start, end - start, q))
            i = end
    return sorted(out)


def periodic_text(rng, alphabet, length):
    words = []
    while len(words) < length:
        unit = [rng.randrange(alphabet) for _ in range(rng.randint(1, 14))]
        words += (unit * rng.randint(1, 9))[:rng.randint(1, 70)]
    return words[:length]


def test_runs_match_brute_force():
    from tracelens.llm.periodic_runs import periodic_runs

    rng = random.Random(11)
    seen = 0
    for _ in range(600):
        words = periodic_text(rng, rng.choice([1, 2, 3, 6]), rng.randint(0, 140))
        want = brute_runs(words)
        assert periodic_runs(words) == want, words
        seen += len(want)
    assert seen > 300


def test_every_square_is_found():
    """Without the bound on lengths the automaton finds all runs of two or
    more periods (no stretch of repeated sequences is needed for that)."""
    from tracelens.llm.periodic_runs import runs_of_stretch

    rng = random.Random(2)
    for _ in range(300):
        w = [rng.randrange(2) for _ in range(rng.randint(2, 60))]
        n, want = len(w), set()
        for s in range(n):
            for e in range(s + 2, n + 1):
                q = next(q for q in range(1, e - s + 1) if all(w[i] == w[i - q] for i in range(s + q, e)))
                if e - s >= 2 * q and (s == 0 or w[s - 1] != w[s - 1 + q]) and (e == n or w[e] != w[e - q]):
                    want.add((s, e - s, q))
        assert runs_of_stretch(np.array(w), 2, 2) == sorted(want)


def test_stretches_of_many_words():
    """More than 65,536 distinct words use another key."""
    from tracelens.llm.periodic_runs import periodic_runs

    words = [f"a{i}" for i in range(70_000)] + [f"b{i % 900}" for i in range(5_000)]
    assert periodic_runs(words) == [(70_000, 5_000, 900)]


def expected_row(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    return (len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_run_query_matches_definition(spark):
    from tracelens.llm.periodic_runs import op12_periodic_runs

    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r["doc_id"]: tuple(r)[1:] for r in op12_periodic_runs(spark, SF).collect()}
    assert set(got) == set(docs)
    short = [i for i, t in docs.items() if len((t or "").split()) < 700]
    assert len(short) > 150
    assert all(got[i] == expected_row(i, docs[i]) for i in short)
    assert sum(r[0] > 0 for r in got.values()) > 10


def test_run_edges(spark):
    from tracelens.llm.periodic_runs import collapse_runs

    many = " ".join(["x y"] * 40_000)
    texts = [None, "", " \t\n", "a " * 24, "a " * 23, "a b " * 13, "a b " * 13, many, "é " * 30 + "a b", "w" * 40_000]
    df = spark.createDataFrame(rows_of(texts) + [(None, "a " * 24, None, None, None, None, None)], DOCS)
    got = [(r["id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in
           collapse_runs(df, "doc_id", "text").collect()]
    assert got[:3] == [(0, 0, [], ""), (1, 0, [], ""), (2, 0, [], "")]
    assert got[3][2:] == ([(0, 24, 1)], "a") and got[4][2] == [] and got[4][3] == " ".join("a" * 23)
    assert got[5][1:] == got[6][1:] == (26, [(0, 26, 2)], "a b")
    assert got[7][1:] == (80_000, [(0, 80_000, 2)], "x y")
    assert got[8][2:] == ([(0, 30, 1)], "é a b") and got[9][1:] == (1, [], "w" * 40_000)
    assert got[10] == (None, 24, [(0, 24, 1)], "a")
    assert collapse_runs(df.limit(0), "doc_id", "text").count() == 0


# --- op13 -----------------------------------------------------------------

def test_pruned_assignment_is_exact_and_prunes():
    from tracelens.llm.laesa_codes import choose_pivots, nearest, pivot_distances

    rng = np.random.default_rng(1)
    for scale in (3, 400, 1 << 25):
        centres = rng.integers(-scale, scale, (16, 8))
        centres[5] = centres[2]
        x = centres[rng.integers(0, 16, 4000)] + rng.integers(-scale // 9 - 1, scale // 9 + 1, (4000, 8))
        pivots = choose_pivots(centres, 4)
        d = ((x[:, None] - centres[None]) ** 2).sum(axis=2)
        index, best, evaluated = nearest(x, pivot_distances(x, pivots), centres, pivots)
        assert (index == d.argmin(axis=1)).all() and (best == d.min(axis=1)).all()
        assert scale == 3 or evaluated < 0.7 * d.size


def by_sql(frame):
    from tracelens.llm.laesa_codes import OP13_SQL

    con = duckdb.connect()
    con.register("embeddings", frame)
    return sorted(con.execute(OP13_SQL).fetchall(), key=repr)


def test_codes_match_sql(spark, tmp_path):
    import pyarrow.parquet as pq

    from tracelens.llm.laesa_codes import op13_laesa_codes

    got = sorted(map(tuple, op13_laesa_codes(spark, SF).collect()), key=repr)
    assert got == by_sql(pq.read_table(f"{SF}/embeddings.parquet"))


def test_code_edges(spark, tmp_path, monkeypatch):
    from tracelens.llm import laesa_codes as L

    rng = np.random.default_rng(4)
    rows = [(i, [float(v) for v in rng.integers(-3, 4, 16) / 4096 + (i % 3)], i % 4 if i % 5 else None) for i in range(60)]
    rows += [(100, None, 1), (101, [None] + [0.0] * 15, 1), (102, [float("nan")] * 16, 1), (103, [float("inf")] * 16, 2),
             (104, [], 1), (105, [0.0] * 16, 7), rows[3], (None, [0.5] * 16, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    got = sorted(map(tuple, L.op13_laesa_codes(spark, str(tmp_path)).collect()), key=repr)
    import pyarrow.parquet as pq

    assert got == by_sql(pq.read_table(f"{tmp_path}/embeddings.parquet")) and len(got) == 63
    # more labels than may be broadcast
    coded = df.where("vec_id < 60").selectExpr("vec_id", "label", "vec_id AS error")
    plain = L.add_group_sum(coded, "label", "error", "s", "vec_id").collect()
    salted = L.add_group_sum(coded, "label", "error", "s", "vec_id", most=1).collect()
    assert sorted(map(tuple, plain), key=repr) == sorted(map(tuple, salted), key=repr) and len(salted) == 61
    # fewer rows than entries, no row, clashing column names
    few = df.where("vec_id < 5").selectExpr("vec_id", "embedding", "1 AS ints", "2 AS far", "3 AS row", "4 AS id")
    out, books = L.compress_vectors(few, "vec_id", "embedding")
    assert books.entries.shape == (8, 6, 2) and sorted(r["row"]["vec_id"] for r in out.collect()) == [0, 1, 2, 3, 3, 4]
    out, books = L.compress_vectors(few.where("false"), "vec_id", "embedding")
    assert books is None and out.count() == 0
    with pytest.raises(Exception, match="too large"):
        L.compress_vectors(spark.createDataFrame([(1, [1e9] * 8, 1)], df.schema), "vec_id", "embedding")


# --- op6: held-out labels of the tables ------------------------------------

def test_toxicity_on_held_out_labels():
    from tracelens.llm.zstd_toxicity import train_distance

    rows = duckdb.sql("""SELECT d.doc_id, l.toxic, d.text FROM '/root/testdata/sf0.1/documents.parquet' d
                         JOIN '/root/testdata/sf0.1/labels.parquet' l USING (doc_id)
                         WHERE d.text IS NOT NULL ORDER BY hash(d.doc_id)""").fetchall()
    held = [zlib.crc32(str(i).encode()) % 5 == 0 for i, _, _ in rows]
    train = [r[1:] for r, h in zip(rows, held) if not h]
    test = [r[1:] for r, h in zip(rows, held) if h]
    model = train_distance([r for r in train if r[0]] + [r for r in train if not r[0]][:1500]).start()
    s, y = model.scores([t for _, t in test]), np.array([v for v, _ in test])
    assert (s[y == 1] >= 0.5).mean() >= 0.8 and (s[y == 0] >= 0.5).mean() <= 0.04


def test_best_cut_lies_between_values():
    from tracelens.llm.zstd_toxicity import best_cut

    assert best_cut(np.array([1.0, 2, 3, 4]), np.array([0.0, 0, 1, 1])) == 2.5
    assert best_cut(np.array([1.0, 1, 1]), np.array([1.0, 0, 0])) > 1  # ties stay together
    assert best_cut(np.array([5.0, 1]), np.array([0.0, 1])) > 5  # nothing worth catching
