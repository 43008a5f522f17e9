"""Language identification by a linear-chain conditional random field.

Every word of a text gets a distribution over the languages by
forward-backward; labels may change inside a text (code switching).  A word's
features are its prefixes and suffixes (affixes), its character n-grams and
its membership in each language's lexicon of frequent words; label changes
have learned transition weights.  A text's language is the one with the
largest mean word probability, which is also its score.

Training takes at most ``docs_per_label`` labelled texts per language, the
smallest by a hash of their id, and of each at most ``words_per_doc`` words in
runs drawn from its whole length (both documented bounds of the learning
sample), and mixes the runs to code-switched sequences.  The learned weights
are small and travel with the task.  Prediction reads every word of a text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import held_out, mix, random_words, table
from .ss_packing import text_blocks

#: Labelled texts per language that training reads, and words learned of each,
#: in runs drawn from the whole text.
DOCS_PER_LABEL = 120
WORDS_PER_DOC = 150
#: Feature slots of the weight table.
SLOTS = 1 << 16
#: Distinct words whose scores a Python worker keeps.
CACHE_WORDS = 200_000
#: Characters of a longer word that its features look at from either end.
WORD_CHARS = 48

find_words = re.compile(r"[^\W\d_]+").findall


def words_of(text: str) -> list[str]:
    """Lower-cased runs of letters of a text."""
    return find_words(text.lower())


def word_features(words: list[str], lexicon: dict[str, int], labels: int) -> tuple[np.ndarray, np.ndarray]:
    """(feature slots, word of each): character pairs and triples of
    ``^word$``, its first and last 4 and 5 characters, the word itself, and
    the lexicons it is in."""
    clipped = [f"^{w}$" if len(w) <= 2 * WORD_CHARS else f"^{w[:WORD_CHARS]}{w[-WORD_CHARS:]}$" for w in words]
    codes = np.frombuffer("".join(clipped).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    size = np.fromiter(map(len, clipped), np.int64, len(clipped))
    first = np.cumsum(size) - size
    owner = np.repeat(np.arange(len(words)), size)
    place = np.arange(len(codes)) - first[owner]
    left = size[owner] - place
    weights = random_words(2 * WORD_CHARS + 2, 11)

    def slots(x, kind):
        return (mix(x + weights[-kind]) & np.uint64(SLOTS - 1)).astype(np.int64)

    with np.errstate(over="ignore"):
        pair = codes * weights[0]
        pair[:-1] += codes[1:] * weights[1]
        triple = pair.copy()
        triple[:-2] += codes[2:] * weights[2]
        cols = [slots(pair[left > 1], 1), slots(triple[left > 2], 2)]
        owners = [owner[left > 1], owner[left > 2]]
        for k in (4, 5):
            n = np.minimum(size, k)
            for kind, begin in ((2 * k, first), (2 * k + 1, first + size - n)):
                x = n.astype(np.uint64)
                for j in range(k):
                    x[n > j] += codes[(begin + j)[n > j]] * weights[j]
                cols.append(slots(x, kind))
                owners.append(np.arange(len(words)))
        cols.append(slots(np.add.reduceat(codes * weights[place], first), 3))
        owners.append(np.arange(len(words)))
    known = np.fromiter((lexicon.get(w, 0) for w in words), object, len(words))
    for y in range(labels):
        has = np.flatnonzero([m >> y & 1 for m in known])
        cols.append(np.full(len(has), SLOTS + y))
        owners.append(has)
    return np.concatenate(cols), np.concatenate(owners)


def feature_sums(cols: np.ndarray, owner: np.ndarray, words: int, weights: np.ndarray) -> np.ndarray:
    """(words, labels) sums of the weights of each word's features."""
    return np.stack([np.bincount(owner, weights[cols, y], words) for y in range(weights.shape[1])], axis=1)


def chain_marginals(emit: np.ndarray, starts: np.ndarray, trans: np.ndarray, pairs: bool = False):
    """Posterior label probabilities of every word; with ``pairs`` also those
    of every label pair of a word and the next one, (words - 1, labels,
    labels), which have no meaning where the next word is a start.

    emit: (words, labels) positive factors; starts: True at the first word of
    a text; trans: (labels, labels) positive factors.  All texts form one
    chain in which a text's first word forgets the word before.  The chain is
    cut into equal blocks; the products of the blocks' step matrices run side
    by side, then the block borders are joined in order, which is exact.
    """
    n, k = emit.shape
    if not n:
        return (emit, np.empty((0, k, k))) if pairs else emit
    size = max(1, int(np.sqrt(n / 4)))
    count = -(-n // size)
    total = count * size
    e = np.ones((total, k))
    e[:n] = emit / emit.max(axis=1, keepdims=True)
    first = np.ones(total, bool)
    first[:n] = starts
    e = e.reshape(count, size, k)
    first = first.reshape(count, size)
    flat = np.ones((k, k)) / k
    trans = trans / trans.sum()

    def step(t):
        return np.where(first[:, t, None, None], flat, trans)

    # forward: row vector times the steps of a block, from each label
    fwd = np.empty((count, size, k, k))
    m = np.broadcast_to(np.eye(k), (count, k, k))
    for t in range(size):
        m = (m @ step(t)) * e[:, t, None, :]
        m = m / m.sum(axis=(1, 2), keepdims=True)
        fwd[:, t] = m
    alpha_in = np.empty((count, k))
    a = np.ones(k) / k
    for b in range(count):
        alpha_in[b] = a
        a = a @ fwd[b, -1]
        a = a / a.sum()
    alpha = np.einsum("bk,btkj->btj", alpha_in, fwd)
    # backward: products of the steps after each word of a block
    bwd = np.empty((count, size, k, k))
    m = np.broadcast_to(np.eye(k), (count, k, k))
    for t in range(size - 1, -1, -1):
        bwd[:, t] = m
        m = step(t) @ (e[:, t, :, None] * m)
        m = m / m.sum(axis=(1, 2), keepdims=True)
    beta_out = np.empty((count, k))
    whole = m
    v = np.ones(k) / k
    for b in range(count - 1, -1, -1):
        beta_out[b] = v
        v = whole[b] @ v
        v = v / v.sum()
    beta = np.einsum("btjk,bk->btj", bwd, beta_out)
    p = (alpha * beta).reshape(total, k)[:n]
    p = p / p.sum(axis=1, keepdims=True)
    if not pairs:
        return p
    before = alpha.reshape(total, k)[:n - 1]
    after = (e * beta).reshape(total, k)[1:n]
    both = before[:, :, None] * trans * after[:, None, :]
    return p, both / np.maximum(both.sum(axis=(1, 2), keepdims=True), 1e-300)


def word_runs(words: list[str], limit: int, rng: np.random.Generator) -> list[list[str]]:
    """A text's words in runs of 5 to 40; of a text of more than ``limit``
    words, randomly drawn runs of about that many words."""
    cuts = [0]
    while cuts[-1] < len(words):
        cuts.append(min(len(words), cuts[-1] + int(rng.integers(5, 41))))
    runs = list(zip(cuts, cuts[1:]))
    if len(words) > limit:
        drawn, room = [], limit
        for r in rng.permutation(len(runs)):
            a, b = runs[r]
            drawn.append((a, min(b, a + room)))
            room -= drawn[-1][1] - a
            if not room:
                break
        runs = sorted(drawn)
    return [words[a:b] for a, b in runs]


class Crf:
    """Trained model: labels, lexicon, feature and transition weights."""

    def __init__(self, labels: list[str], lexicon: dict[str, int], weights: np.ndarray, trans: np.ndarray):
        self.labels, self.lexicon, self.weights, self.trans = labels, lexicon, weights, trans

    def parts(self) -> tuple:
        return self.labels, self.lexicon, self.weights, self.trans

    def start(self) -> None:
        self.index: dict[str, int] = {}
        self.factors = np.empty((0, len(self.labels)))

    def word_ids(self, words: list[str]) -> np.ndarray:
        index = self.index
        new = sorted({w for w in words if w not in index})
        if new:
            if len(index) > CACHE_WORDS:
                self.start()
                index = self.index
                new = sorted(set(words))
            cols, owner = word_features(new, self.lexicon, len(self.labels))
            s = feature_sums(cols, owner, len(new), self.weights)
            self.factors = np.concatenate([self.factors, np.exp(s - s.max(axis=1, keepdims=True)) + 1e-12])
            index.update(zip(new, range(len(index), len(index) + len(new))))
        return np.fromiter(map(index.__getitem__, words), np.int64, len(words))

    def label_texts(self, texts: list[str]) -> list[tuple[list[str], np.ndarray]]:
        """The words of each text and their label probabilities."""
        split = [words_of(t) for t in texts]
        flat = [w for ws in split for w in ws]
        if not flat:
            return [(ws, np.empty((0, len(self.labels)))) for ws in split]
        ids = self.word_ids(flat)
        sizes = np.array([len(ws) for ws in split])
        ends = np.cumsum(sizes)
        starts = np.zeros(len(flat), bool)
        starts[(ends - sizes)[sizes > 0]] = True
        p = chain_marginals(self.factors[ids], starts, np.exp(self.trans))
        return [(ws, p[e - n:e]) for ws, e, n in zip(split, ends, sizes)]

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        out = []
        for text, (ws, p) in zip(texts, self.label_texts(texts)):
            if not ws or not any(map(str.isalpha, text)):
                out.append(("und", 0.0))
                continue
            mean = p.mean(axis=0)
            best = int(mean.argmax())
            out.append((self.labels[best], float(min(1.0, mean[best]))))
        return out


def train_crf(rows: list[tuple[str, str]], words_per_doc: int = WORDS_PER_DOC, rounds: int = 30,
              seed: int = 1) -> Crf:
    """A model from (label, text) rows: gradient steps (AdaGrad) on the
    likelihood of code-switched sequences cut from the texts."""
    labels = sorted({lab for lab, _ in rows})
    k = len(labels)
    if not k:
        return Crf(["und"], {}, np.zeros((SLOTS + 1, 1)), np.zeros((1, 1)))
    rng = np.random.default_rng(seed)
    texts = [(labels.index(lab), word_runs(words_of(t), words_per_doc, rng)) for lab, t in rows]
    seen = [{} for _ in labels]
    for y, cut in texts:
        for w in {w for ws in cut for w in ws}:
            seen[y][w] = seen[y].get(w, 0) + 1
    lexicon: dict[str, int] = {}
    for y in range(k):
        docs = max(1, sum(1 for t, _ in texts if t == y))
        for w, c in seen[y].items():
            if c >= max(2, 0.05 * docs):
                lexicon[w] = lexicon.get(w, 0) | 1 << y
    runs = [(y, ws) for y, cut in texts for ws in cut]  # code-switched below
    order = rng.permutation(len(runs))
    flat = [w for r in order for w in runs[r][1]]
    gold = np.array([runs[r][0] for r in order for _ in runs[r][1]], np.int64)
    if not flat:
        return Crf(labels, lexicon, np.zeros((SLOTS + k, k)), np.zeros((k, k)))
    starts = np.zeros(len(flat), bool)
    starts[np.cumsum([0] + [len(runs[r][1]) for r in order])[:-1][::6]] = True
    vocab = sorted(set(flat))
    at = {w: i for i, w in enumerate(vocab)}
    ids = np.array([at[w] for w in flat])
    cols, owner = word_features(vocab, lexicon, k)
    weights, trans = np.zeros((SLOTS + k, k)), np.zeros((k, k))
    gw, gt = np.full_like(weights, 1e-3), np.full_like(trans, 1e-3)
    onehot = np.eye(k)[gold]
    inner = ~starts[1:]
    for _ in range(rounds):
        s = feature_sums(cols, owner, len(vocab), weights)
        e = np.exp(s - s.max(axis=1, keepdims=True))[ids] + 1e-12
        p, pair = chain_marginals(e, starts, np.exp(trans), pairs=True)
        diff = onehot - p
        word_grad = np.stack([np.bincount(ids, diff[:, y], len(vocab)) for y in range(k)], axis=1)
        g = np.stack([np.bincount(cols, word_grad[owner, y], SLOTS + k) for y in range(k)], axis=1)
        g = g / len(flat) - 1e-6 * weights
        real = onehot[:-1][inner].T @ onehot[1:][inner]
        t = (real - pair[inner].sum(axis=0)) / len(flat) - 1e-4 * trans
        gw += g * g
        gt += t * t
        weights += 0.5 * g / np.sqrt(gw)
        trans += 0.3 * t / np.sqrt(gt)
    return Crf(labels, lexicon, weights.astype(np.float32), trans)


def training_rows(df: DataFrame, id_col: str, text_col: str, label_col: str, docs_per_label: int) -> list:
    """At most ``docs_per_label`` (label, text) rows per label, the smallest
    by a hash of the id (only ids are ranked; the ranks are cut before any
    shuffle)."""
    ok = df.where(F.col(label_col).isNotNull() & F.col(text_col).isNotNull())
    order = W.partitionBy("label").orderBy("h", "id")
    picked = (ok.select(F.col(label_col).alias("label"), F.xxhash64(id_col).alias("h"), F.col(id_col).alias("id"))
              .withColumn("i", F.row_number().over(order)).where(F.col("i") <= docs_per_label).select("id").distinct())
    ids = [r["id"] for r in picked.collect()]
    rows = (ok.where(F.col(id_col).isin(ids)).groupBy(F.col(id_col).alias("id"))
            .agg(F.min(F.struct(F.col(label_col).alias("label"), F.col(text_col).alias("text"))).alias("r"))
            .select("id", "r.label", "r.text"))
    return [(r["label"], r["text"]) for r in sorted(rows.collect(), key=lambda r: r["id"])]


def train_langid(df: DataFrame, id_col: str, text_col: str, label_col: str,
                 docs_per_label: int = DOCS_PER_LABEL) -> Crf:
    return train_crf(training_rows(df, id_col, text_col, label_col, docs_per_label))


def predict_language(df: DataFrame, text_col: str, model: Crf, out_col: str) -> DataFrame:
    """df with a struct ``out_col`` (lang, score) of each row's whole text.

    A null or empty text, or one without a letter, is ``und`` with score 0.
    Very long texts are read whole; of a word of over 2 * WORD_CHARS letters
    its features see the first and last WORD_CHARS.  At a tie the label that
    sorts first wins.  Every row is judged on its own (equal rows alike); other columns pass
    unchanged; an empty table stays empty.
    """
    shape = "struct<lang:string,score:double>"
    sent = df.sparkSession.sparkContext.broadcast(model.parts())

    @F.arrow_udf(shape)
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = Crf(*sent.value)
        m.start()
        for texts in batches:
            got = [r for part in text_blocks(texts.to_pylist()) for r in m.predict(part)]
            yield pa.StructArray.from_arrays([pa.array([g[0] for g in got], pa.string()),
                                              pa.array([g[1] for g in got], pa.float64())], ["lang", "score"])

    return df.withColumn(out_col, predict(F.col(text_col)))


def label_words(df: DataFrame, id_col: str, text_col: str, model: Crf) -> DataFrame:
    """(id, spans array<struct<lang, words>>): each text's words by runs of
    equal most likely language; null text: no spans."""
    sent = df.sparkSession.sparkContext.broadcast(model.parts())

    def run(batches):
        m = Crf(*sent.value)
        m.start()
        for batch in batches:
            out = []
            for part in text_blocks(batch.column(1).to_pylist()):
                for ws, p in m.label_texts(part):
                    spans: list[dict] = []
                    for w, y in zip(ws, p.argmax(axis=1) if len(ws) else ()):
                        if not spans or spans[-1]["lang"] != m.labels[y]:
                            spans.append({"lang": m.labels[y], "words": []})
                        spans[-1]["words"].append(w)
                    out.append(spans)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out, pa.list_(pa.struct([("lang", pa.string()), ("words", pa.list_(pa.string()))])))],
                ["id", "spans"])

    return df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {df.schema[id_col].dataType.simpleString()}, spans array<struct<lang:string,words:array<string>>>")


def op1_crf_langid(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", held_out("doc_id", 4, 2))
    model = train_langid(docs.where("NOT held_out"), "doc_id", "text", "lang")
    out = predict_language(docs.select("doc_id", "held_out", "text"), "text", model, "p")
    return out.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))
