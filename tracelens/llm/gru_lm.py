"""Gated recurrent language model with class-factored output.

A text is its words, lower-cased, and one end token.  Every word belongs to a
class: each frequent word is a class of its own, the others share classes by
their last letters.  A small gated recurrent network reads the classes of the
words so far and gives the probability of the next class; inside a class a
word has its smoothed share of the class's training tokens.  The network's
state runs through the whole document, window after window.

Word counts, the classes of endings and the network come from all training
documents.  The network starts from a few of them (``TRAIN_DOCS``, read on the
driver) and then learns in data-parallel rounds: every round deals its share
of the training documents to buckets, each bucket goes on from the round's
weights by truncated backpropagation, and the weights are averaged by tokens.
All rounds together read every training document once, to its end.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import (ASCII_LOWER, blocks, bucketed, by_limits, checkpointed, held_out, mix, pack, release, table, unpack, utf8,
                     word_hashes, word_spans)

#: Documents and words that the network starts from; longer texts are cut so
#: that all of these have a share.
TRAIN_DOCS = 500
TRAIN_WORDS = 400_000
#: Rounds over shares of all training documents, and the first one's rate.
ROUNDS, ROUND_RATE = 4, 0.005
HIDDEN = 16
#: Classes: the end token, frequent words, word endings.
TOP_WORDS, ENDINGS = 40, 55
CLASSES = 1 + TOP_WORDS + ENDINGS
#: Steps between two cuts of the gradient, and texts side by side.
WINDOW, LANES = 24, 32
#: Pieces of a bucket's text side by side in a round.
ROUND_LANES = 256
#: Distinct (bucket, word) entries that one counting task holds.
GROUP_WORDS = 2_000_000
END = 0


def tokens(array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word hashes, cell of each word's last two bytes, words before each
    document) of a text column, A-Z lower-cased."""
    data, offsets = utf8(array)
    hashes, cells, counts, done = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], [np.zeros(1, np.int64)], 0
    for i, j in blocks(offsets):
        part = ASCII_LOWER[data[offsets[i]:offsets[j]]]
        s, e, before = word_spans(part, offsets[i:j + 1] - offsets[i])
        hashes.append(word_hashes(part, s, e))
        if len(s):
            last, prior = part[e - 1].astype(np.int64), np.where(e - s > 1, part[e - 2], 0).astype(np.int64)
            cells.append(last * 256 + prior)
        counts.append(before[1:] + done)
        done += len(s)
    return np.concatenate(hashes), np.concatenate(cells), np.concatenate(counts)


class ClassPlan:
    """Class of each word ending: the most frequent endings of all training
    documents have their own, the others share the last seven."""

    def __init__(self, ending_class: np.ndarray):
        self.ending_class = ending_class

    @staticmethod
    def fit(count: np.ndarray) -> "ClassPlan":
        own = ENDINGS - 7
        out = (1 + TOP_WORDS + own + np.arange(1 << 16) % 7).astype(np.uint8)
        best = np.argsort(-count, kind="stable")[:own]
        best = best[count[best] > 0]
        out[best] = (1 + TOP_WORDS + np.arange(len(best))).astype(np.uint8)
        return ClassPlan(out)


# --- the network ----------------------------------------------------------

def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def new_network(seed: int = 1) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    h, c = HIDDEN, CLASSES
    return {"E": rng.normal(0, .3, (c, 3 * h)).astype(np.float32), "U": rng.normal(0, .25, (h, 3 * h)).astype(np.float32),
            "W": rng.normal(0, .1, (h, c)).astype(np.float32), "b": np.zeros(c, np.float32)}


def step(p: dict, h: np.ndarray, seen: np.ndarray) -> tuple:
    """One gated step after reading classes ``seen``."""
    n = HIDDEN
    x, g = p["E"][seen], h @ p["U"]
    zr = sigmoid(x[:, :2 * n] + g[:, :2 * n])
    z, r = zr[:, :n], zr[:, n:]
    new = np.tanh(x[:, 2 * n:] + r * g[:, 2 * n:])
    return new + z * (h - new), z, r, new, g


def log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(axis=1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=1, keepdims=True))


def gradients(p: dict, h: np.ndarray, seen: np.ndarray, fresh: np.ndarray, target: np.ndarray) -> tuple:
    """(loss, gradients, last state) of a window; all arrays (steps, lanes);
    ``fresh`` marks the first token of a text; target -1: none."""
    n, states = HIDDEN, []
    for t in range(len(seen)):
        h = np.where(fresh[t][:, None], 0, h)
        out = step(p, h, seen[t])
        states.append((h, *out))
        h = out[0]
    hs = np.stack([s[1] for s in states])
    flat, y = hs.reshape(-1, n), target.ravel()
    ok = y >= 0
    lp = log_softmax(flat @ p["W"] + p["b"])
    loss = -lp[np.arange(len(y)), np.maximum(y, 0)][ok].sum()
    d = np.exp(lp)
    d[np.arange(len(y)), np.maximum(y, 0)] -= 1
    d[~ok] = 0
    d /= max(1, ok.sum())
    grad = {"W": flat.T @ d, "b": d.sum(axis=0), "U": np.zeros_like(p["U"]), "E": np.zeros_like(p["E"])}
    dh_out = (d @ p["W"].T).reshape(hs.shape)
    carry = np.zeros_like(h)
    dxs = np.empty((*seen.shape, 3 * n), hs.dtype)
    for t in range(len(seen) - 1, -1, -1):
        before, _, z, r, new, g = states[t]
        dh = dh_out[t] + carry
        dnew = dh * (1 - z) * (1 - new * new)
        dz = dh * (before - new) * z * (1 - z)
        dr = dnew * g[:, 2 * n:] * r * (1 - r)
        dg = np.concatenate([dz, dr, dnew * r], axis=1)
        dxs[t] = np.concatenate([dz, dr, dnew], axis=1)
        grad["U"] += before.T @ dg
        carry = np.where(fresh[t][:, None], 0, dg @ p["U"].T + dh * z)
    one = np.zeros((seen.size, len(p["E"])), hs.dtype)
    one[np.arange(seen.size), seen.ravel()] = 1
    grad["E"] = one.T @ dxs.reshape(seen.size, -1)
    return loss, grad, h


class Adam:
    """Adam steps on the weights ``p``."""

    def __init__(self, p: dict[str, np.ndarray]):
        self.p, self.i = dict(p), 0
        self.m, self.v = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))

    def run(self, seen: np.ndarray, fresh: np.ndarray, target: np.ndarray, rate: float) -> None:
        """One pass over (steps, lanes), gradient cut every WINDOW steps,
        state carried on."""
        h = np.zeros((seen.shape[1], HIDDEN), np.float32)
        for a in range(0, len(seen), WINDOW):
            _, grad, h = gradients(self.p, h, seen[a:a + WINDOW], fresh[a:a + WINDOW], target[a:a + WINDOW])
            self.i += 1
            for k in self.p:
                g = np.clip(grad[k], -1, 1)
                self.m[k] += 0.1 * (g - self.m[k])
                self.v[k] += 0.01 * (g * g - self.v[k])
                self.p[k] = self.p[k] - (rate * (self.m[k] / (1 - 0.9 ** self.i))
                                         / (np.sqrt(self.v[k] / (1 - 0.99 ** self.i)) + 1e-6)).astype(np.float32)


def train_network(texts: list[np.ndarray], epochs: int = 2, rate: float = 0.01) -> dict[str, np.ndarray]:
    """Trains on class sequences (Adam, gradient cut every WINDOW steps, state
    carried on)."""
    net = Adam(new_network())
    texts = [t for t in texts if len(t)]
    for epoch in range(epochs if texts else 0):
        net.run(*lanes_of(texts, LANES, np.random.default_rng(epoch).permutation(len(texts))), rate)
    return net.p


def stream_lanes(classes: np.ndarray, before: np.ndarray, lanes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(seen, fresh, target) of (steps, lanes): all texts in a row (as for
    ``class_log10``), cut into lanes of equal length; a text that is cut goes
    on in the next lane, so that no length of a text leaves any of it out."""
    n = len(classes)
    # few lanes where there is little text, for steps enough
    lanes = max(1, min(lanes, n // WINDOW, max(8, n // (50 * WINDOW))))
    steps = math.ceil(n / lanes)
    fresh = np.zeros(steps * lanes, bool)
    fresh[before[:-1]] = True
    target = np.full(steps * lanes, -1)
    target[:n] = classes
    seen = np.full(steps * lanes, END)
    seen[1:n] = classes[:-1]
    seen[fresh] = END
    return tuple(np.ascontiguousarray(x.reshape(lanes, steps).T) for x in (seen, fresh, target))


def lanes_of(texts: list[np.ndarray], lanes: int, order) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(seen, fresh, target) of (steps, lanes): texts dealt to lanes, each
    lane's texts one after the other."""
    rows: list[list[np.ndarray]] = [[] for _ in range(lanes)]
    size = np.zeros(lanes, np.int64)
    for i in order:
        k = int(size.argmin())
        rows[k].append(texts[i])
        size[k] += len(texts[i])
    steps = int(size.max())
    seen, target = np.zeros((steps, lanes), np.int64), np.full((steps, lanes), -1)
    fresh = np.zeros((steps, lanes), bool)
    for k, parts in enumerate(rows):
        at = 0
        for t in parts:
            target[at:at + len(t), k] = t
            seen[at, k], fresh[at, k] = END, True
            seen[at + 1:at + len(t), k] = t[:-1]
            at += len(t)
    return seen, fresh, target


def class_log10(p: dict, classes: np.ndarray, before: np.ndarray, lanes: int = 512, window: int = 64) -> np.ndarray:
    """log10 probability of the classes of each text (END included).

    ``classes``: all texts' class sequences in a row, each with its END;
    ``before``: tokens before each text.  Texts run in lanes, longest first,
    and every lane's state is carried from window to window; lanes that have
    ended are left out.
    """
    sizes = np.diff(before)
    score = np.zeros(len(sizes))
    lanes = max(1, min(lanes, len(sizes)))
    order = np.argsort(-sizes, kind="stable")
    load = [(0, k) for k in range(lanes)]
    import heapq

    queue: list[list[int]] = [[] for _ in range(lanes)]
    for d in order.tolist():
        n, k = heapq.heappop(load)
        queue[k].append(d)
        heapq.heappush(load, (n + int(sizes[d]), k))
    queue.sort(key=lambda q: -int(sizes[q].sum()) if q else 0)
    length = np.array([int(sizes[q].sum()) for q in queue])
    # each lane as one row of token positions
    flat = np.concatenate([np.arange(before[d], before[d + 1]) for q in queue for d in q])
    owner = np.repeat(np.concatenate([np.array(q) for q in queue if q]), sizes[np.concatenate([q for q in queue if q])])
    start = np.cumsum(length) - length
    first = np.zeros(len(classes), bool)
    first[before[:-1]] = True
    seen_all = np.r_[END, classes[:-1]]
    seen_all[first] = END
    h = np.zeros((lanes, HIDDEN), np.float32)
    for a in range(0, int(length.max()), window):
        live = int((length > a).sum())
        end = min(a + window, int(length.max()))
        kept, places = [], []
        for t in range(a, end):
            n = int((length[:live] > t).sum())
            at = start[:n] + t
            pos = flat[at]
            state = h[:n] * ~first[pos][:, None]
            h[:n] = step(p, state, seen_all[pos])[0]
            kept.append(h[:n].copy())
            places.append(at)
        at = np.concatenate(places)
        lp = log_softmax(np.concatenate(kept) @ p["W"] + p["b"])
        score += np.bincount(owner[at], lp[np.arange(len(at)), classes[flat[at]]].astype(float), len(sizes))
    return score / math.log(10)


# --- counts and scores ----------------------------------------------------

def bucket_words(hashes: np.ndarray, cells: np.ndarray, groups: int) -> tuple:
    """(distinct words by group, their endings' cells, groups, position of
    every token among them)."""
    words, first, back = np.unique(hashes, return_index=True, return_inverse=True)
    group = (mix(words) % np.uint64(groups)).astype(np.int64)
    order = np.argsort(group, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return words[order], cells[first][order], group[order], place[back]


def word_counts(docs: DataFrame, groups: int) -> DataFrame:
    """Rows of two kinds for ``docs`` (bucket, id, text, train): per bucket and
    group the training counts of the bucket's words (``totals``), and per
    group, with bucket -1, its sums by ending and most frequent words."""

    def send(key, t):
        hashes, cells, before = tokens(t["text"])
        words, kinds, group, place = bucket_words(hashes, cells, groups)
        train = np.repeat(t["train"].to_numpy(), np.diff(before))
        count = np.bincount(place[train], minlength=len(words)).astype(np.uint32)
        rows = [(int(g), key[0].as_py(), pack(words[a:b]), pack(kinds[a:b].astype(np.uint16)), pack(count[a:b]))
                for g, a, b in by_limits(group)]
        g, k, w, c, n = zip(*rows) if rows else ((),) * 5
        return pa.table({"group": pa.array(g, pa.int64()), "bucket": pa.array(k, pa.int32()),
                         "words": pa.array(w, pa.binary()), "kinds": pa.array(c, pa.binary()),
                         "counts": pa.array(n, pa.binary())})

    def meet(key, t):
        parts = [unpack(x.as_py(), np.uint64) for x in t["words"]]
        words = np.concatenate(parts)
        sizes = np.cumsum([0] + [len(x) for x in parts])
        kinds = np.concatenate([unpack(x.as_py(), np.uint16) for x in t["kinds"]])
        counts = np.concatenate([unpack(x.as_py(), np.uint32) for x in t["counts"]])
        distinct, first, back = np.unique(words, return_index=True, return_inverse=True)
        total = np.bincount(back, counts, len(distinct)).astype(np.int64)
        kind = kinds[first]
        ending, at = np.unique(kind, return_inverse=True)
        ends = pa.StructArray.from_arrays(
            [pa.array(ending.astype(np.int32)), pa.array(np.bincount(at, total).astype(np.int64)),
             pa.array(np.bincount(at, total > 0).astype(np.int64))], ["cell", "n", "v"])
        best = np.lexsort((distinct, -total))[:TOP_WORDS]
        top = [{"word": int(distinct[i].view(np.int64)), "n": int(total[i]), "kind": int(kind[i])} for i in best if total[i]]
        n = t.num_rows
        wide = total[back]
        return pa.table({
            "bucket": pa.array(t["bucket"].to_pylist() + [-1], pa.int32()),
            "group": pa.array([key[0].as_py()] * (n + 1), pa.int64()),
            "totals": pa.array([pack(wide[a:b]) for a, b in zip(sizes, sizes[1:])] + [None], pa.binary()),
            "endings": pa.array([None] * n + [ends.to_pylist()], pa.list_(ends.type)),
            "top": pa.array([None] * n + [top], pa.list_(pa.struct([("word", pa.int64()), ("n", pa.int64()), ("kind", pa.int32())])))})

    sent = docs.groupBy("bucket").applyInArrow(send, "group long, bucket int, words binary, kinds binary, counts binary")
    return sent.groupBy("group").applyInArrow(
        meet, "bucket int, group long, totals binary, endings array<struct<cell:int,n:long,v:long>>, "
              "top array<struct<word:long,n:long,kind:int>>")


def training_sample(docs: DataFrame, train_docs: int) -> list[tuple[np.ndarray, np.ndarray, bool]]:
    """(word hashes, cells, whole) of at most ``train_docs`` training texts,
    the smallest by a hash of their id; the longest ones are cut at the length
    that makes all ``TRAIN_WORDS`` words."""
    ids = [r["id"] for r in docs.where("train AND id IS NOT NULL").select("id", F.xxhash64("id").alias("h"))
           .orderBy("h", "id").limit(train_docs).collect()]
    rows = docs.where("train").where(F.col("id").isin(ids)).groupBy("id").agg(F.min("text").alias("text")).collect()
    texts = [tokens(pa.array([r["text"]], pa.string()))[:2] for r in sorted(rows, key=lambda r: r["id"])]
    room, most = TRAIN_WORDS, 0
    for i, n in enumerate(sorted(len(h) for h, _ in texts)):
        most = max(n, 1) if n * (len(texts) - i) <= room else max(1, room // (len(texts) - i))
        if most < n:
            break
        room -= n
    return [(h[:most], c[:most], len(h) <= most) for h, c in texts]


def train_round(docs: DataFrame, network: dict[str, np.ndarray], classes, rate: float, buckets: int) -> dict[str, np.ndarray]:
    """The mean, by tokens, of the networks that the buckets of ``docs``
    (bucket, id, text) train from ``network``; ``classes(hashes, cells)``."""
    names = sorted(network)
    parts = math.isqrt(buckets) + 1

    def learn(key, t):
        release()
        t = t.sort_by([("id", "ascending"), ("text", "ascending")])
        hashes, cells, before = tokens(t["text"])
        seq, marks = with_ends(classes(hashes, cells), before)
        net = Adam(network)
        net.run(*stream_lanes(seq, marks, ROUND_LANES), rate)
        flat = np.concatenate([net.p[k].ravel() for k in names]).astype(np.float32)
        k = key[0].as_py()
        return pa.table({"part": pa.array([k % parts], pa.int32()), "bucket": pa.array([k], pa.int32()),
                         "n": pa.array([len(seq)], pa.int64()), "weights": pa.array([flat.tobytes()], pa.binary())})

    def add(key, t):
        t = t.sort_by("bucket")  # the order of sums is fixed
        total = sum(n.as_py() * np.frombuffer(w.as_buffer(), np.float32).astype(float) for n, w in zip(t["n"], t["weights"]))
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "n": pa.array([sum(t["n"].to_pylist())], pa.int64()),
                         "weights": pa.array([total.tobytes()], pa.binary())})

    rows = (docs.groupBy("bucket").applyInArrow(learn, "part int, bucket int, n long, weights binary")
            .groupBy("part").applyInArrow(add, "part int, n long, weights binary").collect())
    if not rows:
        return network
    rows.sort(key=lambda r: r["part"])
    flat = sum(np.frombuffer(r["weights"]) for r in rows) / sum(r["n"] for r in rows)
    out, at = {}, 0
    for k in names:
        out[k] = flat[at:at + network[k].size].reshape(network[k].shape).astype(np.float32)
        at += network[k].size
    return out


def with_ends(classes: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(classes with an END after each text, tokens before each text)."""
    marks = before + np.arange(len(before))
    seq = np.full(int(marks[-1]), END, np.int64)
    body = np.ones(len(seq), bool)
    body[marks[1:] - 1] = False
    seq[body] = classes
    return seq, marks


def score_documents(df: DataFrame, id_col: str, text_col: str, train: Column, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """(id, n_tokens, n_known, train_tokens, base_score, score) of each row.

    ``train`` marks the rows to learn from (null: not).  A null or empty text
    is the end token alone.  Equal rows are scored alike, null ids too.  base_score
    is the add-one unigram log10 probability, score the model's; both are
    over all tokens of the whole text.  Without training rows every token is
    unknown.  An empty table gives no rows.
    """
    flagged = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                        F.coalesce(train, F.lit(False)).alias("train"))
    docs, size = bucketed(flagged, "id", "text", extra=["train"])
    groups = max(1, math.ceil(size["bytes"] / 40 / GROUP_WORDS))
    counted = checkpointed(word_counts(docs, groups))
    stats = counted.where("bucket = -1")
    sums = (stats.select(F.explode("endings").alias("e")).select("e.*")
            .groupBy("cell").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).toArrow())
    cell_n, cell_v = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
    cell_n[sums["cell"].to_numpy()], cell_v[sums["cell"].to_numpy()] = sums["n"].to_numpy(), sums["v"].to_numpy()
    plan = ClassPlan.fit(cell_n)
    class_n, class_v = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
    np.add.at(class_n, plan.ending_class, cell_n)
    np.add.at(class_v, plan.ending_class, cell_v)
    ends = flagged.where("train").count()
    top = stats.select(F.explode("top").alias("t")).select("t.*").orderBy(F.desc("n"), "word").limit(TOP_WORDS).collect()
    train_tokens, distinct = int(class_n.sum()) + ends, int(class_v.sum()) + (ends > 0)
    own = np.sort(np.array([r["word"] for r in top], np.int64).view(np.uint64))
    for r in top:  # a frequent word leaves the class of its ending
        class_n[plan.ending_class[r["kind"]]] -= r["n"]
        class_v[plan.ending_class[r["kind"]]] -= 1

    def classes_of(words: np.ndarray, cells: np.ndarray) -> np.ndarray:
        out = plan.ending_class[cells].astype(np.int64)
        if len(own) and len(words):
            at = np.minimum(np.searchsorted(own, words), len(own) - 1)
            out = np.where(own[at] == words, 1 + at, out)
        return out

    network = train_network([np.r_[classes_of(w, c), [END] * whole].astype(np.int64)
                             for w, c, whole in training_sample(docs, train_docs)])
    share = F.pmod(F.xxhash64("id", "text", F.lit(7)), F.lit(ROUNDS))
    for i in range(ROUNDS):
        network = train_round(docs.where("train").where(share == i), network, classes_of, ROUND_RATE / 2 ** i, size["buckets"])
    # inside a class: add-one shares with a slot for unknown words; own classes hold one word
    room = np.log10(np.maximum(1, class_n + class_v + 1).astype(float))
    base_room = math.log10(train_tokens + distinct + 1)

    def finish(key, t, got):
        hashes, cells, before = tokens(t["text"])
        words, kinds, group, place = bucket_words(hashes, cells, groups)
        totals = {g.as_py(): unpack(x.as_py(), np.int64) for g, x in zip(got["group"], got["totals"])}
        total = np.concatenate([totals[int(g)] for g, _, _ in by_limits(group)]) if len(words) else np.empty(0, np.int64)
        kind = classes_of(words, kinds)
        n = np.diff(before)
        docs = len(n)
        doc = np.repeat(np.arange(docs), n)
        known, log_count = total[place] > 0, np.log10(total + 1.0)
        in_class = np.where(kind > TOP_WORDS, log_count - room[kind], 0.0)
        base = np.bincount(doc, log_count[place], docs) + math.log10(ends + 1) - (n + 1) * base_room
        score = np.bincount(doc, in_class[place], docs)
        seq, marks = with_ends(kind[place], before)
        score = score + class_log10(network, seq, marks)
        return pa.table({"id": t["id"], "n_tokens": pa.array(n + 1, pa.int64()),
                         "n_known": pa.array(np.bincount(doc, known, docs).astype(np.int64) + (ends > 0)),
                         "train_tokens": pa.array(np.full(docs, train_tokens), pa.int64()),
                         "base_score": pa.array(base), "score": pa.array(score)})

    back = counted.where("bucket >= 0").select("bucket", "group", "totals")
    return docs.groupBy("bucket").cogroup(back.groupBy("bucket")).applyInArrow(
        finish, "id long, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op5_gru_lm(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    out = score_documents(docs, "doc_id", "text", ~held_out("doc_id", 7, 2))
    return out.select(F.col("id").alias("doc_id"), held_out("id", 7, 2).alias("held_out"), "n_tokens", "n_known",
                      "train_tokens", "base_score", "score")
