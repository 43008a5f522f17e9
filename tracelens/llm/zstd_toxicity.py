"""Toxicity by compression distance.

Two zstandard dictionaries are built from labelled text: both hold a part
trained on windows of all text, each also the segments that are typical of
its own label.  A text is cut into short windows; each is compressed with
either dictionary, and the bytes that the toxic dictionary saves over the
ordinary one measure its toxicity.  A calibrated logistic function of the
savings (windows over thresholds, largest savings) is the score.

Training reads at most ``docs_per_label`` texts of each label, the smallest
by a hash of their id, and for the shared part at most SHARED_SAMPLES of their
windows, spread evenly; everything else covers all windows of all texts.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, table
from .ss_packing import text_blocks

#: Labelled texts of each label that training reads.
DOCS_PER_LABEL = 1500
WINDOW_WORDS = 3
#: Matches from three bytes on, chosen by their price (strategy 7): a stem of
#: four letters already shortens its window.  Small tables, as windows are short.
PARSE = {"window_log": 14, "hash_log": 12, "chain_log": 12, "search_log": 4, "min_match": 3, "target_length": 32,
         "strategy": 7}
#: Bytes of the dictionaries' shared part and of each label's own part.
SHARED_BYTES, OWN_BYTES = 600, 2048
SHARED_SAMPLES = 60_000
#: Begins every window and ends both dictionaries: one long match, so that even a
#: short window is stored compressed and each further match shows in its length.
HEAD = bytes(range(128, 192))
#: Characters of a longer word or gap that stay in one window.
WINDOW_CHARS = 400
PUNCTUATION = ".,;:!?'()[]*#%&$" + '"'
#: z score from which a segment is typical of a label.
LEAST_Z = 4.5
#: Savings in bytes from which a window counts.
THRESHOLDS = (1, 2, 3, 4, 6)
#: What catching a share of the ordinary texts costs, in shares of the toxic
#: ones, where the calibration places the score 0.5.
FALSE_COST = 3.0


def windows(text: str, words: int = WINDOW_WORDS) -> list[bytes]:
    """The text's words, lower-cased, in runs of ``words``; a run longer than
    WINDOW_CHARS is cut."""
    w = text.lower().split()
    out = []
    for i in range(0, len(w), words):
        s = f" {' '.join(w[i:i + words])} "
        if len(s) <= WINDOW_CHARS:
            out.append(HEAD + s.encode())
        else:
            out.extend(HEAD + s[j:j + WINDOW_CHARS].encode() for j in range(0, len(s), WINDOW_CHARS))
    return out


def segments(text: str) -> set[str]:
    """Words without outer punctuation, pairs of them, and beginnings of 4 to
    7 letters of longer words; each after a space."""
    w = [x.strip(PUNCTUATION) for x in text.lower().split()]
    w = [x for x in w if 2 < len(x) <= 40]
    out = {f" {x} " for x in w} | {f" {a} {b} " for a, b in zip(w, w[1:])}
    for k in range(4, 8):
        out.update(f" {x[:k]}" for x in w if len(x) > k)
    return out


def typical_segments(own: list[str], other: list[str], size: int) -> str:
    """Segments in clearly more texts of ``own`` than of ``other``, the
    strongest last, about ``size`` characters.  The order is the z score of
    the two shares, of at least LEAST_Z; a segment that stands in a stronger
    one or that holds one adds nothing and is left out."""
    a, b = Counter(), Counter()
    for t in own:
        a.update(segments(t))
    for t in other:
        b.update(segments(t))
    n, m = max(1, len(own)), max(1, len(other))
    z = {}
    for s, c in a.items():
        if c >= 5:
            p = (c + b[s]) / (n + m)
            z[s] = (c / n - b[s] / m) / math.sqrt(p * (1 - p) * (1 / n + 1 / m) + 1e-12)
    chosen: list[str] = []
    used = 0
    for s in sorted((s for s in z if z[s] >= LEAST_Z), key=lambda s: (-z[s], -len(s), s)):
        if used + len(s) < size and not any(s in c or c in s for c in chosen):
            chosen.append(s)
            used += len(s)
    return "".join(reversed(chosen)) + " "


def shared_content(texts: list[str], size: int) -> bytes:
    import zstandard

    samples = [w[len(HEAD):] for t in texts for w in windows(t, 8)]
    samples = samples[::max(1, -(-len(samples) // SHARED_SAMPLES))]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()[-size:]
    except zstandard.ZstdError:  # too few samples for the trainer
        return b"".join(samples)[-size:]


class Distance:
    """Compressors with the ordinary and the toxic dictionary, and the
    calibrated score."""

    def __init__(self, dictionaries: tuple[bytes, bytes], model: tuple):
        self.dictionaries, self.model = dictionaries, model

    def parts(self) -> tuple:
        return self.dictionaries, self.model

    def start(self) -> "Distance":
        import zstandard as z

        how = z.ZstdCompressionParameters(**PARSE, write_content_size=False, write_checksum=False, write_dict_id=False)
        self.compressors = []
        for raw in self.dictionaries:
            d = z.ZstdCompressionDict(raw, dict_type=z.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(compression_params=how)
            self.compressors.append(z.ZstdCompressor(dict_data=d, compression_params=how))
        return self

    def savings(self, parts: list[bytes]) -> np.ndarray:
        """Bytes that the toxic dictionary saves on each window."""
        ordinary, toxic = (c.compress for c in self.compressors)
        return np.fromiter((len(ordinary(p)) - len(toxic(p)) for p in parts), np.int64, len(parts))

    def features(self, texts: list[str]) -> np.ndarray:
        """Per text: share and log count of windows over each threshold, the
        largest saving and the sum of the three largest."""
        rows = []
        for t in texts:
            parts = windows(t)
            s = np.sort(self.savings(parts)) if parts else np.zeros(1, np.int64)
            over = [len(s) - int(np.searchsorted(s, k)) for k in THRESHOLDS]
            n = max(1, len(parts))
            rows.append([x for c in over for x in (math.sqrt(c / n), math.log1p(c))]
                        + [max(0, int(s[-1])), max(0, int(s[-3:].sum())), math.log1p(n)])
        return np.array(rows, float).reshape(len(texts), 2 * len(THRESHOLDS) + 3)

    def scores(self, texts: list[str]) -> np.ndarray:
        if not texts:
            return np.empty(0)
        mean, scale, w = self.model
        f = self.features(texts)
        x = (f - mean) / scale
        s = 1 / (1 + np.exp(-np.clip(x @ w[1:] + w[0], -30, 30)))
        return np.where([bool(t.strip()) for t in texts], s, 0.0)


def logistic(x: np.ndarray, y: np.ndarray, rounds: int = 25, ridge: float = 1.0) -> np.ndarray:
    """Weights (bias first) by Newton steps."""
    x = np.c_[np.ones(len(x)), x]
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w += np.linalg.solve(h, x.T @ (y - p) - ridge * w)
    return w


def best_cut(x: np.ndarray, y: np.ndarray) -> float:
    """The value between two neighbours of ``x`` above which the share of
    label 1 less FALSE_COST times the share of label 0 is largest (ties: the
    largest value)."""
    order = np.argsort(-x, kind="stable")
    caught = np.cumsum(y[order]) / max(1, y.sum())
    wrong = np.cumsum(1 - y[order]) / max(1, (1 - y).sum())
    gain = np.r_[0.0, caught - FALSE_COST * wrong]
    ordered = np.r_[x[order][0] + 2.0, x[order], x[order][-1] - 2.0]
    gain[1:-1][ordered[1:-2] == ordered[2:-1]] = -np.inf  # no cut between equals
    k = int(gain.argmax())
    return float(ordered[k] + ordered[k + 1]) / 2


def train_distance(rows: list[tuple[int, str]]) -> Distance:
    """A model from (label, text) rows.  Copies count once.  The dictionaries
    come from two thirds of the rows; the other third sets the weights, and
    the bias such that 0.5 is the best cut (``best_cut``)."""
    rows = sorted(set(rows))
    toxic = [t for y, t in rows if y == 1]
    ordinary = [t for y, t in rows if y == 0]
    size = 2 * len(THRESHOLDS) + 3
    if not toxic or not ordinary:
        w = np.zeros(size + 1)
        w[0] = 5.0 if toxic else -5.0
        return Distance((b" ", b" "), (np.zeros(size), np.ones(size), w))
    # dictionaries and calibration use different parts
    half = [(y, t) for i, (y, t) in enumerate(rows) if i % 3]
    rest = [(y, t) for i, (y, t) in enumerate(rows) if not i % 3]
    a, b = [t for y, t in half if y == 1], [t for y, t in half if y == 0]
    shared = shared_content([t for _, t in half][::3], SHARED_BYTES)
    parts = [typical_segments(own, other, OWN_BYTES).encode() for own, other in ((b, a), (a, b))]
    # three copies, each one byte further modulo three: not every position is
    # indexed, but one in three is, so every segment's begin is in one copy
    parts = [(p + b" " * ((1 - len(p)) % 3)) * 3 for p in parts]
    most = max(map(len, parts))
    # equal lengths keep the shared part at the same distance in both; the
    # last bytes of a dictionary are not indexed, so no segment may stand there
    model = Distance(tuple(shared + b" " * (most - len(p)) + p + HEAD for p in parts), ())
    model.start()
    use = rest if len({y for y, _ in rest}) == 2 else rows
    x, y = model.features([t for _, t in use]), np.array([y for y, _ in use], float)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    x = (x - mean) / scale
    w = logistic(x, y)
    w[0] -= best_cut(x @ w[1:] + w[0], y)
    return Distance(model.dictionaries, (mean, scale, w))


def train_toxicity(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
                   docs_per_label: int = DOCS_PER_LABEL) -> Distance:
    """Trains on the rows of ``docs`` that ``labels`` marks 0 or 1 (a document
    with several labels has the largest)."""
    marks = (labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("y")))
    picked = {}
    for y in (0, 1):  # a top-n by label: no task holds all rows of one
        smallest = marks.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(docs_per_label)
        picked.update({r["id"]: y for r in smallest.select("id").collect()})
    texts = (docs.where(F.col(id_col).isin(list(picked)) & F.col(text_col).isNotNull())
             .groupBy(F.col(id_col).alias("id")).agg(F.min(text_col).alias("text")).collect())
    return train_distance([(picked[r["id"]], r["text"]) for r in texts])


def score_toxicity(df: DataFrame, text_col: str, model: Distance, out_col: str) -> DataFrame:
    """df with ``out_col``, the toxicity (0 to 1) of each row's whole text.

    A null or empty text, or one of white space, gets 0.  A text of any length
    is judged by all its windows, equal texts get equal scores.  Every row
    is judged on its own; other columns pass unchanged (one named ``out_col``
    is replaced); an empty table stays empty.
    """
    sent = df.sparkSession.sparkContext.broadcast(model.parts())

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = Distance(*sent.value).start()
        for texts in batches:
            got = [m.scores(part) for part in text_blocks(texts.to_pylist())]
            yield pa.array(np.concatenate(got) if got else np.empty(0), pa.float64())

    return df.withColumn(out_col, score(F.col(text_col)))


def op6_zstd_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("held_out", held_out("doc_id", 5, 0))
    labels = table(spark, sf_dir, "labels").where(~held_out("doc_id", 5, 0))
    model = train_toxicity(docs.where("NOT held_out"), labels, "doc_id", "text", "toxic")
    out = score_toxicity(docs, "text", model, "score")
    return out.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
