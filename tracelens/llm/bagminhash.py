"""Near-duplicates by BagMinHash signatures of word-shingle multisets.

A document is the multiset of its runs of five words.  Every unit of a
shingle's multiplicity carries a Poisson process of points (time, register);
a register keeps the earliest time it is hit at, so two documents agree in a
register with probability equal to their weighted Jaccard similarity.  The
units of multiplicity [2^(o-1), 2^o) form one process per octave o, and only
the octave that a multiplicity ends in is split into halves.  Points are made
in order of time up to a bound that fills all registers, doubled where not.

Signatures are banded; the members of a band's bucket are compared with the
bucket's smallest members; members of different classes that still meet in a
bucket are compared in full, in blocks inside tasks.  So no link between
classes is lost, and no pairs of a group are written out.  Every link is
verified on the exact multisets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, checkpointed, hashed_words, mix, random_words, table, utf8, window_hashes
from .graph import components, lowest

WORDS = 5
SIMILARITY = 0.8
#: A pair at the threshold misses every band once in 10^7 cases.
BANDS, ROWS = 32, 4
STEP = np.uint64(0x9E3779B97F4A7C15)


def shingles(array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, shingle, multiplicity) rows of a text column, sorted.  A
    text of fewer words is one shingle; one without words has none."""
    hashes, before = hashed_words(array)
    n = np.diff(before)
    full = window_hashes(hashes, words, 3)
    doc_of = np.repeat(np.arange(len(n)), n)
    left = before[1:][doc_of] - np.arange(len(hashes)) if len(hashes) else np.empty(0, np.int64)
    starts = np.flatnonzero(left >= words)
    docs, keys = [doc_of[starts]], [full[starts] if len(starts) else np.empty(0, np.uint64)]
    for d in np.flatnonzero((n > 0) & (n < words)):
        part = np.zeros(words, np.uint64)
        part[:n[d]] = hashes[before[d]:before[d + 1]]
        docs.append(np.array([d]))
        keys.append(window_hashes(part, words, 3) + np.uint64(n[d]))
    doc, key = np.concatenate(docs), np.concatenate(keys)
    order = np.lexsort((key, doc))
    doc, key = doc[order], key[order]
    if not len(doc):
        return doc, key, np.empty(0, np.int64)
    first = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])])
    return doc[first], key[first], np.diff(np.r_[first, len(doc)])


def uniform(state: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1] from 64-bit states."""
    return ((state >> np.uint64(11)).astype(np.float64) + 1) * 2.0 ** -53


def octave_processes(key: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The processes below each multiplicity: (element, state, rate, first
    time).  Octave o holds the units from 2^(o-1) to 2^o (octave 0: the first
    unit).  A whole octave is one process; the last one is halved until the
    halves lie inside or outside the multiplicity: the first point of the
    whole falls into either half alike, the other half's first point comes
    an exponential time later."""
    out = []
    element = np.arange(len(key))
    low = np.zeros(len(key), np.int64)
    width = np.ones(len(key), np.int64)
    octave = 0
    with np.errstate(over="ignore"):
        while len(element):
            state = mix(key[element] + np.uint64(octave + 1) * STEP)
            time = -np.log(uniform(mix(state ^ STEP))) / width
            e, s, lo, w, t = element, state, low[element], width.copy(), time
            while len(e):
                c = count[e]
                inside = lo + w <= c
                out.append((e[inside], s[inside], w[inside].astype(float), t[inside]))
                cut = (lo < c) & ~inside
                e, s, lo, w, t = e[cut], s[cut], lo[cut], w[cut] // 2, t[cut]
                if not len(e):
                    break
                left, right = mix(s + STEP), mix(s + STEP * np.uint64(2))
                to_left = (left ^ right) & np.uint64(1) == 0
                later = t - np.log(uniform(mix(left + right))) / w
                e, s, lo, w, t = (np.r_[e, e], np.r_[left, right], np.r_[lo, lo + w], np.r_[w, w],
                                  np.r_[np.where(to_left, t, later), np.where(to_left, later, t)])
            start = 1 << octave
            element = element[count[element] > start]
            low = np.full(len(key), start, np.int64)
            width = np.full(len(element), start, np.int64)
            octave += 1
    return tuple(np.concatenate(x) for x in zip(*out)) if out else tuple(np.empty(0) for _ in range(4))


def signatures(doc: np.ndarray, key: np.ndarray, count: np.ndarray, docs: int, registers: int) -> np.ndarray:
    """(docs, registers) states of the points that registers keep; a document
    without shingles has zeros."""
    best = np.full(docs * registers, np.inf)
    kept = np.zeros(docs * registers, np.uint64)
    if not len(doc):
        return kept.reshape(docs, registers)
    element, state, rate, time = octave_processes(key, count)
    owner = doc[element]
    weight = np.bincount(doc, count, docs)
    until = np.zeros(docs)
    has = weight > 0
    until[has] = registers * (np.log(registers) + 2) / weight[has]
    with np.errstate(over="ignore", divide="ignore"):
        while len(owner):
            o, s, r, t = owner, state, rate, time
            rest = []  # the processes' next points, beyond the bound
            while len(o):
                now = t <= until[o]
                rest.append((o[~now], s[~now], r[~now], t[~now]))
                o, s, r, t = o[now], s[now], r[now], t[now]
                slot = o * registers + (mix(s + STEP * np.uint64(5)) % np.uint64(registers)).astype(np.int64)
                np.minimum.at(best, slot, t)
                win = t == best[slot]
                kept[slot[win]] = s[win]
                s = mix(s + STEP * np.uint64(9))
                t = t - np.log(uniform(mix(s ^ STEP))) / r
            owner, state, rate, time = (np.concatenate(x) for x in zip(*rest))
            filled = np.isfinite(best).reshape(docs, registers).all(axis=1) | ~has
            until = np.where(filled, until, 2 * until)
            go = ~filled[owner]
            owner, state, rate, time = owner[go], state[go], rate[go], time[go]
    return kept.reshape(docs, registers)


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(docs, bands) bucket numbers."""
    weights = random_words(rows, 17)
    with np.errstate(over="ignore"):
        x = (mix(sig).reshape(len(sig), bands, rows) * weights).sum(axis=2, dtype=np.uint64)
        return mix(x + np.arange(bands, dtype=np.uint64) * STEP).view(np.int64)


def weighted_jaccard(a: pa.Array, b: pa.Array, words: int) -> np.ndarray:
    """Exact similarity of the shingle multisets of paired texts; 0 where
    either has none."""
    n = len(a)
    (da, ka, ca), (db, kb, cb) = shingles(a, words), shingles(b, words)
    doc, key = np.r_[da, db], np.r_[ka, kb]
    x, y = np.r_[ca, np.zeros_like(cb)], np.r_[np.zeros_like(ca), cb]
    order = np.lexsort((key, doc))
    doc, key, x, y = doc[order], key[order], x[order], y[order]
    if not len(doc):
        return np.zeros(n)
    first = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])])
    x, y, doc = np.add.reduceat(x, first), np.add.reduceat(y, first), doc[first]
    both, either = np.bincount(doc, np.minimum(x, y), n), np.bincount(doc, np.maximum(x, y), n)
    return np.divide(both, either, out=np.zeros(n), where=either > 0)


def document_buckets(docs: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    """(id, fp, buckets): a digest of the text and its bucket in every band;
    both null for a text without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for i, j in blocks(utf8(texts)[1], 1 << 20):
                part = texts.slice(i, j - i)
                doc, key, count = shingles(part, words)
                keys = band_keys(signatures(doc, key, count, j - i, bands * rows), bands, rows)
                has = np.bincount(doc, minlength=j - i) > 0
                fp = [hashlib.sha256(t.encode()).digest() if h else None for t, h in zip(part.to_pylist(), has)]
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(has * bands)], pa.int32()),
                                                 pa.array(keys[has].ravel(), pa.int64()))
                yield pa.RecordBatch.from_arrays([ids.slice(i, j - i), pa.array(fp, pa.binary()), lists],
                                                 ["id", "fp", "buckets"])

    return docs.select("id", "text").mapInArrow(run, "id long, fp binary, buckets array<long>")


def verified(pairs: DataFrame, texts: DataFrame, words: int, similarity: float) -> DataFrame:
    """(a, b) of the pairs whose similarity reaches the bound.  Spark splits
    the joins' skewed sides (a leader with many partners is one key)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t = pa.Table.from_batches([batch])
            # in blocks, as a long text can repeat in many pairs
            for i, j in blocks(utf8(t["ta"])[1] + utf8(t["tb"])[1], 1 << 20):
                part = t.slice(i, j - i)
                s = weighted_jaccard(part["ta"].combine_chunks(), part["tb"].combine_chunks(), words)
                yield from part.select(["a", "b"]).filter(pa.array(s >= similarity - 1e-12)).to_batches()

    sides = pairs.join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b")
    sides = sides.join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a")
    return sides.select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long").distinct()


def near_duplicates(df: DataFrame, id_col: str, text_col: str, words: int = WORDS, similarity: float = SIMILARITY,
                    bands: int = BANDS, rows: int = ROWS, leader_rounds: int = 2) -> DataFrame:
    """(id, class_id, kept): each document's class, named by its smallest id.

    Documents with equal texts are one class.  Others are linked when the
    weighted Jaccard similarity of their shingle multisets reaches
    ``similarity``; classes are what links connect.  A document without words
    (null, empty) is alone.  Rows that repeat an id are one document, near
    another if one of its texts is; a null id gives one row of class null,
    kept.  An empty table gives no rows.
    """
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    base = checkpointed(document_buckets(docs, words, bands, rows))
    known = base.where("id IS NOT NULL AND fp IS NOT NULL")
    rep = checkpointed(known.groupBy("fp").agg(F.min("id").alias("rep")))
    crowd = known.select("id", "fp", "buckets").join(rep, "fp").where("id = rep")
    crowd = crowd.select("id", F.explode("buckets").alias("bucket")).distinct()
    sizes = crowd.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("lead")).where("n > 1")
    shared = checkpointed(crowd.join(sizes, "bucket").select("bucket", "id", "lead"))
    # the texts that meet others, once each
    texts = checkpointed(docs.join(shared.select("id").distinct(), "id", "left_semi")
                         .groupBy("id", F.xxhash64("text").alias("h")).agg(F.first("text").alias("text"))
                         .select("id", "text"))
    tested = links = component = None
    for _ in range(leader_rounds):
        # each document meets the smallest leader of its buckets that is not in its class
        pairs = shared.where("id > lead").select(F.col("lead").alias("a"), F.col("id").alias("b"))
        if tested is not None:
            lead = component.select(F.col("node").alias("lead"), F.col("component").alias("lead_class"))
            pairs = (with_classes(shared.where("id > lead"), component).join(lead, "lead", "left")
                     .where(F.col("class") != F.coalesce("lead_class", "lead"))
                     .select(F.col("lead").alias("a"), F.col("id").alias("b")).join(tested, ["a", "b"], "left_anti"))
        pairs = checkpointed(pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"))
        if not pairs.take(1):
            break
        found = checkpointed(verified(pairs, texts, words, similarity))
        tested = pairs if tested is None else tested.union(pairs)
        links = found if links is None else links.union(found)
        component = checkpointed(components(links))
    if component is not None:
        # what still meets across classes is compared in full
        more = checkpointed(cross_class_links(with_classes(shared.select("bucket", "id"), component), texts, words,
                                              similarity))
        if more.take(1):
            component = checkpointed(components(links.union(more)))
    named = rep.select("fp", F.col("rep").alias("class_id"))
    if component is not None:
        named = (rep.join(component, rep["rep"] == component["node"], "left")
                 .select("fp", F.coalesce("component", "rep").alias("class_id")))
    out = (base.select("id", "fp").join(named, "fp", "left")
           .groupBy("id").agg(F.min(F.coalesce("class_id", "id")).alias("class_id")))
    return out.select("id", "class_id", (F.col("id").isNull() | (F.col("id") == F.col("class_id"))).alias("kept"))


def with_classes(rows: DataFrame, component: DataFrame) -> DataFrame:
    return (rows.join(component.withColumnRenamed("node", "id"), "id", "left")
            .withColumn("class", F.coalesce("component", "id")).drop("component"))


def meeting_units(rows: DataFrame, block: int) -> DataFrame:
    """(unit, kind, id, class, main, x_blocks, y_blocks) of (bucket, id,
    class) rows: where documents of different classes still meet.

    A unit is a bucket, or a cluster of documents that buckets connect,
    whichever means fewer texts to move: its documents outside the main class
    go in x blocks, all its documents in y blocks, every x meets every y.
    """
    per = rows.groupBy("bucket", "class").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("low"))
    per = per.groupBy("bucket").agg(F.sum("n").alias("n"), F.max(F.struct("n", "class")).alias("main"),
                                    F.count(F.lit(1)).alias("classes"), F.min("low").alias("lead"))
    per = per.where("classes > 1").select("bucket", "lead", "n", "main")
    rows = checkpointed(rows.join(per.select("bucket", "lead"), "bucket"))
    cluster = checkpointed(components(rows.select(F.col("id").alias("a"), F.col("lead").alias("b")).distinct()))
    rows = rows.join(cluster.select(F.col("node").alias("id"), F.col("component").alias("cluster")), "id")

    def costs(df):
        minor = F.col("n") - F.col("main.n")
        x, y = F.ceil(minor / block), F.ceil(F.col("n") / block)
        return df.select("*", F.col("main.class").alias("main_class"), x.cast("int").alias("x_blocks"),
                         y.cast("int").alias("y_blocks"), (F.col("n") * x + minor * y).alias("cost"))

    in_bucket = costs(per).join(cluster.select(F.col("node").alias("lead"), F.col("component").alias("cluster")), "lead")
    members = rows.select("cluster", "id", "class").distinct()
    whole = members.groupBy("cluster", "class").agg(F.count(F.lit(1)).alias("n"))
    whole = costs(whole.groupBy("cluster").agg(F.sum("n").alias("n"), F.max(F.struct("n", "class")).alias("main")))
    split = in_bucket.groupBy("cluster").agg(F.sum("cost").alias("split_cost"))
    whole = whole.join(split, "cluster").withColumn("together", F.col("cost") <= F.col("split_cost"))
    sizes = ["main_class", "x_blocks", "y_blocks"]
    one = members.join(whole.where("together").select("cluster", *sizes), "cluster").select(
        F.col("cluster").alias("unit"), F.lit(0).alias("kind"), "id", "class", *sizes)
    apart = in_bucket.join(whole.where("NOT together").select("cluster"), "cluster", "left_semi")
    many = rows.join(apart.select("bucket", *sizes), "bucket").select(
        F.col("bucket").alias("unit"), F.lit(1).alias("kind"), "id", "class", *sizes)
    return one.union(many)


def cross_class_links(rows: DataFrame, texts: DataFrame, words: int, similarity: float, block: int = 1024) -> DataFrame:
    """(a, b) links that connect what any link between documents of different
    classes in one bucket connects.  Texts meet in blocks inside tasks; no
    pairs are written out."""
    units = meeting_units(rows, block).join(texts, "id")
    every = (units.withColumn("y", F.pmod(F.xxhash64("id"), F.col("y_blocks")))
             .withColumn("x", F.explode(F.sequence(F.lit(0).cast("long"), F.col("x_blocks").cast("long") - 1))))
    minor = (units.where("class != main_class").withColumn("x", F.pmod(F.xxhash64("id"), F.col("x_blocks")))
             .withColumn("y", F.explode(F.sequence(F.lit(0).cast("long"), F.col("y_blocks").cast("long") - 1))))
    cols = ["unit", "kind", "x", "y", "id", "class", "text"]
    met = (every.select(*cols, F.lit(False).alias("minor")).union(minor.select(*cols, F.lit(True).alias("minor"))))

    def meet(key, t):
        ids, kinds, minor = t["id"].to_numpy(), t["class"].to_numpy(), t["minor"].to_numpy(zero_copy_only=False)
        doc, shingle, count = shingles(t["text"].combine_chunks(), words)
        size = np.bincount(doc, count, len(ids))
        # a shingle seen n times is n elements; only elements of several texts can be shared
        doc = np.repeat(doc, count)
        nth = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
        with np.errstate(over="ignore"):
            element = mix(np.repeat(shingle, count) + nth.astype(np.uint64) * STEP)
        _, element, copies = np.unique(element, return_inverse=True, return_counts=True)
        several = copies[element] > 1
        doc, element = doc[several], element[several]
        if len(element):
            _, element = np.unique(element, return_inverse=True)
        left, right = np.flatnonzero(minor), np.flatnonzero(~minor)
        row = np.empty(len(ids), np.int64)
        row[left], row[right] = np.arange(len(left)), np.arange(len(right))
        order = np.argsort(element, kind="stable")
        doc, element = doc[order], element[order]
        shared = np.zeros((len(left), len(right)), np.float32)
        for first in range(0, int(element[-1]) + 1 if len(element) else 0, 8192):
            a, b = np.searchsorted(element, [first, first + 8192])
            d, e = doc[a:b], element[a:b] - first
            x, y = np.zeros((len(left), 8192), np.float32), np.zeros((len(right), 8192), np.float32)
            m = minor[d]
            x[row[d[m]], e[m]] = 1
            y[row[d[~m]], e[~m]] = 1
            shared += x @ y.T
        total = size[left][:, None] + size[right][None] - shared
        ok = (shared >= (similarity - 1e-12) * total) & (kinds[left][:, None] != kinds[right][None]) & (total > 0)
        i, j = np.nonzero(ok)
        # at most one edge per text keeps what they connect
        names, at = np.unique(np.r_[ids[left][i], ids[right][j]], return_inverse=True)
        low = lowest(at[:len(i)], at[len(i):], len(names))
        own = np.flatnonzero(low != np.arange(len(names)))
        return pa.table({"a": pa.array(names[low[own]], pa.int64()), "b": pa.array(names[own], pa.int64())})

    return met.groupBy("unit", "kind", "x", "y").applyInArrow(meet, "a long, b long").distinct()


def op2_bagminhash(spark, sf_dir):
    out = near_duplicates(table(spark, sf_dir, "documents"), "doc_id", "text")
    return out.withColumnRenamed("id", "doc_id")
