"""Periodic runs of words by a suffix automaton with link-cut access.

The suffix links of a word sequence's automaton form a tree.  Words are taken
one by one; the path from the root to the state of the prefix that ends at
word i holds all suffixes of that prefix.  The nodes of a path that were last
reached by the same prefix are kept as one splay tree (a preferred path of a
link-cut tree), so ``access`` walks over whole segments: a segment last
reached at word j, whose deepest node has length L, says that the last L words
before i and before j are equal.  If their distance i - j is at most L, the
words before i are a square of that period.  Every square of a primitive
period shows up like this, and in all there are O(n log n) segments.  A square
is extended to both sides while its period lasts; the stretches found
are the runs.

A run of at least LEAST_WORDS words and three periods repeats each of its
8-word sequences inside itself (two starts one period apart both fit into it),
so only stretches of 17 or more successive 8-word sequences that occur
twice in the text are put into automata; the rest of a text holds no run.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_crc, table
from .ss_packing import text_blocks

#: A run has at least so many words and at least so many periods.
LEAST_WORDS, LEAST_PERIODS = 24, 3
#: Words of the sequences that must occur twice.  Two starts one period q
#: apart fit into a run if q + SEQUENCE <= its length - q: for q below
#: SEQUENCE because 2 * 8 + 8 <= 24, else because SEQUENCE <= q.
SEQUENCE = 8


def automaton(words: list[int]) -> tuple[list[int], list[int], list[int]]:
    """(parent, length, states): the suffix-link tree of the words'
    automaton over nodes numbered from 1 (the root; its parent is 0), the
    longest length of each node, and the node of each prefix."""
    step: list[dict] = [{}, {}]
    parent, length = [0, 0], [0, 0]
    states, last = [], 1
    for n, c in enumerate(words, 1):
        new = len(length)
        length.append(n)
        parent.append(1)
        step.append({})
        p = last
        while p and c not in step[p]:
            step[p][c] = new
            p = parent[p]
        if p:
            q = step[p][c]
            if length[q] == length[p] + 1:
                parent[new] = q
            else:
                split = len(length)
                length.append(length[p] + 1)
                parent.append(parent[q])
                step.append(step[q].copy())
                while p and step[p].get(c) == q:
                    step[p][c] = split
                    p = parent[p]
                parent[q] = parent[new] = split
        states.append(new)
        last = new
    return parent, length, states


class LastReached:
    """A rooted tree whose root-to-node paths are recoloured one after
    another; nodes of one colour on a path share a splay tree by depth."""

    def __init__(self, parent: list[int]):
        self.up = parent[:]  # splay parent; at a splay root: the path's parent
        self.low = [0] * len(parent)  # shallower child
        self.high = [0] * len(parent)  # deeper child
        self.colour = [0] * len(parent)  # of a splay root: its whole tree

    def _splay(self, x: int) -> None:
        up, low, high = self.up, self.low, self.high
        while True:
            p = up[x]
            if not p or (low[p] != x and high[p] != x):
                return
            g = up[p]
            inner = g and (low[g] == p or high[g] == p)
            if inner:
                self._rotate(p if (low[p] == x) == (low[g] == p) else x)
            self._rotate(x)

    def _rotate(self, x: int) -> None:
        up, low, high, colour = self.up, self.low, self.high, self.colour
        p = up[x]
        g = up[p]
        if low[p] == x:
            b = low[p] = high[x]
            high[x] = p
        else:
            b = high[p] = low[x]
            low[x] = p
        if b:
            up[b] = p
        up[x], up[p] = g, x
        if g and low[g] == p:
            low[g] = x
        elif g and high[g] == p:
            high[g] = x
        else:
            colour[x] = colour[p]

    def access(self, x: int, colour: int) -> Iterator[tuple[int, int]]:
        """(deepest node, old colour) of each segment of the path from the
        root to ``x``, which then has ``colour`` throughout."""
        up, high, colours = self.up, self.high, self.colour
        below, top = 0, x
        while x:
            self._splay(x)
            h = high[x]
            if h:
                colours[h] = colours[x]
            high[x] = below
            yield x, colours[x]
            below = top = x
            x = up[x]
        colours[top] = colour


def _ahead(w: np.ndarray, at: int, period: int) -> int:
    """First place from ``at`` on whose word differs from that a period before."""
    n, size = len(w), 64
    while at < n:
        end = min(n, at + size)
        wrong = np.flatnonzero(w[at:end] != w[at - period:end - period])
        if len(wrong):
            return at + int(wrong[0])
        at, size = end, size * 2
    return n


def _back(w: np.ndarray, at: int, period: int) -> int:
    """Smallest start s with equal words a period apart from s up to ``at``."""
    size = 64
    while at > 0:
        begin = max(0, at - size)
        wrong = np.flatnonzero(w[begin:at] != w[begin + period:at + period])
        if len(wrong):
            return begin + int(wrong[-1]) + 1
        at, size = begin, size * 2
    return 0


def runs_of_stretch(w: np.ndarray, least_words: int = LEAST_WORDS,
                    least_periods: int = LEAST_PERIODS) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of a sequence of word numbers."""
    parent, length, states = automaton(w.tolist())
    tree = LastReached(parent)
    reach: dict[int, int] = {}  # period: end of the latest stretch with it
    found: dict[tuple[int, int], int] = {}
    for i, state in enumerate(states, 1):
        for node, j in tree.access(state, i):
            d = i - j
            if j and d <= length[node] and reach.get(d, 0) < i:
                end = _ahead(w, i, d)
                start = _back(w, i - 2 * d, d)
                reach[d] = end
                if end - start >= max(least_words, least_periods * d):
                    # the same stretch with a larger period is no other run
                    old = found.get((start, end))
                    if old is None or d < old:
                        found[start, end] = d
    return sorted((s, e - s, d) for (s, e), d in found.items())


def stretches(w: np.ndarray, size: int = SEQUENCE, least: int = LEAST_WORDS) -> Iterator[tuple[int, int]]:
    """(first, last + 1) words of the stretches that can hold a run."""
    n = len(w) - size + 1
    if len(w) < least:
        return
    if w.max() < 1 << 16:
        key = w.astype(np.uint64)
        key = key[:-1] << np.uint64(16) | key[1:]
        key = key[:-2] << np.uint64(32) | key[2:]  # four words: exact
        with np.errstate(over="ignore"):
            key = key[:-4] * np.uint64(0x9E3779B97F4A7C15) + key[4:]
    else:
        key = np.zeros(n, np.uint64)
        with np.errstate(over="ignore"):
            for k in range(size):
                key = key * np.uint64(0x9E3779B97F4A7C15) + w[k:k + n].astype(np.uint64)
    # equal keys of different sequences only make a stretch longer
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.diff(np.r_[False, twice, False].astype(np.int8))
    for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()):
        if b - a > least - size:
            yield a, b + size - 1


def periodic_runs(words: list) -> list[tuple[int, int, int]]:
    """(start, length, period), in order of start and period, of all runs of
    a text's words: stretches of at least LEAST_WORDS words and
    LEAST_PERIODS times their smallest period, not extendable."""
    if len(words) < LEAST_WORDS:
        return []
    number: dict = {}
    w = np.fromiter((number.setdefault(x, len(number)) for x in words), np.int64, len(words))
    return sorted((a + s, n, p) for a, b in stretches(w) for s, n, p in runs_of_stretch(w[a:b]))


def kept_words(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words without those that lie in a run after its first period."""
    if not runs:
        return words
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period:start + length] = False
    return [words[i] for i in np.flatnonzero(keep)]


RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def collapse_runs(df: DataFrame, id_col: str, text_col: str,
                  rewrite: Callable[[list[bytes], int], list[bytes]] | None = None,
                  seed=None) -> DataFrame:
    """(id, n_words, runs array<struct<start, length, period>>, collapsed) of
    each row of df: the runs of the whole text in order of start and period,
    and its kept words joined by one space.

    ``rewrite`` changes a text's words before that, given the value of the
    column ``seed`` (not called where that is null).  A null or empty text or one of
    white space has no words, no runs and an empty ``collapsed``.  Nested and
    overlapping runs all count; equal rows and null ids each give their
    own row; other columns do not take part, whatever their names; an empty
    table gives none.  A text is worked on whole, its memory grows with its
    longest stretch of repeated words.
    """

    def run(batches):
        for batch in batches:
            ids, at = batch.column(0), 0
            texts, seeds = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for part in text_blocks(texts):
                n_words, runs, collapsed = [], [], []
                for text, h in zip(part, seeds[at:at + len(part)]):
                    words = text.encode().split()
                    if rewrite is not None and h is not None:
                        words = rewrite(words, h)
                    found = periodic_runs(words)
                    n_words.append(len(words))
                    runs.append([dict(zip(("start", "length", "period"), r)) for r in found])
                    collapsed.append(b" ".join(kept_words(words, found)).decode())
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(at, len(part)), pa.array(n_words, pa.int64()), pa.array(runs, RUNS),
                     pa.array(collapsed, pa.string())], ["id", "n_words", "runs", "collapsed"])
                at += len(part)

    seed = F.lit(None).cast("long") if seed is None else seed.cast("long")
    id_type = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), seed.alias("seed")).mapInArrow(
        run, f"id {id_type}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def repeated_tail(words: list, h: int) -> list:
    """The query's rewriting by h = crc32(doc_id): if h is divisible by ten, a
    tail of the text repeats its own first words."""
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a:a + p]
    times = -(-(n - a) // p)
    return words[:a] + (unit * times)[:n - a]


def op12_periodic_runs(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    out = collapse_runs(docs, "doc_id", "text", repeated_tail, id_crc("doc_id"))
    # length / period is compared exactly, by products
    none = F.lit(None).cast("struct<start:long,length:long,period:long>")
    best = F.aggregate("runs", none, lambda b, r: F.when(
        b.isNull() | (r["length"] * b["period"] > b["length"] * r["period"]), r).otherwise(b))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.array_join(F.transform(lines, lambda s: F.concat(s, F.lit("\n"))), "")
    out = out.withColumn("best", best)
    return out.select(
        F.col("id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
