"""Repeated passages by prefix-partitioned suffix trees over words.

The suffixes of all documents are split by their first words into groups that
fit a worker's memory: the prefix is one word where few suffixes begin with
it, and grows to two, four, eight words or the whole depth of the tree only
in cells that are crowded.  The number of cells grows with the text, so that
the groups stay prefixes at any size.  A group holds the subtree of its
prefixes cut at ``depth`` words; a root-to-node path of that depth is kept as
a 40-bit fingerprint beside its group, not as ordered suffixes.

A path that two documents seem to share is then verified: each bucket that
sent it gives a second hash, of other weights from the letters on, with the
smallest and largest document that hold it.  Paths equal in both are a deep
internal node, a repeat of ``depth`` words; runs of such repeats that follow
each other in a document are its maximal repeats.

Documents travel once, in buckets of about 4 MB of text.  A bucket sends each
path once, however many of its documents hold it, so a passage that a third
of all documents share costs one entry per bucket.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import (bucketed, by_limits, hashed_words, inside_document, mix, pack, release, table,
                     unpack,
                     window_hashes)

DEPTH = 13
#: Text bytes of one bucket of documents.
BUCKET_BYTES = 4 << 20
#: Paths that one group (one task's memory) holds.
GROUP_PATHS = 1_000_000
#: Bytes of a path's fingerprint: it only has to tell the paths of one group
#: apart, as what it takes for equal is verified by another 8 bytes.
PATH_BYTES = 5
PATH_MASK = np.uint64((1 << 8 * PATH_BYTES) - 1)
#: Prefix lengths in words, before the whole depth.
PREFIXES = (1, 2, 4, 8)
#: Least cells that prefixes of one length are counted in, and cells to a
#: group of paths at least.
CELLS, GROUP_CELLS = 4096, 8
#: Bytes of text to a word, for the number of cells.
WORD_BYTES = 5
#: Weights of the second hash.
SECOND = 101
#: Stands for a null id: such a document comes after all others.
LAST = np.iinfo(np.int64).max


def path_hashes(array, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word hashes, words before each document, paths, document and start
    word of each path) of a text column."""
    words, before = hashed_words(array)
    paths = window_hashes(words, depth, 5)
    start = np.flatnonzero(inside_document(before, depth))
    doc = np.searchsorted(before, start, side="right") - 1
    return words, before, paths[start] & PATH_MASK, doc, start


def check_hashes(array, depth: int) -> np.ndarray:
    """A second hash of each run of ``depth`` words, independent of the paths."""
    return window_hashes(hashed_words(array, seed=SECOND)[0], depth, 11)


def cell_count(text_bytes: int, limit: int) -> int:
    """Cells of each prefix length: a power of two, several times the groups
    of ``limit`` paths that the text makes."""
    return max(CELLS, 1 << math.ceil(math.log2(max(1, GROUP_CELLS * text_bytes / WORD_BYTES / limit))))


def prefix_cells(words: np.ndarray, start: np.ndarray, depth: int, cells: int):
    """The cell of each path's prefix of each length below ``depth``."""
    for p in PREFIXES:
        if p < depth:
            x = mix(window_hashes(words, p, 7) + np.uint64(p))
            yield (x[start] & np.uint64(cells - 1)).astype(np.int64)


def count_prefixes(docs: DataFrame, depth: int, cells: int) -> np.ndarray:
    """(lengths, cells) paths of all documents by prefix cell."""

    def run(batches):
        n = np.zeros((len(PREFIXES), cells), np.int64)
        for batch in batches:
            words, _, _, _, start = path_hashes(batch.column(0), depth)
            for i, c in enumerate(prefix_cells(words, start, depth, cells)):
                n[i] += np.bincount(c, minlength=cells)
        i, c = np.nonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(c, pa.int32()), pa.array(n[i, c])],
                                         ["i", "cell", "n"])

    rows = (docs.select("text").mapInArrow(run, "i int, cell int, n long")
            .groupBy("i", "cell").agg(F.sum("n").alias("n")).toArrow())
    out = np.zeros((len(PREFIXES), cells), np.int64)
    out[rows["i"].to_numpy(), rows["cell"].to_numpy()] = rows["n"].to_numpy()
    return out


def assign_groups(counts: np.ndarray, limit: int) -> tuple[np.ndarray, int]:
    """(group of each prefix cell or -1, number of groups).  Cells of at most
    ``limit`` paths share groups, dealt forth and back from the largest; the
    other paths use a longer prefix, in the end the whole path over all groups."""
    groups = max(1, math.ceil(int(counts[0].sum()) / limit))
    out = np.full(counts.shape, -1, np.int32)
    for i in range(len(counts)):
        small = np.flatnonzero((counts[i] > 0) & (counts[i] <= limit))
        order = small[np.argsort(-counts[i][small], kind="stable")]
        lap, at = np.divmod(np.arange(len(order)), groups)
        out[i, order] = np.where(lap % 2, groups - 1 - at, at)
    return out, groups


def path_groups(words: np.ndarray, start: np.ndarray, depth: int, plan: np.ndarray, groups: int) -> np.ndarray:
    out = np.full(len(start), -1, np.int64)
    for group, c in zip(plan, prefix_cells(words, start, depth, plan.shape[1])):
        out = np.where(out < 0, group[c], out)
    rest = np.flatnonzero(out < 0)
    if len(rest):
        out[rest] = window_hashes(words, depth, 9)[start[rest]] % np.uint64(groups)
    return out


def pack_ids(ids: np.ndarray) -> bytes:
    """Ids in 4 bytes each where they fit."""
    return pack(ids.astype(np.uint32) if ids.min() >= 0 and ids.max() < 1 << 32 else ids)


def unpack_ids(raw, n: int) -> np.ndarray:
    return unpack(raw, np.uint32 if len(raw) == 4 * n else np.int64).astype(np.int64)


def unpack_paths(raw) -> np.ndarray:
    return unpack(bytes(raw) + bytes(len(raw) // PATH_BYTES * (8 - PATH_BYTES)), np.uint64)


def pack_spans(spans: np.ndarray) -> bytes:
    """Places and values of the numbers that are not zero, which are few."""
    at = np.flatnonzero(spans)
    return pack(np.r_[at, spans[at]])


def unpack_spans(raw) -> tuple[np.ndarray, np.ndarray]:
    both = unpack(raw, np.int64)
    return both[:len(both) // 2], both[len(both) // 2:]


def shared_paths(docs: DataFrame, depth: int, group_paths: int, text_bytes: int) -> tuple[DataFrame, int]:
    """((bucket, paths) rows: the paths of each bucket of ``docs`` (bucket,
    id, text) that another bucket or two documents of it hold too, as far as
    fingerprints tell; number of groups)."""
    plan, groups = assign_groups(count_prefixes(docs, depth, cell_count(text_bytes, group_paths)), group_paths)

    def send(key, t):
        release()
        ids = t["id"].fill_null(LAST).to_numpy()
        words, _, paths, doc, start = path_hashes(t["text"], depth)
        group = path_groups(words, start, depth, plan, groups)
        del words, start
        # by group and path, each path once; many: held by two documents
        order = np.lexsort((ids[doc], paths, group))
        group, paths, holder = group[order], paths[order], ids[doc][order]
        del order, doc
        first = np.flatnonzero(np.r_[True, (paths[1:] != paths[:-1]) | (group[1:] != group[:-1])][:len(paths)])
        last = np.r_[first[1:], len(paths)][:len(first)] - 1
        many = holder[first] != holder[last]
        group, paths = group[first], paths[first]
        rows = [(int(g), key[0].as_py(), pack(paths[a:b])[:PATH_BYTES * (b - a)], np.packbits(many[a:b]).tobytes())
                for g, a, b in by_limits(group)]
        g, k, p, m = zip(*rows) if rows else ((),) * 4
        return pa.table({"group": pa.array(g, pa.int64()), "bucket": pa.array(k, pa.int32()),
                         "paths": pa.array(p, pa.binary()), "many": pa.array(m, pa.binary())})

    def meet(key, t):
        release()
        names, raw = t["bucket"].to_numpy(), [x.as_buffer() for x in t["paths"]]
        sizes = np.array([len(x) // PATH_BYTES for x in raw])
        paths = np.concatenate([unpack_paths(x) for x in raw])
        many = np.concatenate([np.unpackbits(np.frombuffer(x.as_buffer(), np.uint8), count=n)
                               for x, n in zip(t["many"], sizes)]).astype(bool)
        # leaves in order: equal neighbours hang below one deep node
        order = np.argsort(paths, kind="stable")
        ranked = paths[order]
        first = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
        del ranked
        n = np.diff(np.r_[first, len(paths)])
        deep = np.empty(len(paths), bool)
        deep[order] = np.repeat((n > 1) | np.logical_or.reduceat(many[order], first), n)
        del order
        back = np.flatnonzero(deep)  # in order of sender and path
        paths = paths[back]
        sender = np.searchsorted(np.cumsum(sizes), back, side="right")
        rows = [(int(names[s]), pack(paths[a:b])[:PATH_BYTES * (b - a)]) for s, a, b in by_limits(sender)]
        k, p = zip(*rows) if rows else ((), ())
        return pa.table({"bucket": pa.array(k, pa.int32()), "paths": pa.array(p, pa.binary())})

    sent = docs.groupBy("bucket").applyInArrow(send, "group long, bucket int, paths binary, many binary")
    return sent.groupBy("group").applyInArrow(meet, "bucket int, paths binary"), groups


def repeats(docs: DataFrame, depth: int, group_paths: int, text_bytes: int) -> DataFrame:
    """(bucket, paths, checks, low) rows for ``docs`` (bucket, id, text): the
    paths of each bucket, verified by their second hash, that also start in a
    document with a smaller id than the largest one of the bucket that holds
    them, with that smallest id."""
    shared, groups = shared_paths(docs, depth, group_paths, text_bytes)

    def confirm(key, t, asked):
        release()
        empty = pa.table({"group": pa.array([], pa.int64()), "bucket": pa.array([], pa.int32()),
                          **{c: pa.array([], pa.binary()) for c in ("paths", "checks", "low", "span")}})
        if not asked.num_rows:
            return empty
        known = np.unique(np.concatenate([unpack_paths(x.as_buffer()) for x in asked["paths"]]))
        ids = t["id"].fill_null(LAST).to_numpy()
        _, _, paths, doc, start = path_hashes(t["text"], depth)
        held = np.flatnonzero(known[np.minimum(np.searchsorted(known, paths), len(known) - 1)] == paths)
        paths, holder, start = paths[held], ids[doc[held]], start[held]
        del doc, held
        checks = check_hashes(t["text"], depth)[start]
        group = (mix(paths) % np.uint64(groups)).astype(np.int64)
        # by group, path and check, each once with its smallest and largest document
        order = np.lexsort((holder, checks, paths, group))
        group, paths, checks, holder = group[order], paths[order], checks[order], holder[order]
        first = np.flatnonzero(np.r_[True, (paths[1:] != paths[:-1]) | (checks[1:] != checks[:-1])])
        last = np.r_[first[1:], len(paths)] - 1
        group, paths, checks, low, high = group[first], paths[first], checks[first], holder[first], holder[last]
        rows = [(int(g), key[0].as_py(), pack(paths[a:b])[:PATH_BYTES * (b - a)], pack(checks[a:b]),
                 pack_ids(low[a:b]), pack_spans(high[a:b] - low[a:b])) for g, a, b in by_limits(group)]
        g, k, p, c, lo, hi = zip(*rows)
        return pa.table({"group": pa.array(g, pa.int64()), "bucket": pa.array(k, pa.int32()),
                         "paths": pa.array(p, pa.binary()), "checks": pa.array(c, pa.binary()),
                         "low": pa.array(lo, pa.binary()), "span": pa.array(hi, pa.binary())})

    def least_of(key, t):
        release()
        names, raw = t["bucket"].to_numpy(), [x.as_buffer() for x in t["paths"]]
        sizes = np.array([len(x) // PATH_BYTES for x in raw])
        paths = np.concatenate([unpack_paths(x) for x in raw])
        checks = np.concatenate([unpack(x.as_buffer(), np.uint64) for x in t["checks"]])
        low = np.concatenate([unpack_ids(x.as_buffer(), n) for x, n in zip(t["low"], sizes)])
        order = np.lexsort((checks, paths))
        p, c = paths[order], checks[order]
        first = np.flatnonzero(np.r_[True, (p[1:] != p[:-1]) | (c[1:] != c[:-1])])
        del p, c
        least = np.empty(len(low), np.int64)
        least[order] = np.repeat(np.minimum.reduceat(low[order], first), np.diff(np.r_[first, len(low)]))
        del order, first
        for x, at in zip(t["span"], np.cumsum(sizes) - sizes):
            place, span = unpack_spans(x.as_buffer())
            low[at + place] += span
        back = np.flatnonzero(low > least)  # in order of sender and path
        del low
        paths, checks, least = paths[back], checks[back], least[back]
        sender = np.searchsorted(np.cumsum(sizes), back, side="right")
        rows = [(int(names[s]), pack(paths[a:b])[:PATH_BYTES * (b - a)], pack(checks[a:b]), pack_ids(least[a:b]))
                for s, a, b in by_limits(sender)]
        k, p, c, lo = zip(*rows) if rows else ((),) * 4
        return pa.table({"bucket": pa.array(k, pa.int32()), "paths": pa.array(p, pa.binary()),
                         "checks": pa.array(c, pa.binary()), "low": pa.array(lo, pa.binary())})

    held = docs.groupBy("bucket").cogroup(shared.groupBy("bucket")).applyInArrow(
        confirm, "group long, bucket int, paths binary, checks binary, low binary, span binary")
    return held.groupBy("group").applyInArrow(least_of, "bucket int, paths binary, checks binary, low binary")


def covered_words(texts, ids: np.ndarray, hits: pa.Table, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(mask of covered words, words before each document) of a bucket."""
    words, before, paths, doc, start = path_hashes(texts, depth)
    cover = np.zeros(len(words) + 1, np.int64)
    if hits.num_rows and len(paths):
        known = np.concatenate([unpack_paths(x.as_buffer()) for x in hits["paths"]])
        checks = np.concatenate([unpack(x.as_buffer(), np.uint64) for x in hits["checks"]])
        low = np.concatenate([unpack_ids(x.as_buffer(), len(n.as_buffer()) // 8) for x, n in zip(hits["low"], hits["checks"])])
        second = check_hashes(texts, depth)[start]
        order = np.lexsort((checks, known))
        known, checks, low = known[order], checks[order], low[order]
        # nearly always one check to a path; the others are looked at in turn
        at = np.searchsorted(known, paths)
        left = np.flatnonzero(at < len(known))
        while len(left := left[known[at[left]] == paths[left]]):
            hit = left[(checks[at[left]] == second[left]) & (ids[doc[left]] > low[at[left]])]
            np.add.at(cover, start[hit], 1)
            np.add.at(cover, start[hit] + depth, -1)
            at[left] += 1
            left = left[at[left] < len(known)]
    return np.cumsum(cover)[:-1] > 0, before


def remove_repeats(df: DataFrame, id_col: str, text_col: str, depth: int = DEPTH,
                   group_paths: int = GROUP_PATHS, carry: bool = False) -> DataFrame:
    """(id, text, n_words, n_removed, spans, kept_text) of each row of df.

    Words are runs of bytes other than space, \\t, \\n, \\v, \\f and \\r.  A
    word goes if a run of ``depth`` words of its document that covers it also
    starts in a document with a smaller id; runs are judged on the input.
    ``spans`` lists the removed maximal repeats as (first word, words).
    ``kept_text`` is the text itself if nothing goes, else the kept words
    joined by one space; null or empty texts have no words.  Rows with equal
    ids count as one document's; null ids come after all others and never
    take words from each other.  An empty table gives no rows.  With ``carry``
    a struct ``row`` holds the columns of df but the text, so that they need
    no second shuffle; without it other columns are ignored.
    """
    others = [c for c in df.columns if c != text_col]
    carried = [F.struct(*(F.col(f"`{c}`") for c in others)).alias("row")] if carry else []
    docs, size = bucketed(df, id_col, text_col, BUCKET_BYTES, carried)

    def finish(key, t, hits):
        release()
        ids = t["id"].fill_null(LAST).to_numpy()
        gone, before = covered_words(t["text"], ids, hits, depth)
        n, removed, spans, kept = [], [], [], []
        for d, text in enumerate(t["text"].to_pylist()):
            g = gone[before[d]:before[d + 1]]
            n.append(len(g))
            removed.append(int(g.sum()))
            if not removed[-1]:
                spans.append([])
                kept.append(text)
                continue
            edge = np.flatnonzero(np.diff(np.r_[False, g, False].astype(np.int8)))
            spans.append([{"start": int(a), "words": int(b - a)} for a, b in zip(edge[::2], edge[1::2])])
            words = text.encode().split()
            kept.append(b" ".join([words[i] for i in np.flatnonzero(~g)]).decode())
        out = pa.table({"id": t["id"], "text": t["text"], "n_words": pa.array(n, pa.int64()),
                        "n_removed": pa.array(removed, pa.int64()),
                        "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("words", pa.int64())]))),
                        "kept_text": pa.array(kept, pa.string())})
        return out.append_column("row", t["row"]) if carry else out

    schema = StructType.fromDDL("id long, text string, n_words long, n_removed long, "
                                "spans array<struct<start:long,words:long>>, kept_text string")
    if carry:
        schema = schema.add(docs.schema["row"])
    return docs.groupBy("bucket").cogroup(
        repeats(docs, depth, group_paths, size["bytes"]).groupBy("bucket")).applyInArrow(
        finish, schema)


def kept_digest(df: DataFrame) -> DataFrame:
    """(id, n_words, n_removed, kept_sha256) of ``remove_repeats`` rows."""

    def run(batches):
        for b in batches:
            texts = b.column("kept_text").to_pylist()
            d = [hashlib.sha256(b" ".join((t or "").encode().split())).hexdigest() for t in texts]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("n_words"), b.column("n_removed"), pa.array(d, pa.string())],
                                             ["id", "n_words", "n_removed", "kept_sha256"])

    return df.select("id", "n_words", "n_removed", "kept_text").mapInArrow(
        run, "id long, n_words long, n_removed long, kept_sha256 string")


def op3_suffix_repeats(spark, sf_dir):
    out = kept_digest(remove_repeats(table(spark, sf_dir, "documents"), "doc_id", "text"))
    return out.withColumnRenamed("id", "doc_id")
