"""Vector codes by product quantisation in integers, pruned by LAESA pivots.

Vectors become integers and are cut into equal parts.  Each part position has
a codebook that starts from the parts of the smallest ids and is moved by
rounds of nearest-entry assignment (Lloyd's rounds), all in exact integers.

A few of the starting entries of a position are its pivots, chosen far from
each other.  Every part's distances to the pivots are computed once and stored
beside it.  In a round only the entries' distances to the pivots are new: the
largest difference of the two distances is a lower bound of the distance
between part and entry (triangle inequality).  Entries are tried in the
order of that bound, and those whose bound exceeds the best distance
so far are never evaluated; the others are compared by exact squared distances.

Rounds run over one table in the shared checkpoint folder.  Each task adds up
its parts by entry before the shuffle, so a round moves parts x entries rows
for a task, and parts x entries rows reach the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, table
from .vectors import usable_or_zero

PARTS, ENTRIES, ROUNDS, PIVOTS = 8, 16, 6, 4
SCALE = 4096
#: Sums of squares must stay below 2^63 and be exact in doubles' bounds.
LARGEST_COMPONENT = 1 << 26
#: Relative room for the rounding of square roots in a lower bound.
ROOT_ERROR = 1e-12
#: Labels up to which their error sums are broadcast; more are joined by salted shuffles.
BROADCAST_LABELS = 100_000
SALTS = 32


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of rows of ``x`` to ``y`` (a row, or a row each)."""
    d = x - y
    return np.einsum("ij,ij->i", d, d)


def choose_pivots(entries: np.ndarray, count: int) -> np.ndarray:
    """Up to ``count`` distinct entries: the first, then each time the one
    farthest from those chosen (ties: the first)."""
    chosen, near = [0], squared(entries, entries[0])
    while len(chosen) < count and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, squared(entries, entries[chosen[-1]]))
    return entries[chosen]


def pivot_distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """(rows, pivots) distances, the nearest doubles to the exact roots."""
    return np.sqrt(np.stack([squared(x, p) for p in pivots], axis=1).astype(np.float64))


def nearest(x: np.ndarray, to_pivots: np.ndarray, entries: np.ndarray,
            pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(index, squared distance) of each row's nearest entry, ties to the
    lower index, and the number of exact distances computed.

    ``to_pivots``: the rows' distances to ``pivots``."""
    n, k = len(x), len(entries)
    best = np.full(n, np.iinfo(np.int64).max)
    index = np.full(n, k, np.int64)
    if not n:
        return index, best, 0
    entry_to_pivots = pivot_distances(entries, pivots)
    bound = np.zeros((n, k))
    for p in range(len(pivots)):
        a, b = to_pivots[:, p, None], entry_to_pivots[None, :, p]
        np.maximum(bound, np.abs(a - b) - ROOT_ERROR * (a + b), out=bound)
    order = np.argsort(bound, axis=1, kind="stable")
    rows, evaluated = np.arange(n), 0
    for step in range(k):
        e = order[rows, step]
        low = bound[rows, e]
        open_ = low * low * (1 - ROOT_ERROR) <= best[rows]
        rows, e = rows[open_], e[open_]  # later entries have larger bounds
        if not len(rows):
            break
        d = squared(x[rows], entries[e])
        evaluated += len(rows)
        better = (d < best[rows]) | ((d == best[rows]) & (e < index[rows]))
        best[rows[better]], index[rows[better]] = d[better], e[better]
    return index, best, evaluated


class Codebooks:
    """Entries (parts, entries, length) and the fixed pivots of each part."""

    def __init__(self, entries: np.ndarray, pivots: list[np.ndarray]):
        self.entries, self.pivots = entries, pivots

    @classmethod
    def start(cls, vectors: np.ndarray, parts: int, pivots: int) -> "Codebooks":
        entries = vectors.reshape(len(vectors), parts, -1).transpose(1, 0, 2).copy()
        return cls(entries, [choose_pivots(e, pivots) for e in entries])

    def cut(self, x: np.ndarray) -> np.ndarray:
        return x.reshape(len(x), len(self.entries), -1)

    def distances(self, x: np.ndarray) -> np.ndarray:
        """Each part's distances to its position's pivots, side by side."""
        x = self.cut(x)
        return np.concatenate([pivot_distances(x[:, j], p) for j, p in enumerate(self.pivots)], axis=1)

    def assign(self, x: np.ndarray, far: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows, parts) entry indexes and squared distances."""
        x, at = self.cut(x), 0
        codes = np.empty(x.shape[:2], np.int64)
        error = np.empty(x.shape[:2], np.int64)
        for j, p in enumerate(self.pivots):
            codes[:, j], error[:, j], _ = nearest(x[:, j], far[:, at:at + len(p)], self.entries[j], p)
            at += len(p)
        return codes, error

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def _rows(column, dtype) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _entry_sums(base: DataFrame, books: Codebooks) -> np.ndarray:
    """(parts, entries, 1 + length): count and sums of the parts assigned to
    each entry."""
    sent = base.sparkSession.sparkContext.broadcast((books.entries, books.pivots))
    parts, entries, length = books.entries.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = Codebooks(*sent.value)
        total = np.zeros((parts * entries, 1 + length), np.int64)
        for batch in batches:
            x = _rows(batch.column(0), np.int64)
            if not len(x):
                continue
            codes, _ = b.assign(x, _rows(batch.column(1), np.float64))
            slot = codes + entries * np.arange(parts)
            order = np.argsort(slot.ravel(), kind="stable")
            ordered = slot.ravel()[order]
            first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
            rows = np.c_[np.ones(len(ordered), np.int64), b.cut(x).reshape(-1, length)[order]]
            total[ordered[first]] += np.add.reduceat(rows, first, axis=0)
        used = np.flatnonzero(total[:, 0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array(total[used].tolist(), pa.list_(pa.int64()))], ["slot", "sums"])

    partial = base.select("ints", "far").mapInArrow(add, "slot int, sums array<long>")
    got = partial.groupBy("slot").agg(*[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(1 + length)])
    out = np.zeros((parts * entries, 1 + length), np.int64)
    for r in got.collect():  # at most parts x entries rows
        out[r[0]] = r[1:]
    return out.reshape(parts, entries, 1 + length)


def compress_vectors(df: DataFrame, id_col: str, vector_col: str, parts: int = PARTS, entries: int = ENTRIES,
                     rounds: int = ROUNDS, pivots: int = PIVOTS, scale: int = SCALE,
                     carry: list[str] | None = None) -> tuple[DataFrame, Codebooks | None]:
    """(rows, codebooks): rows (id, row, codes array<int>, error long) of
    every usable vector of ``df``, ``row`` a struct of the ``carry`` columns
    (None: all).

    Rows whose vector is null, empty or holds null or non-finite components
    are left out.  A component x becomes floor(scale * x).  Codebooks start
    from the ``entries`` smallest ids (equal ids in the order of their vectors; null ids
    give no entry; fewer rows: fewer entries, and where no row has an id the codebooks are
    None and no row is returned); ``rounds`` rounds assign all parts
    and replace each entry by the floor of its parts' mean, unused entries
    stay.  Equal rows and null ids each give their own row.  Vectors must
    have one length, a multiple of ``parts``, and components below 2^26 after
    scaling: others fail the job.  Columns may have any name.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in (df.columns if carry is None else carry)])
    ints = F.transform(F.col(vector_col), lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long"))
    kept = df.where(usable_or_zero(vector_col)).select(
        F.col(id_col).alias("id"), whole.alias("row"), ints.alias("ints"))
    first = [r["ints"] for r in kept.where("id IS NOT NULL").orderBy("id", "ints").limit(entries)
             .select("ints").collect()]
    if not first:
        empty = kept.select("id", "row", F.array().cast("array<int>").alias("codes"),
                            F.lit(0).cast("long").alias("error"))
        return empty.where(F.lit(False)), None
    length = len(first[0])
    if length % parts:
        raise ValueError(f"vectors of {length} components do not fall into {parts} equal parts")
    sound = (F.size("ints") == length) & F.forall("ints", lambda x: F.abs(x) < LARGEST_COMPONENT)
    kept = kept.withColumn("ints", F.when(sound, F.col("ints")).otherwise(
        F.raise_error(F.lit(f"a vector is not of {length} components or one is too large")).cast("array<long>")))
    books = Codebooks.start(np.array(first, np.int64), parts, pivots)
    sent = df.sparkSession.sparkContext.broadcast((books.entries, books.pivots))

    @F.arrow_udf("array<double>")
    def to_pivots(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        b = Codebooks(*sent.value)
        for ints in batches:
            far = b.distances(_rows(ints, np.int64)) if len(ints) else np.empty((0, 1))
            yield pa.ListArray.from_arrays(np.arange(0, far.size + 1, far.shape[1], dtype=np.int32),
                                           pa.array(far.ravel(), pa.float64()))

    base = checkpointed(kept.withColumn("far", to_pivots("ints")))
    for _ in range(rounds):
        sums = _entry_sums(base, books)
        used = sums[:, :, :1] > 0
        moved = np.where(used, sums[:, :, 1:] // np.maximum(sums[:, :, :1], 1), books.entries)
        books = Codebooks(moved, books.pivots)
    last = df.sparkSession.sparkContext.broadcast((books.entries, books.pivots))

    @F.arrow_udf("struct<codes:array<int>,error:long>")
    def coded(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        b = Codebooks(*last.value)
        for ints, far in batches:
            x = _rows(ints, np.int64)
            if len(x):
                codes, error = b.assign(x, _rows(far, np.float64))
            else:
                codes, error = np.empty((0, parts), np.int64), np.empty((0, parts), np.int64)
            lists = pa.ListArray.from_arrays(np.arange(0, codes.size + 1, parts, dtype=np.int32),
                                             pa.array(codes.ravel(), pa.int32()))
            yield pa.StructArray.from_arrays([lists, pa.array(error.sum(axis=1), pa.int64())], ["codes", "error"])

    out = base.select("id", "row", coded("ints", "far").alias("c"))
    return out.select("id", "row", F.col("c.codes").alias("codes"), F.col("c.error").alias("error")), books


def add_group_sum(df: DataFrame, key: str, value: str, out: str, spread: str,
                  most: int = BROADCAST_LABELS) -> DataFrame:
    """df with ``out``, the sum of ``value`` over the rows of equal ``key``
    (nulls together).  The sums are broadcast if they are at most ``most``;
    else the rows of a key are spread over SALTS shuffle keys by the hash of
    ``spread``."""
    sums = checkpointed(df.groupBy(F.col(key).alias("_key")).agg(F.sum(value).alias(out)))
    if sums.limit(most + 1).count() <= most:
        return df.join(F.broadcast(sums), F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key")
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int"))
    each = sums.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(each, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_salt") == F.col("_s")),
                       "left").drop("_key", "_salt", "_s")


def op13_laesa_codes(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    rows, books = compress_vectors(vectors, "vec_id", "embedding", carry=["label"])
    hexes = F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    coded = checkpointed(rows.select(F.col("id").alias("vec_id"), F.col("row.label").alias("label"),
                                     hexes.alias("code"), "error"))
    out = add_group_sum(coded, "label", "error", "label_error", "vec_id")
    return out.select("vec_id", "code", "error", "label_error",
                      F.lit(books.sha256() if books else None).cast("string").alias("codebooks_sha256"))


def _round_sql(r: int) -> str:
    """CTEs near{r} (each part's nearest entry of books{r}) and books{r + 1}."""
    return f"""
near{r} AS MATERIALIZED (
  SELECT v.row_id, v.part, min({{'d': list_sum(list_transform(list_zip(v.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT,
                               'e': b.entry}}) AS best
  FROM pieces v JOIN books{r} b USING (part) GROUP BY v.row_id, v.part),
moved{r} AS MATERIALIZED (
  SELECT part, entry, place, sum(x)::BIGINT AS s, count(*) AS c
  FROM (SELECT p.part, n.best.e AS entry, unnest(p.x) AS x, unnest(range(len(p.x))) AS place
        FROM pieces p JOIN near{r} n USING (row_id, part)) GROUP BY ALL),
books{r + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(m.x, b.x) AS x FROM books{r} b LEFT JOIN (
    SELECT part, entry, list((s - ((s % c) + c) % c) // c ORDER BY place) AS x FROM moved{r} GROUP BY part, entry) m
  USING (part, entry)),"""


OP13_SQL = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS row_id, vec_id, label, embedding,
         list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pieces AS MATERIALIZED (
  SELECT row_id, part, v[1 + part * len(v) // {PARTS}:(part + 1) * len(v) // {PARTS}] AS x
  FROM kept, range({PARTS}) AS r(part)),
books0 AS MATERIALIZED (
  SELECT part, entry, x FROM pieces JOIN (
    SELECT row_id, row_number() OVER (ORDER BY vec_id, v) - 1 AS entry FROM kept WHERE vec_id IS NOT NULL
    QUALIFY entry < {ENTRIES}) USING (row_id)),
{"".join(_round_sql(r) for r in range(ROUNDS + 1))}
coded AS (
  SELECT row_id, string_agg(printf('%02x', best.e), '' ORDER BY part) AS code, sum(best.d)::BIGINT AS error
  FROM near{ROUNDS} GROUP BY row_id)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) FROM books{ROUNDS}) AS codebooks_sha256
FROM kept JOIN coded USING (row_id)
"""
