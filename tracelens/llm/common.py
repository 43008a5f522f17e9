"""Shared helpers: table access, vectorised word hashing, bucket exchange."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes that one bucket (one Arrow group in one Python worker) holds.
BUCKET_BYTES = 8 << 20
#: Text bytes that the vectorised functions work on at a time.
BLOCK_BYTES = 2 << 20

MASK = (1 << 64) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_crc(col: str) -> Column:
    """crc32 of an id as text (null for a null id)."""
    return F.crc32(F.col(col).cast("string").cast("binary"))


def held_out(col: str, mod: int, remainder: int) -> Column:
    """True for the rows kept out of training; a null id is never held out."""
    return F.coalesce(F.pmod(id_crc(col), F.lit(mod)) == remainder, F.lit(False))


# --- integer hashing ------------------------------------------------------

def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser on uint64 arrays."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def random_words(n: int, seed: int) -> np.ndarray:
    """n fixed pseudo-random odd uint64 numbers."""
    with np.errstate(over="ignore"):
        base = (np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                + np.uint64(seed * 0x632BE59BD9B4E019 & MASK))
        return mix(base) | np.uint64(1)


# --- texts as bytes -------------------------------------------------------

def utf8(array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column; a null is an empty text."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
        if isinstance(array, pa.ChunkedArray):
            array = pa.concat_arrays(array.chunks) if array.num_chunks else pa.array([], pa.string())
    array = array.cast(pa.large_string()).fill_null("")
    n = len(array)
    if not n:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = array.buffers()
    offsets = np.frombuffer(off, np.int64)[array.offset:array.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


#: White space that ends a word: space and \t \n \v \f \r.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[32, 9, 10, 11, 12, 13]] = False
_BYTE = random_words(256, 1)
_PLACE = random_words(1 << 12, 2)
#: Lower-cases A-Z only.
ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and the words before each document
    (one more entry at the end)."""
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = NOT_SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    begins[inner] |= inside[inner]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:]
    stops[inner - 1] |= inside[inner - 1]
    starts = np.flatnonzero(begins)
    ends = np.flatnonzero(stops) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 1) -> np.ndarray:
    """A 64-bit hash of each word's bytes (multilinear, then mixed); another
    ``seed`` gives independent weights."""
    if not len(starts):
        return np.empty(0, np.uint64)
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum()), dtype=np.int64) - np.repeat(first, lengths)
    chars = data[NOT_SPACE[data]]
    longest = int(lengths.max())
    byte = _BYTE if seed == 1 else random_words(256, seed)
    weights = _PLACE if seed == 1 and longest <= len(_PLACE) else random_words(longest, seed + 1)
    with np.errstate(over="ignore"):
        sums = np.add.reduceat(byte[chars] * weights[place], first)
        return mix(sums + lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def blocks(offsets: np.ndarray, size: int = BLOCK_BYTES):
    """(first, last+1) document ranges of about ``size`` bytes; a document is
    never cut."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + size, side="right")) - 1
        j = min(n, max(i + 1, j))
        yield i, j
        i = j


def hashed_words(array, lower: bool = False, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes, words before each document) of a text column."""
    data, offsets = utf8(array)
    hashes, counts = [], [np.zeros(1, np.int64)]
    done = 0
    for i, j in blocks(offsets):
        part = data[offsets[i]:offsets[j]]
        if lower:
            part = ASCII_LOWER[part]
        s, e, before = word_spans(part, offsets[i:j + 1] - offsets[i])
        hashes.append(word_hashes(part, s, e, seed))
        counts.append(before[1:] + done)
        done += len(s)
    return (np.concatenate(hashes) if hashes else np.empty(0, np.uint64), np.concatenate(counts))


def window_hashes(words: np.ndarray, size: int, seed: int) -> np.ndarray:
    """Hash of each run of ``size`` consecutive words (over the whole array;
    the caller drops the runs that cross documents)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    weights = random_words(size, seed)
    with np.errstate(over="ignore"):
        out = words[:n] * weights[0]
        for k in range(1, size):
            out += words[k:k + n] * weights[k]
    return mix(out)


def inside_document(before: np.ndarray, size: int) -> np.ndarray:
    """Mask over window starts: True if the window stays in its document."""
    total = int(before[-1])
    n = total - size + 1
    if n <= 0:
        return np.empty(0, bool)
    ok = np.ones(total, bool)
    for back in range(1, size):
        at = before[1:] - back
        ok[at[at >= before[:-1]]] = False
    return ok[:n]


# --- bytes of numbers -----------------------------------------------------

def pack(values: np.ndarray) -> bytes:
    """Little-endian byte planes: sorted or small numbers have planes that
    the shuffle's own compression removes."""
    values = np.ascontiguousarray(values)
    return values.view(np.uint8).reshape(-1, values.dtype.itemsize).T.tobytes()


def unpack(raw: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    planes = np.frombuffer(raw, np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).view(dtype).ravel()


def release() -> None:
    """Gives memory that Arrow and the C library hold for reuse back to the
    system; called between groups, as workers share it with the JVM."""
    import ctypes

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


# --- buckets --------------------------------------------------------------

def bucketed(df: DataFrame, id_col: str, text_col: str, bucket_bytes: int = BUCKET_BYTES,
             extra: list[str] | None = None) -> tuple[DataFrame, dict]:
    """(bucket, id, text) rows and the totals; buckets hold about
    ``bucket_bytes`` of text each.  Copies of one id spread by their text."""
    total = df.agg(F.count(F.lit(1)).alias("n"),
                   F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0)).alias("b")).first()
    # a document costs its arrays besides its text
    n = max(1, math.ceil((total["b"] + 64 * total["n"]) / bucket_bytes))
    out = df.select(F.pmod(F.xxhash64(F.col(id_col), F.col(text_col)), F.lit(n)).cast("int").alias("bucket"),
                    F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), *(extra or []))
    return out, {"rows": total["n"], "bytes": int(total["b"]), "buckets": n}


def by_limits(groups: np.ndarray):
    """(group, first, last+1) of the runs of a sorted array."""
    if not len(groups):
        return
    cut = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]])
    for a, b in zip(cut, np.r_[cut[1:], len(groups)]):
        yield groups[a], int(a), int(b)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the session's shared checkpoint folder."""
    from tracelens.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
