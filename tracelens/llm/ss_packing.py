"""Best-fit packing by the sum-of-squares rule.

Documents are tokenised, cut only when longer than a sequence, and packed in
groups of ``GROUP_PIECES`` pieces.  In a group, a piece goes to the open
sequence (or a new one) after which the sum over residual gaps of
(open sequences with that gap) squared is smallest.  Pieces come in a fixed random order, for which the rule
is made.
"""

from __future__ import annotations

import math
import unicodedata
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table

#: Pieces packed in one task.
GROUP_PIECES = 50_000
SEQUENCE = 4096
#: Distinct words, and pieces of several, whose ids a Python worker keeps.
CACHE_WORDS = 1_000_000

#: Fixed value of the vocabulary file: the pattern that splits a text.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Fixed value of the vocabulary file: the ending of a word's last token.
WORD_END = "</w>"
#: Characters that Python splits at and the library does not.
NOT_WHITE = "\x1c\x1d\x1e\x1f"


def newer_letters():
    """A test for characters that the regex module's Unicode tables call
    letters or numbers and Python's own, older ones leave unassigned; the
    tokenizers library may see them either way."""
    import sys

    import regex

    every = "".join(map(chr, (c for c in range(128, sys.maxunicode + 1) if not 0xD800 <= c < 0xE000)))
    new = {c for c in regex.findall(r"[\p{L}\p{N}]", every) if unicodedata.category(c) == "Cn"}
    return lambda text: not new.isdisjoint(text)


class WordTokens:
    """Ids of a text under a lower-casing word-level BPE file, piece by piece:
    no word of the file's pattern spans white space, so the ids of each distinct
    piece between white space are kept, and those of each distinct word, which
    the tokenizers library encodes once, many in a call.
    Rare texts, with special tokens or characters that Unicode versions class
    differently, are encoded whole by the library."""

    def __init__(self, path: str):
        import os

        import regex

        # Spark runs a worker per core; more threads would only add memory
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers

        self.tok = Tokenizer.from_file(path)
        self.normalizer, self.none = self.tok.normalizer, normalizers.Sequence([])
        self.tok.normalizer = self.none
        special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.special = regex.compile("|".join(map(regex.escape, special))).search if special else None
        self.find = regex.compile(WORD_PATTERN).findall
        vocab = self.tok.get_vocab()
        self.last = np.zeros(max(vocab.values()) + 1, bool)  # ids that end a word
        self.last[[i for t, i in vocab.items() if t.endswith(WORD_END)]] = True
        self.ids: dict[str, bytes] = {}  # of pieces and their words
        self.newer = newer_letters()

    def words(self, text: str) -> list[str]:
        if not text.isascii():
            if not unicodedata.is_normalized("NFC", text):
                text = unicodedata.normalize("NFC", text)
            text = text.replace("Σ", "σ")  # lower() has a final-sigma rule, the library has none
        return text.lower().split()

    def whole(self, text: str) -> bytes:
        self.tok.normalizer = self.normalizer
        ids = self.tok.encode(text, add_special_tokens=False).ids
        self.tok.normalizer = self.none
        return np.array(ids, "<u4").tobytes()

    def learn(self, pieces: set[str]) -> None:
        if len(self.ids) > CACHE_WORDS:
            self.ids.clear()
        pieces = pieces.difference(self.ids)
        # the pattern takes a run of letters whole
        split = {p: self.find(p) for p in pieces if not (p.isascii() and p.isalpha())}
        new = list(pieces.difference(split).union(set().union(*split.values()).difference(self.ids)))
        for i in range(0, len(new), 2000):
            self.learn_words(new[i:i + 2000])
        get = self.ids.__getitem__
        for p, words in split.items():
            if len(words) != 1:
                self.ids[p] = b"".join(map(get, words))

    def learn_words(self, words: list[str]) -> None:
        """Keeps the ids of each word: all are encoded as one text and cut
        after the ids that end a word."""
        ids = np.array(self.tok.encode(" ".join(words), add_special_tokens=False).ids, "<u4")
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(words):  # a word's ending is not in the vocabulary
            for w, e in zip(words, self.tok.encode_batch_fast(words, add_special_tokens=False)):
                self.ids[w] = array("I", e.ids).tobytes()
            return
        raw, at = ids.tobytes(), 0
        for w, end in zip(words, (4 * ends).tolist()):
            self.ids[w] = raw[at:end]
            at = end

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        rare = {i for i, t in enumerate(texts)
                if "<|" in t and self.special and self.special(t) or not t.isascii() and self.newer(t)
                or any(c in t for c in NOT_WHITE)}
        parts = [() if i in rare else self.words(t) for i, t in enumerate(texts)]
        self.learn(set().union(*parts))
        get = self.ids.__getitem__
        return [self.whole(t) if i in rare else b"".join(map(get, p)) for i, (t, p) in enumerate(zip(texts, parts))]


_LOADED: dict[str, WordTokens] = {}


def tokens_of(path: str) -> WordTokens:
    if path not in _LOADED:
        _LOADED[path] = WordTokens(path)
    return _LOADED[path]


def text_blocks(texts: list, chars: int = 1 << 20) -> Iterator[list[str]]:
    """Runs of texts of about ``chars`` characters (null: empty text)."""
    part, size = [], 0
    for t in texts:
        part.append(t or "")
        size += len(part[-1])
        if size >= chars:
            yield part
            part, size = [], 0
    if part:
        yield part


def pieces(df: DataFrame, id_col: str, text_col: str, path: str, end_id: int = 1, size: int = SEQUENCE) -> DataFrame:
    """(id, piece, start, length, ids_crc32): each document's ids and
    ``end_id``, cut every ``size`` ids."""

    def cut(batches):
        tok = tokens_of(path)
        tail = np.uint32(end_id).tobytes()
        for batch in batches:
            ids = batch.column(0).to_pylist()
            at = 0
            for texts in text_blocks(batch.column(1).to_pylist()):
                rows = []
                for doc, raw in zip(ids[at:at + len(texts)], tok.encode(texts)):
                    raw += tail
                    for p, a in enumerate(range(0, len(raw), 4 * size)):
                        part = raw[a:a + 4 * size]
                        rows.append((doc, p, a // 4, len(part) // 4, zlib.crc32(part)))
                at += len(texts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                    ["id", "piece", "start", "length", "ids_crc32"])

    return (df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(cut, "id long, piece int, start long, length long, ids_crc32 long"))


def sum_of_squares(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each piece, placed in the given order.

    With n[g] open sequences of gap g, putting a piece of length l into gap g
    changes the sum of squares by ``2 * (n[g-l] - n[g]) + 2`` (a new sequence:
    ``2 * n[size-l] + 1``; a filled one no longer counts: ``1 - 2 * n[l]``).
    Equal changes go to the smallest gap.
    """
    n = np.zeros(size + 1, np.int64)
    stacks: list[list[int]] = [[] for _ in range(size + 1)]
    used: list[int] = []
    seq = np.empty(len(lengths), np.int64)
    off = np.empty(len(lengths), np.int64)
    far = np.iinfo(np.int64).max
    for i, l in enumerate(lengths.tolist()):
        if l >= size:
            seq[i], off[i] = len(used), 0
            used.append(size)
            continue
        have = n[l:size]
        change = np.where(have > 0, 2 * (n[:size - l] - have) + 2, far)
        change[0] = 1 - 2 * have[0] if have[0] else far
        g = int(change.argmin())
        if change[g] > 2 * n[size - l] + 1:
            s = len(used)
            used.append(0)
            gap = size
        else:
            gap = g + l
            s = stacks[gap].pop()
            n[gap] -= 1
        seq[i], off[i] = s, used[s]
        used[s] += l
        if gap > l:
            stacks[gap - l].append(s)
            n[gap - l] += 1
    return seq, off


def pack_pieces(parts: DataFrame, size: int = SEQUENCE, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Adds (sequence_id, offset) to the rows of ``pieces``.

    Pieces are dealt to groups by a hash of all their columns and a row
    number, so copies spread.  In a group they are placed longest first.  Each
    group leaves a few sequences part full.
    """
    n = parts.count()
    groups = max(1, math.ceil(n / group_pieces))

    def place(key, t):
        t = t.sort_by([("_order", "ascending"), ("_at", "ascending")])
        seq, off = sum_of_squares(t["length"].to_numpy(), size)
        return pa.table({"id": t["id"], "piece": t["piece"], "start": t["start"], "length": t["length"],
                         "ids_crc32": t["ids_crc32"], "sequence_id": pa.array((key[0].as_py() << 32) + seq),
                         "offset": pa.array(off)})

    dealt = (parts.withColumn("_at", F.monotonically_increasing_id())
             .withColumn("_group", F.pmod(F.xxhash64("id", "piece", "_at"), F.lit(groups)).cast("long"))
             .withColumn("_order", F.xxhash64("ids_crc32", "id", "piece")))
    return dealt.groupBy("_group").applyInArrow(
        place, "id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def pack_documents(df: DataFrame, id_col: str, text_col: str, path: str, end_id: int = 1, size: int = SEQUENCE,
                   group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Packs each row of df into sequences of at most ``size`` ids.

    A null or empty text is the end id alone.  Rows with equal or null ids
    are packed each on their own.  Full pieces fill a sequence alone.  An
    empty table gives no rows.  Other columns of df are ignored.
    """
    from .common import checkpointed

    return pack_pieces(checkpointed(pieces(df, id_col, text_col, path, end_id, size)), size, group_pieces)


def word_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op8_sum_of_squares_packing(spark, sf_dir):
    out = pack_documents(table(spark, sf_dir, "documents"), "doc_id", "text", word_bpe_path())
    return out.withColumnRenamed("id", "doc_id")
