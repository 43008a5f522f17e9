"""Token counts by the whole-token shortcut.

Which vocabulary strings the merges turn into one token is proven before any
text is read: every string's bytes are merged by rank, and those that end as
their own single token are kept.  A text is then split by the vocabulary's
pattern; a pre-token among the proven strings counts one, only the others
are merged, each distinct one once per worker.

The proof, the merges and the tokenizer file travel to the workers in one
broadcast, whose size the vocabulary bounds; executors need no copy of the file.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from itertools import filterfalse

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table
from .ss_packing import newer_letters, text_blocks
from .trie_bpe import SPLIT_PATTERN, byte_alphabet, byte_bpe_path

#: Pre-tokens outside the proven strings whose counts a worker keeps.
CACHE_WORDS = 500_000
#: Bytes up to which a pre-token is merged by scans.
SHORT_WORD = 24
NO_RANK = (1 << 60, 0)
#: Characters of a text that are split at a time.
PIECE_CHARS = 1 << 20
#: Tokens from which on a document is over the query's limit.
TOKEN_LIMIT = 512


class Merges:
    """The merge rules of a vocabulary file over byte strings."""

    def __init__(self, rank: dict[tuple[int, int], tuple[int, int]], byte_id: list[int]):
        self.rank, self.byte_id = rank, byte_id

    def tokens(self, word: bytes) -> list[int]:
        """Ids of one pre-token: the pair of lowest rank, the leftmost first,
        is merged until no pair has a rank."""
        ids = [self.byte_id[b] for b in word]
        n = len(ids)
        rank = self.rank
        if n <= SHORT_WORD:  # scans are cheaper than a heap
            get = rank.get
            ranks = [get(p, NO_RANK) for p in zip(ids, ids[1:])]
            while ranks:
                low = min(ranks)
                if low is NO_RANK:
                    break
                i = ranks.index(low)
                ids[i:i + 2] = (low[1],)
                del ranks[i]
                if i:
                    ranks[i - 1] = get((ids[i - 1], ids[i]), NO_RANK)
                if i < len(ranks):
                    ranks[i] = get((ids[i], ids[i + 1]), NO_RANK)
            return ids
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            r = rank.get((ids[i], ids[i + 1]))
            if r is not None:
                heap.append((r[0], i, r[1], ids[i], ids[i + 1]))
        heapq.heapify(heap)
        while heap:
            _, i, made, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue  # one of the two has been merged since
            ids[i], ids[j] = made, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                r = rank.get((made, ids[k]))
                if r is not None:
                    heapq.heappush(heap, (r[0], i, r[1], made, ids[k]))
            h = before[i]
            if h >= 0:
                r = rank.get((ids[h], made))
                if r is not None:
                    heapq.heappush(heap, (r[0], h, r[1], ids[h], made))
        return [t for t in ids if t >= 0]


def prove(spec: str) -> tuple[frozenset[str], dict, list[int], list[str]]:
    """(strings that encode alone as one token, rank and result of each
    merge, id of each byte, special tokens) of a byte-level vocabulary file's
    content."""
    data = json.loads(spec)
    vocab = data["model"]["vocab"]
    alphabet = byte_alphabet()
    byte_id = [-1] * 256
    for c, b in alphabet.items():
        byte_id[b] = vocab[c]
    rank: dict[tuple[int, int], tuple[int, int]] = {}
    for r, m in enumerate(data["model"]["merges"]):
        a, b = m if isinstance(m, list) else m.split(" ")
        rank.setdefault((vocab[a], vocab[b]), (r, vocab[a + b]))
    merges = Merges(rank, byte_id)
    special = [t["content"] for t in data["added_tokens"]]
    whole = set()
    for s, i in vocab.items():
        if s in special:
            continue
        word = bytes(alphabet[c] for c in s)
        if merges.tokens(word) == [i]:
            try:
                whole.add(word.decode())
            except UnicodeDecodeError:
                pass  # bytes that are no whole characters are no pre-token
    return frozenset(whole), rank, byte_id, special


class _Extra(dict):
    """Tokens beyond the first of pre-tokens that are not proven whole."""

    def __init__(self, merges: Merges):
        self.merges = merges

    def __missing__(self, word: str) -> int:
        if len(self) > CACHE_WORDS:
            self.clear()
        n = self[word] = len(self.merges.tokens(word.encode())) - 1
        return n


class TokenCounter:
    """Counts the tokens of texts under one vocabulary file's content."""

    def __init__(self, spec: str, proof=None):
        import regex

        self.spec = spec
        self.whole, rank, byte_id, self.special = proof or prove(spec)
        self.extra = _Extra(Merges(rank, byte_id))
        self.find = regex.compile(SPLIT_PATTERN).findall
        self.cut = regex.compile("|".join(map(regex.escape, self.special))).split
        self.newer = newer_letters()
        self.library = None

    def _by_library(self, text: str) -> int:
        # characters that Unicode versions class differently: only the
        # library itself says where its pattern splits them
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_str(self.spec)
        return len(self.library.encode(text, add_special_tokens=False).ids)

    def _ordinary(self, text: str) -> int:
        n, extra, outside = 0, self.extra, self.whole.__contains__
        for piece in pieces(text):
            words = self.find(piece)
            n += len(words)
            for w in filterfalse(outside, words):
                n += extra[w]
        return n

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if not text.isascii() and self.newer(text):
            return self._by_library(text)
        if any(s in text for s in self.special):
            parts = self.cut(text)
            return len(parts) - 1 + sum(map(self._ordinary, parts))
        return self._ordinary(text)


def pieces(text: str, chars: int = PIECE_CHARS) -> Iterator[str]:
    """The text in pieces that split like the whole: cut before a space that
    follows a character other than white space, where every pattern match
    ends.  A piece without such a place grows until one comes."""
    at = 0
    while len(text) - at > chars:
        end = text.find(" ", at + chars)
        while end > 0 and text[end - 1].isspace():
            end = text.find(" ", end + 1)
        if end < 0:
            break
        yield text[at:end]
        at = end
    yield text[at:] if at else text


def count_tokens(df: DataFrame, text_col: str, path: str, out_col: str = "n_tokens") -> DataFrame:
    """df with ``out_col``, the number of tokens that the tokenizers library
    gives each whole text under the byte-level vocabulary file ``path`` with
    add_special_tokens=False.

    A null or empty text has none.  Texts of any length are split in pieces;
    every row is counted on its own, equal rows alike; other columns pass
    unchanged (a column named ``out_col`` is replaced); an empty table stays
    empty.
    """
    with open(path, encoding="utf-8") as f:
        spec = f.read()
    sent = df.sparkSession.sparkContext.broadcast((spec, prove(spec)))

    @F.arrow_udf("long")
    def counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = TokenCounter(*sent.value)
        for texts in batches:
            yield pa.array([counter.count(t) for part in text_blocks(texts.to_pylist()) for t in part], pa.int64())

    return df.withColumn(out_col, counted(F.col(text_col)))


def op11_whole_token_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = count_tokens(docs, "text", byte_bpe_path(), "n_tokens")
    return out.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
                      "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))
