"""Byte-level BPE encoding and decoding by prefix-sharing trie traversal.

The last token of a word's encoding is decided by the word alone, and the
encoding of a word without its last token is that of the shorter word.  So a
trie over the distinct words holds one state per node, the last token of the
node's prefix, and a shared prefix is encoded once.  Words are visited in
sorted order, which is a depth-first walk of their trie: the states on the
path stay on a stack, and a word only computes the nodes below the point
where it leaves the word before.

The state of a node is the only vocabulary token t that ends its prefix and
that stays apart from the state before it: merging the two by rank must not
join bytes across the border before both tokens are complete.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table
from .ss_packing import newer_letters, text_blocks

#: Distinct words whose encodings a Python worker keeps.
CACHE_WORDS = 500_000

#: Fixed value of the vocabulary file: the pattern that splits a text.
SPLIT_PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


#: Characters past U+FFFF; ``re`` tests sets that hold none of them by table.
WIDE = re.compile("[\U00010000-\U0010ffff]").search


def narrow_pattern(top: int) -> str:
    """SPLIT_PATTERN for texts of characters up to ``top`` (U+FFFF at most), with its
    classes spelt out as ranges, so that ``re`` splits as ``regex`` does."""
    import regex

    chars = "".join(map(chr, range(top + 1)))

    def ranges(inside: str) -> str:
        return "".join(f"\\u{m.start():04x}-\\u{m.end() - 1:04x}" for m in regex.finditer(f"[{inside}]+", chars))

    letter, number, space = ranges(r"\p{L}"), ranges(r"\p{N}"), ranges(r"\s")
    return (f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+"
            f"|[{space}]+(?![^{space}])|[{space}]+")


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies: a
    printable Latin-1 character is itself, the others follow from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class TrieBpe:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        import json

        import regex
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()
        raw = lambda s: bytes(alphabet[c] for c in s)
        vocab = spec["model"]["vocab"]
        self.id_of = {raw(s): i for s, i in vocab.items()}
        self.bytes_of = {i: b for b, i in self.id_of.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for s, i in self.special.items():
            self.bytes_of[i] = s.encode()
        self.rank: dict[tuple[int, int], int] = {}
        self.made: dict[int, tuple[int, int, int]] = {}  # token: its merge's rank, left and right part
        for r, m in enumerate(spec["model"]["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            a, b, ab = vocab[a], vocab[b], vocab[a + b]
            self.rank.setdefault((a, b), r)
            self.made.setdefault(ab, (r, a, b))
        # last three bytes: lengths of the tokens that end in them, longest first
        lengths: dict[bytes, set[int]] = {}
        for b in self.id_of:
            if len(b) > 2:
                lengths.setdefault(b[-3:], {2, 1}).add(len(b))
        self.lengths = {b: tuple(sorted(n, reverse=True)) for b, n in lengths.items()}
        self.whole = Tokenizer.from_file(path)
        self.find_wide = regex.compile(SPLIT_PATTERN).findall
        self.find_ascii, self.find_narrow = (re.compile(narrow_pattern(t)).findall for t in (0x7F, 0xFFFF))
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.newer = newer_letters()
        self.apart: dict[tuple[int, int], bool] = {}
        self.sound: dict[int, bool] = {}
        self.words: dict[str, tuple[str, bytes]] = {}  # word: its ids joined by commas, and their bytes

    def stays_apart(self, left: int, right: int) -> bool:
        """Whether merging by rank leaves ``left`` and ``right`` as two tokens.

        Walks back in time: the border is flanked by the last part of left and
        the first part of right.  Of the two, the one made by the later merge
        is taken apart; the pair that then flanks the border must not have a
        merge that would have come earlier.
        """
        made, rank = self.made, self.rank
        a, b, before = left, right, 1 << 60
        while True:
            r = rank.get((a, b))
            if r is not None and r < before:
                return False
            ra = made[a][0] if a in made else -1
            rb = made[b][0] if b in made else -1
            if ra < 0 and rb < 0:
                return True
            # merges of one rank run from the left: one across the border is
            # too late for the left token and in time for the right one
            if ra > rb:
                before, a = ra, made[a][2]
            else:
                before, b = rb + 1, made[b][1]

    def is_sound(self, token: int) -> bool:
        """Whether the token's own bytes are encoded as that token."""
        if token not in self.sound:
            parts = [self.id_of[bytes((b,))] for b in self.bytes_of[token]]
            while len(parts) > 1:
                ranks = [self.rank.get(p, 1 << 60) for p in zip(parts, parts[1:])]
                low = min(ranks)
                if low == 1 << 60:
                    break
                a, b = next(p for p, r in zip(zip(parts, parts[1:]), ranks) if r == low)
                ab = self.id_of[self.bytes_of[a] + self.bytes_of[b]]
                out, i = [], 0
                while i < len(parts):
                    if i + 1 < len(parts) and parts[i] == a and parts[i + 1] == b:
                        out.append(ab)
                        i += 2
                    else:
                        out.append(parts[i])
                        i += 1
                parts = out
            self.sound[token] = parts == [token]
        return self.sound[token]

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        """Ids of distinct words given in sorted order."""
        id_of, apart, lengths = self.id_of, self.apart, self.lengths
        out = []
        last: list[int] = []  # the state of each node on the path
        size: list[int] = []  # its length
        before = b""
        for w in words:
            n, keep = len(w), 0
            most = min(n, len(before))
            if w[:most] == before[:most]:
                keep = most
            else:
                while w[keep] == before[keep]:
                    keep += 1
            del last[keep:], size[keep:]
            for end in range(keep + 1, n + 1):
                for k in lengths.get(w[end - 3:end], (2, 1)) if end > 2 else (2, 1):
                    if k > end:
                        continue
                    t = id_of.get(w[end - k:end])
                    if t is None:
                        continue
                    if end == k:
                        if self.is_sound(t):
                            break
                        continue
                    pair = (last[end - k - 1], t)
                    ok = apart.get(pair)
                    if ok is None:
                        ok = apart[pair] = self.is_sound(t) and self.stays_apart(*pair)
                    if ok:
                        break
                last.append(t)
                size.append(k)
            ids, end = [], n
            while end:
                ids.append(last[end - 1])
                end -= size[end - 1]
            ids.reverse()
            out.append(ids)
            before = w
        return out

    def decode(self, ids) -> bytes:
        """The bytes of ids, special tokens as their strings."""
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def learn(self, words: set[str]) -> None:
        if len(self.words) > CACHE_WORDS:
            self.words.clear()
        if len(self.apart) > 4 * CACHE_WORDS:
            self.apart.clear()
        new = sorted(map(str.encode, words.difference(self.words)))
        for w, ids in zip(new, self.encode_words(new)):
            self.words[w.decode()] = (",".join(map(str, ids)), self.decode(ids))

    def find(self, text: str) -> list[str]:
        """The words of a text without special tokens."""
        return (self.find_ascii if text.isascii() else self.find_wide if WIDE(text) else self.find_narrow)(text)

    def parts(self, text: str) -> list:
        """The words of a text; an int stands for a special token."""
        if self.cut is not None and "<|" in text and self.cut.search(text):
            return [w for i, p in enumerate(self.cut.split(text))
                    for w in ((self.special[p],) if i % 2 else self.find(p))]
        return self.find(text)

    def encode(self, text: str) -> list[int]:
        if not text.isascii() and self.newer(text):
            return self.whole.encode(text, add_special_tokens=False).ids
        parts = self.parts(text)
        self.learn({p for p in parts if isinstance(p, str)})
        return [int(i) for p in parts
                for i in ((p,) if isinstance(p, int) else self.words[p][0].split(","))]

    def digests(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """(ids, sha256 of the ids joined by commas, sha256 of the decoded
        text) of each text."""
        split = [None if not t.isascii() and self.newer(t) else self.parts(t) for t in texts]
        need = set().union(*filter(None, split))
        special = need.intersection(self.special.values())  # a word is a str, a special token an int
        self.learn(need - special)
        known = self.words
        if special:
            known = known | {i: (str(i), self.bytes_of[i]) for i in special}
        out = []
        for text, p in zip(texts, split):
            if p is None:
                ids = self.whole.encode(text, add_special_tokens=False).ids
                joined, raw = ",".join(map(str, ids)), self.decode(ids)
            else:
                got = list(map(known.__getitem__, p))
                joined, raw = ",".join([g[0] for g in got]), b"".join([g[1] for g in got])
            try:
                raw.decode()
            except UnicodeDecodeError:  # ids that are no whole characters
                raw = raw.decode(errors="replace").encode()
            out.append((joined.count(",") + 1 if joined else 0, hashlib.sha256(joined.encode()).hexdigest(),
                        hashlib.sha256(raw).hexdigest()))
        return out


_LOADED: dict[str, TrieBpe] = {}


def bpe_of(path: str) -> TrieBpe:
    if path not in _LOADED:
        _LOADED[path] = TrieBpe(path)
    return _LOADED[path]


def encode_documents(df: DataFrame, id_col: str, text_col: str, path: str) -> DataFrame:
    """(id, ids array<int>) of each row of df; null text: no ids."""

    def run(batches):
        bpe = bpe_of(path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([bpe.encode(t or "") for t in batch.column(1).to_pylist()],
                                           pa.list_(pa.int32()))], ["id", "ids"])

    return df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {df.schema[id_col].dataType.simpleString()}, ids array<int>")


def decode_documents(df: DataFrame, id_col: str, ids_col: str, path: str) -> DataFrame:
    """(id, text) of each row of df; null ids: empty text."""

    def run(batches):
        bpe = bpe_of(path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([bpe.decode(i or ()).decode(errors="replace")
                                            for i in batch.column(1).to_pylist()], pa.string())], ["id", "text"])

    return df.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids")).mapInArrow(
        run, f"id {df.schema[id_col].dataType.simpleString()}, text string")


def digest_documents(df: DataFrame, id_col: str, text_col: str, path: str) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of each row of df.

    A null or empty text has no ids (the digests of no bytes).  Equal rows
    and null ids each give their own row; an empty table gives none.
    """

    def run(batches):
        bpe = bpe_of(path)
        for batch in batches:
            ids, at = batch.column(0), 0
            for texts in text_blocks(batch.column(1).to_pylist()):
                n, a, b = zip(*bpe.digests(texts))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(at, len(texts)), pa.array(n, pa.int64()), pa.array(a, pa.string()),
                     pa.array(b, pa.string())], ["id", "n_tokens", "ids_sha256", "decoded_sha256"])
                at += len(texts)

    return df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {df.schema[id_col].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def byte_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op7_trie_bpe(spark, sf_dir):
    out = digest_documents(table(spark, sf_dir, "documents"), "doc_id", "text", byte_bpe_path())
    return out.withColumnRenamed("id", "doc_id")
