"""Byte-pair encoding and decoding with a public vocabulary file.

A word is a doubly linked list of symbols; a priority queue holds its adjacent pairs by merge rank and position. The
best pair is merged, its neighbours' new pairs are queued, and entries whose symbols have changed meanwhile are skipped
when they come up. Decoding joins the vocabulary strings of the ids.

The vocabulary file is a parameter and must be readable on every executor under that path. Words already seen by a
Python worker are kept in a table of at most ``2 * CACHE_WORDS`` words; it only saves time.

Null and empty texts have no ids and decode to the empty string. Texts are encoded whole, however long.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import sys
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tallies import KEPT

CACHE_WORDS = 150_000
SPACE = r" \t\n\v\f\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
FILE_SEPARATORS = "\x1c\x1d\x1e\x1f"  # white space to Python, not to the vocabulary's library


# Letters and digits that came after Unicode 16, as hexadecimal ranges; to the vocabulary's library they
# are neither. Some regex versions know them.
LATER = """
558 58b-58c 88f c5c cdc 208f 209d-209f a7cf a7dd a7e2 a7f1 ab6c-ab6d 107bb-107bf 10940-10959 10ec5-10ec7
10ed9-10eee 11b0a 11db0-11ddb 11de0-11de9 11df1 1246f 12475-1247f 12550-12686 16ebb-16ed3 16ff2-16ff6 187f8-187ff
18cd6-18cda 18d09-18d20 18d80-18df2 18e00-19191 191a0-191d2 1b123-1b128 1b168 1d6a6 1df1f-1df24 1df2b-1df81
1df90-1df96 1dfcd-1dfff 1e6c0-1e6de 1e6e0-1e6e2 1e6e4-1e6e5 1e6e7-1e6ed 1e6f0-1e6f4 1e6fe-1e6ff 2b73a-2b73f 2b81e
2cea2-2cead 323b0-33479 3d000-3fc3f
"""
# Capitals of Unicode 16 and 17 (first, last) and the distance to their small letters.
LATER_CAPITALS = (
    (0x1C89, 0x1C89, 1), (0xA7CB, 0xA7CB, 0x264 - 0xA7CB), (0xA7CC, 0xA7CC, 1), (0xA7CE, 0xA7CE, 1), (0xA7D2, 0xA7D2, 1),
    (0xA7D4, 0xA7D4, 1), (0xA7DA, 0xA7DA, 1), (0xA7DC, 0xA7DC, 0x19B - 0xA7DC), (0x10D50, 0x10D65, 32),
    (0x16EA0, 0x16EB8, 27),
)
SMALL = {c: c + step for first, last, step in LATER_CAPITALS for c in range(first, last + 1)} | {0x3A3: 0x3C3}


def piece_patterns(split: str) -> tuple[regex.Pattern, regex.Pattern, regex.Pattern]:
    """The file's pattern; the same without the letters of ``LATER``, much slower; a search for such letters."""
    later = "".join("-".join(f"\\U{int(x, 16):08x}" for x in span.split("-")) for span in LATER.split())
    letters, digits = rf"[\p{{L}}--[{later}]]", rf"[\p{{N}}--[{later}]]"
    exact = split
    for old, new in (
        (r"[^\s\p{L}\p{N}]", rf"[^{SPACE}{letters}{digits}]"), (r"[\p{L}]", letters), (r"[\p{N}]", digits)
    ):
        exact = exact.replace(old, new)
    return regex.compile(split.replace(r"\s", SPACE)), regex.compile(exact, regex.VERSION1), regex.compile(f"[{later}]")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself where printable, else the next one above 255."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {b: chr(b) for b in printable}
    for b in range(256):
        table.setdefault(b, chr(256 + len(table) - len(printable)))
    return [table[b] for b in range(256)]


class Bpe:
    """Encoder and decoder of one vocabulary file: byte-level BPE with a suffix on the last symbol of a word."""

    def __init__(self, file: str) -> None:
        with open(file, encoding="utf-8") as f:
            said = json.load(f)
        model = said["model"]
        vocabulary = model["vocab"]
        suffix = model["end_of_word_suffix"] or ""
        special = {x["content"]: x["id"] for x in said["added_tokens"]}
        self.strings = {i: s for s, i in vocabulary.items()} | {i: s for s, i in special.items()}
        self.merges = {
            (vocabulary[a], vocabulary[b]): (rank, vocabulary[a + b]) for rank, (a, b) in enumerate(model["merges"])
        }
        symbols = byte_symbols()
        self.inner = [vocabulary[s] for s in symbols]
        self.last = [vocabulary[s + suffix] for s in symbols]
        split = said["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.simple, self.exact, self.later = piece_patterns(split)
        self.special = special
        self.special_parts = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def merge(self, word: str) -> list[int]:
        """The ids of one word."""
        raw = word.encode()
        ids = [self.inner[b] for b in raw]
        ids[-1] = self.last[raw[-1]]
        n, merges = len(ids), self.merges
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = []
        for i in range(n - 1):
            if found := merges.get((ids[i], ids[i + 1])):
                queue.append((found[0], i, ids[i], ids[i + 1], found[1]))
        heapq.heapify(queue)
        while queue:
            _, i, left, right, merged = heapq.heappop(queue)
            j = after[i]
            if ids[i] != left or j >= n or ids[j] != right:
                continue  # stale: one of the two has been merged since
            ids[i], ids[j] = merged, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if found := merges.get((merged, ids[k])):
                    heapq.heappush(queue, (found[0], i, merged, ids[k], found[1]))
            if (h := before[i]) >= 0 and (found := merges.get((ids[h], merged))):
                heapq.heappush(queue, (found[0], h, ids[h], merged, found[1]))
        return [x for x in ids if x >= 0]

    def pieces(self, text: str) -> list[str]:
        if not text.isascii() and self.later.search(text):
            return self.exact.findall(text)
        return self.simple.findall(text)

    def packed(self, word: str) -> bytes:
        """The ids of one unspaced run of text, as little-endian 32-bit integers, from the runs seen if possible."""
        if (ids := self.older.get(word)) is None:
            ids = little_endian(array("I", [i for piece in self.pieces(word) for i in self.merge(piece)]))
        if len(self.recent) >= CACHE_WORDS:
            self.older, self.recent = self.recent, {}
        self.recent[word] = ids
        return ids

    def encode_plain(self, text: str) -> bytes:
        """Pieces never hold white space, so a text is cut there first and runs seen before are looked up."""
        text = unicodedata.normalize("NFC", text)
        if not text.isascii():
            text = text.translate(SMALL) if not SMALL.keys().isdisjoint(map(ord, set(text))) else text
        text = text.lower()
        if any(c in text for c in FILE_SEPARATORS):
            return b"".join([self.packed(piece) for piece in self.pieces(text)])
        seen = self.recent.get
        return b"".join([seen(word) or self.packed(word) for word in text.split()])

    def encode(self, text: str) -> array:
        """The ids of a whole text."""
        ids = array("I")
        if self.special_parts and any(s in text for s in self.special):
            for part in self.special_parts.split(text):
                if part in self.special:
                    ids.append(self.special[part])
                else:
                    ids.frombytes(native(self.encode_plain(part)))
        else:
            ids.frombytes(native(self.encode_plain(text)))
        return ids

    def decode(self, ids: array) -> str:
        """The vocabulary strings, joined as the file's decoder says: without one, by spaces."""
        return " ".join(map(self.strings.__getitem__, ids))


def little_endian(ids: array) -> bytes:
    if sys.byteorder == "big":
        ids = array("I", ids)
        ids.byteswap()
    return ids.tobytes()


def native(packed: bytes) -> bytes:
    if sys.byteorder == "little":
        return packed
    ids = array("I", packed)
    ids.byteswap()
    return ids.tobytes()


@lru_cache(maxsize=2)
def load(file: str) -> Bpe:
    """One encoder per Python worker and file, until another operator tidies up."""
    return Bpe(file)


KEPT.append(load)


def encode_documents(docs: DataFrame, file: str, *, text: str = "text", ids: str = "token_ids") -> DataFrame:
    """All columns and the ids of the text (array of int)."""

    @F.pandas_udf("array<int>")
    def encoded(texts):
        bpe = load(file)
        return texts.map(lambda t: np.frombuffer(bpe.encode(t or ""), np.int32))

    return docs.withColumn(ids, encoded(F.col(text)))


def decode_documents(docs: DataFrame, file: str, *, ids: str = "token_ids", text: str = "decoded") -> DataFrame:
    """All columns and the text that the ids stand for; null ids give the empty string."""

    @F.pandas_udf("string")
    def decoded(rows):
        bpe = load(file)
        return rows.map(lambda r: "" if r is None else bpe.decode(r.tolist()))

    return docs.withColumn(text, decoded(F.col(ids)))


def token_digests(docs: DataFrame, file: str, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256): each text encoded, its ids decoded again, both by their hash."""
    key_type = docs.schema[key].dataType.simpleString()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(file)
        for batch in batches:
            counts, ids_hash, decoded_hash = [], [], []
            for t in batch.column(1):
                ids = bpe.encode(t.as_py() or "")
                counts.append(len(ids))
                ids_hash.append(hashlib.sha256(little_endian(ids)).hexdigest())
                decoded_hash.append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(decoded_hash, pa.string())],
                names=[key, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select(key, F.col(text).alias("text")).mapInArrow(
        digest, f"{key} {key_type}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
