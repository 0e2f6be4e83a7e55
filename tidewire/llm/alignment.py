"""Alignment of two tokenizers' tokens over the same bytes.

Each tokenization of a text is a sparse incidence matrix of tokens by bytes in CSR form. Gustavson's row-wise product
A . B^T has an entry for each pair of tokens that overlap; its value is the number of shared bytes. Byte offsets at which
tokens of both end cut the text into groups; with the incidence of tokens and groups the same product gives the links,
all pairs of tokens that share a group.

How many documents hold a pair of ids linked is counted in blocks: a block of documents has its different pairs with
their document counts, shards add these up over all blocks and mark each first id's most frequent pairs, and answer
every block for its own pairs. All pairs of a first id meet in one shard, at most one row per block and pair.

The vocabulary files are parameters and must be readable on every executor under their paths. Null and empty texts, and
texts whose joined token bytes differ from the text with its space in front (a normalising tokenizer, unknown
characters), have no tokens: their counts are 0 and their hash is ''. Null ids and repeated rows are rows like others;
each row counts as one document. Texts are tokenized whole.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import byte_symbols
from .tallies import bucketed, dealt, gathered, pack, pack_sorted, shard_count, summed, unpack

BLOCK_PAIRS = 1 << 20
PRODUCT_TERMS = 1 << 21
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"  # fixed value: byte-level BPE's pieces


class Csr(NamedTuple):
    """A sparse matrix by rows: row i has the columns ``columns[starts[i]:starts[i + 1]]`` with these values."""

    starts: np.ndarray
    columns: np.ndarray
    values: np.ndarray
    width: int

    @property
    def rows(self) -> int:
        return len(self.starts) - 1


def spans_csr(ends: np.ndarray, width: int) -> Csr:
    """Incidence of consecutive spans, given where each ends: row i has a one for each place of span i."""
    return Csr(np.concatenate([[0], ends]), np.arange(width), np.ones(width, np.int64), width)


def labels_csr(labels: np.ndarray, width: int) -> Csr:
    """Incidence of rows that have one label each."""
    return Csr(np.arange(len(labels) + 1), labels, np.ones(len(labels), np.int64), width)


def transposed(m: Csr) -> Csr:
    """Counting sort by column: rows stay in order within a column."""
    order = np.argsort(m.columns, kind="stable")
    owner = np.repeat(np.arange(m.rows), np.diff(m.starts))
    starts = np.concatenate([[0], np.cumsum(np.bincount(m.columns, minlength=m.width))])
    return Csr(starts, owner[order], m.values[order], m.rows)


def product(a: Csr, b: Csr) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Entries (row, column, value) of ``a . b`` by Gustavson's rows, in row order.

    Each entry (i, k) of a scales row k of b; what falls on the same place of row i is added up. Rows are taken together
    as long as they have at most ``PRODUCT_TERMS`` terms; a row with more goes alone.
    """
    size = np.diff(b.starts)[a.columns]  # terms that each entry of a brings
    upto = np.concatenate([[0], np.cumsum(size)])[a.starts]
    first = 0
    while first < a.rows:
        last = max(first + 1, int(np.searchsorted(upto, upto[first] + PRODUCT_TERMS, "right")) - 1)
        lo, hi = a.starts[first], a.starts[last]
        n = size[lo:hi]
        total = int(upto[last] - upto[first])
        if total:
            row = np.repeat(np.repeat(np.arange(first, last), np.diff(a.starts[first : last + 1])), n)
            place = np.arange(total) - np.repeat(np.cumsum(n) - n, n) + np.repeat(b.starts[a.columns[lo:hi]], n)
            term = np.repeat(a.values[lo:hi], n) * b.values[place]
            at = row * b.width + b.columns[place]
            if not (at[1:] > at[:-1]).all():
                order = np.argsort(at, kind="stable")
                at, term = at[order], term[order]
                new = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
                at, term = at[new], np.add.reduceat(term, new)
            yield at // b.width, at % b.width, term
        first = last


class Tokens(NamedTuple):
    """Ids and, for each, the place after its last byte."""

    ids: np.ndarray
    ends: np.ndarray


class ByteLevel:
    """Byte-level BPE whose ids are its merge ranks; special tokens are plain text."""

    def __init__(self, file: str) -> None:
        with open(file, encoding="utf-8") as f:
            said = json.load(f)
        special = {x["content"] for x in said["added_tokens"]}
        byte = {s: b for b, s in enumerate(byte_symbols())}
        vocabulary, merges = said["model"]["vocab"], said["model"]["merges"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        if any(vocabulary[x + y] != 256 + rank for rank, (x, y) in enumerate(pairs)):
            raise ValueError(f"{file}: ids do not follow the order of merges")
        ranks = {bytes(byte[c] for c in s): i for s, i in vocabulary.items() if s not in special}
        self.encoding = tiktoken.Encoding("aligned", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in ranks.items():
            self.bytes[i] = token
        self.length = np.array([len(x) for x in self.bytes])

    def encode(self, text: str) -> Tokens:
        """The tokens of the text with a space in front."""
        ids = np.array(self.encoding.encode_ordinary(" " + text), np.int64)
        return Tokens(ids, np.cumsum(self.length[ids]))


class Pieces:
    """A piece model with byte fallback, which puts a space in front itself."""

    BYTE = re.compile(r"<0x([0-9A-Fa-f]{2})>")

    def __init__(self, file: str) -> None:
        self.model = sentencepiece.SentencePieceProcessor(model_file=file)
        self.bytes = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            byte = self.BYTE.fullmatch(piece)
            self.bytes.append(bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode())
        self.length = np.array([len(x) for x in self.bytes])

    def encode(self, text: str) -> Tokens:
        ids = np.array(self.model.encode(text, num_threads=1), np.int64)
        return Tokens(ids, np.cumsum(self.length[ids]))


@lru_cache(maxsize=2)
def byte_level(file: str) -> ByteLevel:
    return ByteLevel(file)


@lru_cache(maxsize=2)
def pieces(file: str) -> Pieces:
    return Pieces(file)


def group_ends(a: Tokens, b: Tokens) -> np.ndarray:
    """Places at which tokens of both end."""
    return np.intersect1d(a.ends, b.ends, assume_unique=True)


def overlaps(a: Tokens, b: Tokens) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(number of A token, number of B token, shared bytes) for each pair of tokens that share bytes."""
    width = int(a.ends[-1]) if len(a.ends) else 0
    return product(spans_csr(a.ends, width), transposed(spans_csr(b.ends, width)))


def links(a: Tokens, b: Tokens, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(number of A token, number of B token, 1) for each pair of tokens in the same group."""
    in_a, in_b = (labels_csr(np.searchsorted(ends, x.ends), len(ends)) for x in (a, b))
    return product(in_a, transposed(in_b))


def digit_table(n: int) -> np.ndarray:
    """Row i has the decimal digits of i after leading zero bytes, and a free byte at the end."""
    width = len(str(max(n - 1, 0)))
    rows = np.zeros((n, width + 1), np.uint8)
    rest = np.arange(n)
    for at in range(width - 1, -1, -1):
        rows[:, at] = np.where((rest > 0) | (at == width - 1), 48 + rest % 10, 0)
        rest = rest // 10
    return rows


DIGITS = lru_cache(maxsize=2)(digit_table)


def groups_text(a: Tokens, b: Tokens, ends: np.ndarray) -> bytes:
    """``a1,a2|b1;a3|b2,b3``: the ids of each group in order."""
    group = np.concatenate([np.searchsorted(ends, a.ends) * 2, np.searchsorted(ends, b.ends) * 2 + 1])
    order = np.argsort(group, kind="stable")
    group = group[order]
    ids = np.concatenate([a.ids, b.ids])[order]
    rows = DIGITS(1 << int(ids.max(initial=1)).bit_length())[ids]
    more = np.concatenate([group[1:] == group[:-1], [False]])
    rows[:, -1] = np.where(more, ord(","), np.where(group % 2 == 0, ord("|"), ord(";")))
    rows[-1, -1] = 0
    flat = rows.ravel()
    return flat[flat != 0].tobytes()


COUNTS = ("n_a", "n_b", "n_groups", "n_links", "n_overlaps")


def aligned(text: str | None, first: ByteLevel, second: Pieces) -> tuple[dict[str, int], str, np.ndarray, np.ndarray]:
    """A text's counts, the hash of its groups, its different linked id pairs (A id in the upper half) and how often
    each is linked."""
    if text:
        whole = b" " + text.encode()
        a, b = first.encode(text), second.encode(text)
        joined = all(b"".join([t.bytes[i] for i in x.ids.tolist()]) == whole for t, x in ((first, a), (second, b)))
    if not text or not joined:
        return dict.fromkeys(COUNTS, 0), "", np.empty(0, np.uint64), np.empty(0, np.int64)
    ends = group_ends(a, b)
    seen, often = [], []
    for i, j, n in links(a, b, ends):
        pair, times = np.unique(a.ids[i] << 32 | b.ids[j], return_counts=True)
        seen.append(pair)
        often.append(times)
    if len(seen) > 1:
        pair, place = np.unique(np.concatenate(seen), return_inverse=True)
        often = [np.bincount(place, np.concatenate(often)).astype(np.int64)]
    counts = {
        "n_a": len(a.ids), "n_b": len(b.ids), "n_groups": len(ends), "n_links": int(often[0].sum()),
        "n_overlaps": sum(len(i) for i, _, _ in overlaps(a, b)),
    }
    return counts, hashlib.sha256(groups_text(a, b, ends)).hexdigest(), pair.astype(np.uint64), often[0]


def spread(pairs: np.ndarray) -> np.ndarray:
    """Pairs as keys that shards can divide by ranges: the A id's bits are turned round and stand first, so that frequent
    ids lie apart and all pairs of an id together."""
    a, out = pairs >> np.uint64(32), np.zeros(len(pairs), np.uint64)
    for bit in range(32):
        out |= ((a >> np.uint64(bit)) & np.uint64(1)) << np.uint64(31 - bit)
    return out << np.uint64(32) | (pairs & np.uint64(0xFFFFFFFF))


BLOCK_SCHEMA = pa.schema(
    [("block", pa.int64()), ("ids", pa.binary()), ("figures", pa.binary()), ("hashes", pa.list_(pa.string()))]
    + [(c, pa.binary()) for c in ("keys", "counts", "sizes", "places", "often")]
)


def align(docs: DataFrame, first_file: str, second_file: str, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, n_overlaps, n_best, count_sum, groups_sha256) per row.

    A pair's count is the number of documents that hold it linked; n_best counts links whose pair has its A id's highest
    count, ties included, count_sum adds up the counts over all links.
    """
    spark = docs.sparkSession
    key_type = docs.schema[key].dataType.simpleString()
    arrow_ids = lambda column: column.cast(pa.string()).to_pylist()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = byte_level(first_file), pieces(second_file)
        made, held, size = 0, [], 0

        def done() -> pa.RecordBatch:
            pairs = [x[3] for x in held]
            keys, place, counts = np.unique(spread(np.concatenate(pairs)), return_inverse=True, return_counts=True)
            common = np.argsort(-counts, kind="stable")  # frequent pairs get small numbers, which pack better
            number = np.empty(len(keys), np.int32)
            number[common] = np.arange(len(keys), dtype=np.int32)
            row = {
                "block": (TaskContext.get().partitionId() << 32) + made,
                "ids": json.dumps([x[0] for x in held]).encode(),
                "figures": pack(np.array([[x[1][c] for c in COUNTS] for x in held], "<i8").ravel()),
                "hashes": [x[2] for x in held],
                "keys": pack_sorted(keys), "counts": pack(counts.astype("<i8")),
                "sizes": pack(np.array([len(p) for p in pairs], "<i4")),
                "places": pack(number[place].astype("<i4")),
                "often": pack(np.concatenate([x[4] for x in held]).astype("<i4")),
            }
            return pa.RecordBatch.from_pylist([row], BLOCK_SCHEMA)

        for batch in batches:
            for own, said in zip(arrow_ids(batch.column(0)), batch.column(1), strict=True):
                held.append((own, *aligned(said.as_py(), first, second)))
                size += len(held[-1][3]) + 1
                if size >= BLOCK_PAIRS:
                    yield done()
                    made, held, size = made + 1, [], 0
        if held:
            yield done()

    def best(group: pd.DataFrame) -> pd.DataFrame:
        """A shard's answers: each pair's count, doubled, and one more if its A id has no more frequent pair."""
        keys, totals, places = summed(group)
        start = np.flatnonzero(np.diff(keys >> np.uint64(32), prepend=np.uint64(1 << 40)))
        most = np.repeat(np.maximum.reduceat(totals, start), np.diff(start, append=len(keys)))
        told = totals * 2 + (totals == most)
        return pd.DataFrame({"block": group["block"], "shard": group["shard"], "told": [pack(told[p]) for p in places]})

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", *COUNTS, "n_best", "count_sum", "groups_sha256"]
        for batch in batches:
            for row in batch.to_pylist():
                told = [unpack(t, "<i8") for t in row["told"] or []]
                told = np.concatenate(told) if told else np.empty(0, np.int64)
                common = np.argsort(-unpack(row["counts"], "<i8"), kind="stable")
                own = told[common[unpack(row["places"], "<i4")]]
                often, sizes = unpack(row["often"], "<i4").astype(np.int64), unpack(row["sizes"], "<i4")
                upto = np.concatenate([[0], np.cumsum(sizes)])
                sums = [np.concatenate([[0], np.cumsum(x)])[upto] for x in (often * (own & 1), often * (own >> 1))]
                figures = unpack(row["figures"], "<i8").reshape(-1, len(COUNTS)).T
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(json.loads(row["ids"]), pa.string()), *[pa.array(np.ascontiguousarray(x)) for x in figures],
                        *[pa.array(np.diff(s)) for s in sums], pa.array(row["hashes"], pa.string()),
                    ],
                    names=names,
                )

    fields = "block long, ids binary, figures binary, hashes array<string>, " + ", ".join(
        f"{c} binary" for c in ("keys", "counts", "sizes", "places", "often")
    )
    blocks = bucketed(docs.select(F.col(key), F.col(text).alias("text")).mapInArrow(read, fields), "align_blocks", "block")
    pairs = blocks.agg(F.sum(F.octet_length("counts") + F.octet_length("keys"))).first()[0] or 0
    parts = dealt(blocks, shard_count(spark, pairs // 3))
    told = gathered(parts.groupBy("shard").applyInPandas(best, "block long, shard int, told binary"), "told")
    counted = blocks.drop("keys").join(told, "block", "left").mapInArrow(
        finish, "id string, " + ", ".join(f"{c} long" for c in (*COUNTS, "n_best", "count_sum")) + ", groups_sha256 string"
    )
    return counted.select(F.col("id").cast(key_type).alias(key), *counted.columns[1:])
