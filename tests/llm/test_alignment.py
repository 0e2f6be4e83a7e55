"""Token alignment against a brute force with the public tokenizers and sets of byte offsets."""

import hashlib
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from helpers import documents, vocabulary
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewire.llm import alignment
from tidewire.llm.queries import BYTE_LEVEL, PIECES

A_FILE, B_FILE = public_tokenizers.path(BYTE_LEVEL), public_tokenizers.path(PIECES)


@pytest.fixture(scope="module")
def libraries():
    first = Tokenizer.from_file(A_FILE)
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=B_FILE)


def unicode_bytes():
    """The byte that each character of byte-level BPE stands for."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


def spans(tokens):
    """(start, end) of each token."""
    out, at = [], 0
    for t in tokens:
        out.append((at, at + len(t)))
        at += len(t)
    return out


def brute(texts, libraries):
    first, second = libraries
    table = unicode_bytes()
    rows, held = [], []
    for text in texts:
        whole = (" " + (text or "")).encode()
        a = first.encode(" " + (text or ""), add_special_tokens=False).ids
        b = second.encode(text or "")
        a_bytes = [bytes(table[c] for c in first.id_to_token(i)) for i in a]
        b_bytes = []
        for i in b:
            piece = second.id_to_piece(i)
            byte = re.fullmatch("<0x(..)>", piece)
            b_bytes.append(bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode())
        if not text or b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            rows.append([0] * 5 + [""])
            held.append([])
            continue
        sa, sb = spans(a_bytes), spans(b_bytes)
        cuts = sorted({e for _, e in sa} & {e for _, e in sb})
        group = lambda end: sum(c < end for c in cuts)
        ga, gb = [group(e) for _, e in sa], [group(e) for _, e in sb]
        held.append([(x, y) for x, g in zip(a, ga) for y, h in zip(b, gb) if g == h])
        said = ";".join(
            ",".join(str(x) for x, g in zip(a, ga) if g == k) + "|" + ",".join(str(y) for y, g in zip(b, gb) if g == k)
            for k in range(len(cuts))
        )
        over = sum(max(p, r) < min(q, s) for p, q in sa for r, s in sb)
        rows.append([len(a), len(b), len(cuts), len(held[-1]), over, hashlib.sha256(said.encode()).hexdigest()])
    count = Counter(pair for pairs in held for pair in set(pairs))
    top = {}
    for (x, _), n in count.items():
        top[x] = max(top.get(x, 0), n)
    return [
        (*row[:5], sum(count[p] == top[p[0]] for p in pairs), sum(count[p] for p in pairs), row[5])
        for row, pairs in zip(rows, held, strict=True)
    ]


TEXTS = [
    None, "", " ", "a", "Unbelievably internationalization", "two  spaces", "tab\tand\nlines\r\n\n", "<|endoftext|> <s> </s> <unk>",
    "naïve façade ñandú größe", "日本語のテキスト 🎉👩‍👩‍👧 mixed", "▁ lower one", "<0x41> plain", "x" * 300, "\x00\x01", "é é", "ﬁne print ①",
    "same words same words", "same words same words",
]
NAMES = ("n_a", "n_b", "n_groups", "n_links", "n_overlaps", "n_best", "count_sum", "groups_sha256")


def found(docs):
    rows = alignment.align(docs, A_FILE, B_FILE).orderBy("doc_id").collect()
    return [tuple(r[c] for c in NAMES) for r in rows]


def test_against_brute_force(spark, libraries):
    vocab = vocabulary(5, 80)
    texts = TEXTS + [" ".join(vocab[(i * k) % 80] for k in range(1, 30)) for i in range(1, 25)]
    docs = documents(spark, texts, extra=("keys", "block", "told", "id"))
    assert found(docs.repartition(3)) == brute(texts, libraries)


def test_blocks_make_no_difference(spark, libraries, monkeypatch):
    texts = TEXTS * 2
    whole = found(documents(spark, texts).coalesce(1))
    one = alignment.aligned
    assert whole == brute(texts, libraries)
    monkeypatch.setattr(alignment, "PRODUCT_TERMS", 5)  # rows of the product one by one, in this process
    said = [one(t, alignment.byte_level(A_FILE), alignment.pieces(B_FILE)) for t in texts]
    assert [(s[0]["n_links"], s[0]["n_overlaps"], s[1]) for s in said] == [(w[3], w[4], w[7]) for w in whole]


def test_null_ids_repeated_rows_and_empty_table(spark, libraries):
    texts = ["one two three", "one two three", "one four", None]
    rows = alignment.align(documents(spark, texts, ids=[7, 7, None, None]), A_FILE, B_FILE).collect()
    said = sorted((str(r["doc_id"]), *(r[c] for c in NAMES)) for r in rows)
    ids = ["7", "7", "None", "None"]
    assert said == sorted((i, *b) for i, b in zip(ids, brute(texts, libraries), strict=True))
    none = alignment.align(documents(spark, texts).filter(F.lit(False)), A_FILE, B_FILE)
    assert none.count() == 0 and none.columns == ["doc_id", *NAMES]


@settings(deadline=None, max_examples=60)
@given(st.lists(st.lists(st.integers(0, 6), max_size=5), min_size=1, max_size=6), st.integers(1, 9))
def test_product(rows, terms):
    """Products of random matrices, whatever number of terms is taken at once."""
    a = np.array([[r.count(k) for k in range(7)] for r in rows])
    b = (a.T * 3 + 1) % 4

    def csr(m):
        return alignment.Csr(np.concatenate([[0], np.cumsum((m != 0).sum(axis=1))]), np.nonzero(m)[1], m[m != 0], m.shape[1])

    whole, alignment.PRODUCT_TERMS = alignment.PRODUCT_TERMS, terms
    try:
        out = np.zeros((len(rows), b.shape[1]), int)
        for i, j, v in alignment.product(csr(a), csr(b)):
            out[i, j] += v
    finally:
        alignment.PRODUCT_TERMS = whole
    assert (out == a @ b).all()
    back = alignment.transposed(csr(a))
    assert (np.diff(back.starts) == (a != 0).sum(axis=0)).all()
