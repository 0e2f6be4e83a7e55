import hashlib
import random
from array import array

import public_tokenizers
import pytest
from helpers import documents
from tokenizers import Tokenizer

from tidewire.llm import bpe

FILE = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


def odd_texts():
    draw = random.Random(2)
    texts = [
        "", " ", "It's I'LL we'd'sample 'S", "ΣΑΣ ΟΔΟΣ İstanbul ß ẞ ŉ ﬁ e\u0301 A\u030A", "a\x1cb !\x1c! \x85\xa0\u2028x\u200by",
        "pre <|endoftext|>post<|startoftext|><|ENDOFTEXT|>", "<|endoftext|>", "1234 ½²٣ 漢字かな 😀👍🏽 \x00", "a" * 3000, "!?" * 2000,
    ]
    for _ in range(1500):
        texts.append("".join(chr(draw.choice([draw.randrange(9, 127), draw.randrange(0x3000), draw.randrange(0xD800), draw.randrange(0x10000, 0x1FFFF)])) for _ in range(draw.randint(1, 30))))
    return texts


def test_encoder_equals_library(library):
    own = bpe.load(FILE)
    for text in odd_texts():
        ids = library.encode(text, add_special_tokens=False).ids
        assert list(own.encode(text)) == ids, repr(text)
        assert own.decode(array("I", ids)) == library.decode(ids, skip_special_tokens=False)


def test_merges_follow_rank_then_position():
    own = bpe.load(FILE)
    for word in ("inininin", "aaaaaaa", "banana", "x"):
        symbols = [own.inner[b] for b in word.encode()]
        symbols[-1] = own.last[word.encode()[-1]]
        while True:
            ranked = [(own.merges[p], i) for i, p in enumerate(zip(symbols, symbols[1:], strict=False)) if p in own.merges]
            if not ranked:
                break
            (_, merged), i = min(ranked)
            symbols[i : i + 2] = [merged]
        assert own.merge(word) == symbols


def test_query_rows(spark, library):
    texts = [*odd_texts()[:300], None, "word " * 200_000]
    rows = bpe.token_digests(documents(spark, texts, extra=("n_tokens", "ids")), FILE).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (
            len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(text.encode()).hexdigest()
        )


def test_ids_column(spark, library):
    rows = bpe.encode_documents(documents(spark, ["Hello there", None, ""], ids=[1, 1, None]), FILE).collect()
    assert [r["token_ids"] for r in rows] == [library.encode("Hello there", add_special_tokens=False).ids, [], []]


def test_decoded_column(spark, library):
    ids = library.encode("Hello there", add_special_tokens=False).ids
    rows = bpe.decode_documents(spark.createDataFrame([(ids,), ([],), (None,)], "token_ids array<int>"), FILE).collect()
    assert [r["decoded"] for r in rows] == [library.decode(ids, skip_special_tokens=False), "", ""]


def test_empty_table(spark):
    assert bpe.token_digests(documents(spark, []), FILE).collect() == []


def test_table_of_words_seen_stays_bounded(monkeypatch):
    own = bpe.Bpe(FILE)
    monkeypatch.setattr(bpe, "CACHE_WORDS", 10)
    want = own.encode(" ".join(f"w{i}" for i in range(100)))
    assert len(own.recent) + len(own.older) <= 21
    assert own.encode(" ".join(f"w{i}" for i in range(100))) == want
