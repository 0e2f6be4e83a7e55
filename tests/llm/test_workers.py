import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F

from tidewire.llm import bpe, lines, setsketch, tallies


def rss() -> int:
    return int(next(x for x in open("/proc/self/status") if x.startswith("VmRSS")).split()[1])


def test_workers_give_back_what_earlier_stages_took(monkeypatch):
    """Encoders go, and memory that is free between live objects goes back to the system; once in a stage."""
    file = public_tokenizers.path("word_bpe_49k.json")
    monkeypatch.setattr(tallies, "LAST_TIDIED", [7])
    bpe.load(file)
    held = [bytearray(100_000) for _ in range(3000)]  # too small to be mapped one by one
    held = held[::50]
    before = rss()
    tallies.tidied()
    assert bpe.load.cache_info().currsize == 0 and len(held) == 60
    assert rss() < before - 200_000
    bpe.load(file)
    tallies.tidied()  # the same stage
    assert bpe.load.cache_info().currsize == 1


def test_large_steps_drop_the_encoder(spark):
    """The steps that read whole texts do not keep the tables of the encoding stage in their workers."""
    file = public_tokenizers.path("word_bpe_49k.json")
    docs = spark.createDataFrame([(i, f"one two three {i % 3}\nfour five {i}") for i in range(6)], "doc_id long, text string")

    def encoders(step):
        def count(batches):
            bpe.load(file)
            for _ in step(batches):
                yield pa.RecordBatch.from_pydict({"n": [bpe.load.cache_info().currsize]})

        return count

    seen = []
    kind = type(docs)
    plain = kind.mapInArrow
    try:
        kind.mapInArrow = lambda self, f, schema, *a: seen.append((self, f)) or plain(self, f, schema, *a)
        setsketch.sketch_table(docs, 2)
        lines.line_blocks(docs, "doc_id", "text")
    finally:
        kind.mapInArrow = plain
    assert [f.__name__ for _, f in seen] == ["sketch", "read"]
    for frame, step in seen:
        assert plain(frame, encoders(step), "n long").agg(F.min("n")).first()[0] == 0  # a worker's first task
