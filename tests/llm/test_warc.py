import base64
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from tidewire.llm import warc
from tidewire.session import scratch_path

SCHEMA = "page_id long, url string, html string"


def pages(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumn("offset", F.lit("x")).withColumn("payload", F.lit(1))


def expected(rows, least=0):
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    out = []
    for i, _, h in rows:
        raw = (h or "").encode()
        refers = first.get(h or "") if len(raw) >= least else None
        refers = None if refers == i else refers
        sha1 = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        out.append((i, len(raw), sha1, "response" if refers is None else "revisit", refers))
    return sorted(out, key=repr)


@pytest.mark.parametrize("least", [0, 5])
def test_round_trip(spark, least):
    rows = [(i, f"http://h/{i}", f"<p>é {i % 7}</p>" * (i % 4)) for i in range(120)]
    rows += [(500, None, None), (501, "http://a\r\nInjected: x", ""), (None, "u", "only"), (None, "u", "<p>é 1</p>"), (7, "u", rows[7][2]),
             (600, "u", "WARC/1.1\r\n\r\n" * 3), (601, "u", "x" * 3_000_000)]
    back = warc.archive_round_trip(pages(spark, rows), payload=F.col("html"), least=least).collect()
    assert sorted(map(tuple, back), key=repr) == expected(rows, least)


def test_empty_table(spark):
    assert warc.archive_round_trip(pages(spark, []), payload=F.col("html")).collect() == []


def test_index_names_gzip_members(spark):
    folder = scratch_path(spark, "warc")
    index = warc.write_archives(pages(spark, [(i, f"u{i}", f"text {i}") for i in range(20)]), folder, payload=F.col("html"))
    filesystem, base = warc.open_folder(folder)
    for r in index.collect():
        with filesystem.open_input_file(f"{base}/{r['archive']}") as f:
            member = f.read_at(r["length"], r["offset"])
        said = gzip.decompress(member).decode()
        assert f"WARC-Target-URI: {r['url']}\r\n" in said and r["payload_digest"] in said
    some = warc.read_archives(index.filter("record_id IN (3, 4, 19)"), folder).collect()
    assert sorted(r["record_id"] for r in some) == [3, 4, 19]


def test_ranges_are_coalesced():
    rows = [("a", 0, 10), ("a", 10, 10), ("a", 25, 5), ("a", 100, 5), ("b", 105, 5)]
    assert [(a, s, e, len(p)) for a, s, e, p in warc.ranges(iter(rows), most=50, gap=8)] == [
        ("a", 0, 30, 3), ("a", 100, 105, 1), ("b", 105, 110, 1)
    ]
    assert len(list(warc.ranges(iter(rows), most=15, gap=8))) == 5


def test_damaged_record_is_noticed():
    member = warc.record_bytes(1, "u", b"abc", None, warc.digest(b"abc"))
    assert warc.parse_record(member)[1] == b"abc"
    with pytest.raises(ValueError):
        warc.parse_record(gzip.compress(b"HTTP/1.1 200\r\n\r\n"))
