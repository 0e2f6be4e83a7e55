"""WARC archives: written with an index, read back by coalesced byte ranges.

Writing: each task appends gzip members, one per record, to archives of its own below a shared folder and returns one
index row per record (archive, offset, length, URL, digest). The index is written as a table; only archives that it
names count, so a task that is run again leaves an unused file and nothing else. Reading: index rows are ranged over
tasks by (archive, offset) and sorted there; neighbouring ranges are fetched by one read.

Equal payloads are stored once: the record with the smallest id is the response, the others revisit it. Repeated rows
with that smallest id are all responses. Records with a null id refer to the smallest id that is not null. Null
payloads count as empty ones; null URLs are written as the record's own id; line breaks in URLs are percent-encoded.
Archives go through ``pyarrow.fs``, which opens ``file:``, ``hdfs:`` and object store paths.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialized, scratch_path
from .words import bounded

RESPONSE, REVISIT = "response", "revisit"
DATE = "2024-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ARCHIVE_BYTES = 64 << 20
READ_BYTES, READ_GAP = 8 << 20, 64 << 10
INDEX_SCHEMA = (
    "record_id long, archive string, offset long, length long, url string, payload_digest string, record_type string"
)
RECORD_SCHEMA = "record_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def open_folder(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(record_id: int | None, url: str | None, payload: bytes, refers_to: int | None, sha1: str) -> bytes:
    """One record as a gzip member of its own."""
    name = f"urn:page:{'null' if record_id is None else record_id}"
    uri = name if url is None else url.replace("\r", "%0D").replace("\n", "%0A")
    kind, body = (RESPONSE, payload) if refers_to is None else (REVISIT, b"")
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{name}>", f"WARC-Date: {DATE}", f"WARC-Target-URI: {uri}",
        f"WARC-Payload-Digest: sha1:{sha1}", "Content-Type: text/html", f"Content-Length: {len(body)}",
    ]
    if refers_to is not None:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n") + packer.flush()


def parse_record(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers by lower-case name, and the body."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if version != "WARC/1.1":
        raise ValueError(f"not a WARC record: {version[:40]!r}")
    headers = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}
    size = int(headers["content-length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError(f"record {headers['warc-record-id']} has another length than it says")
    return headers, rest[:size]


def page_number(urn: str) -> int | None:
    number = urn.removeprefix("<urn:page:").removesuffix(">")
    return None if number == "null" else int(number)


def writer(folder: str, archive_bytes: int = ARCHIVE_BYTES):
    """A function for mapInPandas: writes rows (record_id, url, payload, refers_to) and yields their index."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        filesystem, base = open_folder(folder)
        out, archive, offset = None, "", 0
        for batch in batches:
            rows = []
            for record_id, url, payload, refers_to in zip(
                batch["record_id"].astype(object).where(batch["record_id"].notna(), None), batch["url"], batch["payload"],
                batch["refers_to"].astype(object).where(batch["refers_to"].notna(), None), strict=True,
            ):
                if out is None or offset >= archive_bytes:
                    if out is not None:
                        out.close()
                    archive, offset = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = filesystem.open_output_stream(f"{base}/{archive}", compression=None)
                record_id = None if record_id is None else int(record_id)
                refers_to = None if refers_to is None else int(refers_to)
                payload = bytes(payload)
                sha1 = digest(payload)
                member = record_bytes(record_id, url, payload, refers_to, sha1)
                out.write(member)
                rows.append((record_id, archive, offset, len(member), url, sha1, RESPONSE if refers_to is None else REVISIT))
                offset += len(member)
            frame = pd.DataFrame(rows, columns=[c.split()[0] for c in INDEX_SCHEMA.split(", ")])
            frame["record_id"] = frame["record_id"].astype("Int64")
            yield frame
        if out is not None:
            out.close()

    return write


def ranges(rows: Iterator[tuple[str, int, int]], most: int = READ_BYTES, gap: int = READ_GAP) -> Iterator[tuple[str, int, int, list]]:
    """(archive, start, end, [(offset, length)]): sorted ranges that lie close together, as one."""
    archive, start, end, parts = "", 0, 0, []
    for name, offset, length in rows:
        if parts and (name != archive or offset - end > gap or offset + length - start > most):
            yield archive, start, end, parts
            parts = []
        if not parts:
            archive, start, end = name, offset, offset
        parts.append((offset, length))
        end = max(end, offset + length)
    if parts:
        yield archive, start, end, parts


def reader(folder: str):
    """A function for mapInPandas: reads sorted index rows back and yields what the records say."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        filesystem, base = open_folder(folder)
        source, opened = None, ""
        selected = (row for batch in batches for row in zip(batch["archive"], batch["offset"], batch["length"], strict=True))
        for archive, start, end, parts in ranges(selected):
            if archive != opened:
                source, opened = filesystem.open_input_file(f"{base}/{archive}"), archive
            block = source.read_at(end - start, start)
            rows = []
            for offset, length in parts:
                headers, body = parse_record(block[offset - start : offset - start + length])
                said = headers["warc-payload-digest"].removeprefix("sha1:")
                revisit = headers["warc-type"] == REVISIT
                if not revisit and digest(body) != said:
                    raise ValueError(f"record {headers['warc-record-id']} of {archive} is damaged")
                rows.append((
                    page_number(headers["warc-record-id"]), None if revisit else len(body), said, headers["warc-type"],
                    page_number(headers["warc-refers-to"]) if revisit else None,
                ))
            frame = pd.DataFrame(rows, columns=[c.split()[0] for c in RECORD_SCHEMA.split(", ")])
            yield frame.astype({"record_id": "Int64", "payload_bytes": "Int64", "refers_to": "Int64"})

    return read


def write_archives(pages: DataFrame, folder: str, *, key: str = "page_id", url: str = "url", payload: Column, least: int = 0) -> DataFrame:
    """Writes a record per row below the folder and returns the index, a written table.

    Payloads of at least ``least`` bytes are stored once; shorter ones are always responses.
    """
    spark = pages.sparkSession
    rows = pages.select(
        F.col(key).alias("record_id"), F.col(url).alias("url"), F.coalesce(payload.cast("binary"), F.lit(b"")).alias("payload")
    ).withColumn("same", F.sha1("payload"))
    shared = materialized(
        spark,
        rows.filter(F.octet_length("payload") >= least).groupBy("same")
        .agg(F.min("record_id").alias("first"), F.count("*").alias("n")).filter("n > 1").select("same", "first"),
        "warc-shared",
    )
    refers = F.when(F.col("first") != F.coalesce("record_id", F.col("first") - 1), F.col("first"))
    linked = rows.join(bounded(shared), "same", "left").select("record_id", "url", "payload", refers.alias("refers_to"))
    filesystem, base = open_folder(folder)
    filesystem.create_dir(base, recursive=True)
    return materialized(spark, linked.mapInPandas(writer(folder), INDEX_SCHEMA), "warc-index")


def read_archives(index: DataFrame, folder: str) -> DataFrame:
    """(record_id, payload_bytes, payload_digest, record_type, refers_to) of the records the index rows name.

    A revisit has the size of the payload it refers to, if that record is among those read, else null.
    """
    spark = index.sparkSession
    places = index.select("archive", "offset", "length")
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    near = places.repartitionByRange(tasks, "archive", "offset").sortWithinPartitions("archive", "offset")
    records = materialized(spark, near.mapInPandas(reader(folder), RECORD_SCHEMA), "warc-records")
    revisits = records.filter(F.col("record_type") == REVISIT).drop("payload_bytes")
    sizes = records.filter(F.col("record_type") == RESPONSE).groupBy("record_id", "payload_digest").agg(
        F.max("payload_bytes").alias("payload_bytes")
    ).withColumnRenamed("record_id", "refers_to")
    resolved = revisits.join(sizes, ["refers_to", "payload_digest"], "left")
    return records.filter(F.col("record_type") == RESPONSE).unionByName(resolved)


def archive_round_trip(pages: DataFrame, *, key: str = "page_id", url: str = "url", payload: Column, least: int = 0) -> DataFrame:
    """Writes all rows to new archives in the shared folder, then reads every record back."""
    folder = scratch_path(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, folder, key=key, url=url, payload=payload, least=least), folder)
