"""WARC archives: one gzip member per record, written and read sequentially."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import new_path, settle
from .common import text_chunks, with_unique_names

LEAST_REVISIT_BYTES = 1000
READ_BYTES = 1 << 16
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class BadRecord(ValueError):
    """A record whose framing or digest is wrong."""


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_of(urn: str | None) -> int | None:
    number = urn.strip("<>").rpartition(":")[2] if urn else ""
    return int(number) if number else None


def write_record(out: BinaryIO, headers: dict[str, str], block: bytes) -> None:
    """Append a record as a gzip member of its own."""
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers.items()) + f"Content-Length: {len(block)}\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    out.write(packer.compress(head.encode()) + packer.compress(block) + packer.compress(b"\r\n\r\n") + packer.flush())


def members(stream: BinaryIO) -> Iterator[Iterator[bytes]]:
    """The gzip members of a stream, each as an iterator of decompressed parts; read one after another."""
    rest = stream.read(READ_BYTES)
    while rest:
        unpacker = zlib.decompressobj(31)

        def parts() -> Iterator[bytes]:
            nonlocal rest
            while not unpacker.eof:
                if not rest and not (rest := stream.read(READ_BYTES)):
                    raise BadRecord("the archive ends inside a gzip member")
                data, rest = unpacker.decompress(rest, READ_BYTES), unpacker.unconsumed_tail or unpacker.unused_data
                if data:
                    yield data
            rest = rest or stream.read(READ_BYTES)

        yield parts()


def read_records(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record, framed by its Content-Length; block digests are verified.

    Memory holds one record at a time. Wrong versions, missing or wrong lengths, bytes behind the
    record's end and digest mismatches raise ``BadRecord``.
    """
    for parts in members(stream):
        buffer = bytearray()
        while (end := buffer.find(b"\r\n\r\n")) < 0:
            data = next(parts, None)
            if data is None:
                raise BadRecord("a record ends inside its headers")
            buffer += data
        first, *lines = buffer[:end].decode().split("\r\n")
        if not first.startswith("WARC/1."):
            raise BadRecord(f"unknown version {first!r}")
        headers = dict(line.split(": ", 1) for line in lines)
        length = int(headers["Content-Length"])
        del buffer[: end + 4]
        for data in parts:
            buffer += data
            if len(buffer) > length + 4:
                raise BadRecord("a record is longer than its Content-Length")
        if bytes(buffer[length:]) != b"\r\n\r\n":
            raise BadRecord("a record does not end at its Content-Length")
        block = bytes(buffer[:length])
        digest = headers.get("WARC-Block-Digest")
        if digest and digest != base32_sha1(block):
            raise BadRecord(f"block digest of {headers.get('WARC-Record-ID')} does not match")
        yield headers, block


def base32_sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def write_archives(pages: DataFrame, folder: str, id_column: str = "page_id", url_column: str = "url",
                   html_column: str = "html", least: int = LEAST_REVISIT_BYTES) -> DataFrame:
    """Write one record per row below ``folder``, one archive per task; returns the settled list of archives.

    Of rows with equal payloads of at least ``least`` bytes that with the largest id is a response, the
    others are revisits that refer to it; smaller payloads are all responses. A null payload is empty; a
    null id never is the largest, and a group of null ids only stays responses. Rows that repeat the
    largest id are all responses. Only payload digests seen twice enter the join; Spark measures
    whether they can be broadcast and else splits a hot digest (adaptive skew join).

    A task writes to a name of its attempt and lists it only when done, so files of failed attempts
    are never read.
    """
    rows = with_unique_names(pages, page_id=id_column, url=url_column, html=html_column)
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = rows.withColumn("digest", F.sha1(payload)).withColumn("size", F.octet_length(payload))
    winners = settle(
        rows.filter(F.col("size") >= least).groupBy(F.col("digest").alias("same")).agg(
            F.max("page_id").alias("winner"), F.count("*").alias("n"))
        .filter((F.col("n") > 1) & F.col("winner").isNotNull()).drop("n"), "winners")
    refers = F.when((F.col("size") >= least) & ~F.col("page_id").eqNullSafe(F.col("winner")), F.col("winner"))
    planned = rows.join(winners, F.col("digest") == F.col("same"), "left").withColumn("refers", refers).select(
        "page_id", "url", "html", "digest", "refers")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root)
        path, n, out = f"{root}/{uuid.uuid4().hex}.warc.gz", 0, None
        for chunk in text_chunks(batches, "html"):
            out = out or store.open_output_stream(path, compression=None)
            for row in chunk.to_pylist():
                data = (row["html"] or "").encode()
                headers = {"WARC-Type": "response", "WARC-Record-ID": record_id(row["page_id"]),
                           "WARC-Target-URI": " ".join((row["url"] or "").split()),
                           "WARC-Payload-Digest": "sha1:" + base64.b32encode(bytes.fromhex(row["digest"])).decode(),
                           "X-Payload-Length": str(len(data))}
                if row["refers"] is not None:
                    headers |= {"WARC-Type": "revisit", "WARC-Refers-To": record_id(row["refers"]), "WARC-Profile": PROFILE}
                    data = b""
                write_record(out, headers | {"WARC-Block-Digest": base32_sha1(data)}, data)
                n += 1
        if out:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([path.rpartition("/")[2]]), pa.array([n], pa.int64())], names=["file", "records"])

    return settle(planned.mapInArrow(write, "file string, records long"), "archives")


def read_archives(spark: SparkSession, folder: str, archives: DataFrame, with_payload: bool = False) -> DataFrame:
    """Read listed archives back, one sequential reader per file.

    Returns ``page_id, url, payload_bytes, payload_digest, record_type, refers_to`` (and ``payload``).
    The payload digest of every response is recomputed and compared; a mismatch fails the job. Of a
    revisit digest and length come from its headers.
    """
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long" + (
        ", payload binary" if with_payload else "")
    names = [x.split()[0] for x in schema.split(", ")]
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for file, expected in zip(batch.column("file").to_pylist(), batch.column("records").to_pylist()):
                rows, held, n = [], 0, 0
                with store.open_input_stream(f"{root}/{file}", compression=None) as stream:
                    for headers, block in read_records(stream):
                        claimed = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                        digest = base64.b32decode(claimed).hex()
                        if headers["WARC-Type"] == "response" and hashlib.sha1(block).hexdigest() != digest:
                            raise BadRecord(f"payload digest of {headers['WARC-Record-ID']} does not match")
                        rows.append((page_of(headers["WARC-Record-ID"]), headers["WARC-Target-URI"],
                                     int(headers["X-Payload-Length"]), digest, headers["WARC-Type"],
                                     page_of(headers.get("WARC-Refers-To")), block))
                        n, held = n + 1, held + len(block)
                        if len(rows) >= 4096 or held > READ_BYTES << 6:
                            yield emit(rows)
                            rows, held = [], 0
                if rows:
                    yield emit(rows)
                if n != expected:
                    raise BadRecord(f"{file} holds {n} records, {expected} were written")

    def emit(rows: list[tuple]) -> pa.RecordBatch:
        columns = [list(c) for c in zip(*rows)]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t, _ in zip(columns, types, names)], names=names)

    files = archives.select("file", "records")
    # One small row per archive: dealt out evenly, as each stands for a whole file.
    return files.repartition(max(1, files.count()), F.xxhash64("file")).mapInArrow(read, schema)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write the pages as archives in the shared folder and read them back."""
    spark = pages.sparkSession
    folder = new_path(spark, "warc")
    return read_archives(spark, folder, write_archives(pages, folder)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS payload_digest FROM p),
w AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS winner, count(*) OVER (PARTITION BY payload_digest) AS n FROM d),
t AS (SELECT *, CASE WHEN payload_bytes >= 1000 AND n > 1 AND page_id IS DISTINCT FROM winner THEN winner END AS refers_to FROM w)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to
FROM t
"""
