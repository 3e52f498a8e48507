"""WARC archives with a Zstandard dictionary, written and read by Spark tasks.

An archive starts with a skippable frame that holds the dictionary, built from
archived records; every record after it is a frame of its own, so one record
can be read from its offset alone. Each task streams its rows into files of
bounded size and reports them; the report (one row per file) names the files
that count, so files left by lost tasks are never read. Folders may be local
paths or any URI that Arrow opens.

Of records with equal payloads, that with the largest page id is a response and
the others revisit it. A null html is an empty payload; a null page id never
wins over another; rows that repeat the largest id are all responses. A null
url leaves its header out, and control characters in urls are percent-encoded.
Extra columns are ignored, and an empty table gives no archive.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.stages import require_columns
from .sampling import hash_sample

# Frame magic, record headers and profile of the formats.
SKIPPABLE_MAGIC = 0x184D2A5D
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD_NAME = "urn:page:"
FILES_SCHEMA = "path string, records long, bytes long"
RECORDS_SCHEMA = (
    "path string, offset long, record_type string, page_id long, url string, "
    "payload_digest string, payload_bytes long, refers_to long, payload binary"
)
DICTIONARY_BYTES = 32 << 10
#: The dictionary is built from about so many records, each up to so many bytes.
SAMPLE_RECORDS = 400
SAMPLE_BYTES = 16 << 10
FILE_BYTES = 256 << 20
#: Rows of one payload are spread over so many join keys.
SALTS = 64
READ_BYTES = 64 << 10


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def mark_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Add ``refers_to``: the response's page id for rows that repeat a payload
    of at least ``min_bytes`` bytes, else null.

    Only payloads that occur more than once are joined, by digest and salt, so
    a payload that a third of all rows share is spread over many tasks.
    """
    require_columns(pages, "page_id", "url", "html")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    ).withColumns(
        {"digest": F.unhex(F.sha1("html")), "salt": F.pmod(F.hash("page_id", "url"), F.lit(SALTS))}
    )
    repeated = (
        rows.where(F.octet_length("html") >= min_bytes)
        .groupBy("digest")
        .agg(F.max("page_id").alias("response"), F.count("*").alias("n"))
        .where("n > 1")
        .select("digest", "response", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    )
    other = ~F.col("page_id").eqNullSafe(F.col("response"))
    return rows.join(repeated.hint("merge"), ["digest", "salt"], "left").select(
        "page_id", "url", "html", F.when(other, F.col("response")).alias("refers_to")
    )


def build_dictionary(pages: DataFrame) -> bytes:
    """A dictionary from a bounded sample of the records to be archived, picked
    by hash. Too few records to train on become the dictionary themselves."""
    head = F.encode(F.substring("html", 1, SAMPLE_BYTES), "utf-8").alias("head")
    picked = hash_sample(pages, SAMPLE_RECORDS, "page_id").select(head)
    sample = sorted(bytes(r["head"]) for r in picked.where(F.octet_length("head") > 0).collect())
    texts = [_response(None, None, s) for s in sample]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, texts).as_bytes()
    except zstandard.ZstdError:
        return b"".join(texts)[-DICTIONARY_BYTES:]


def _head(kind: str, page_id: int | None, url: str | None, digest: str, more: list[str], block: int) -> bytes:
    lines = [VERSION, f"WARC-Type: {kind}"]
    lines.append(f"WARC-Record-ID: <{RECORD_NAME}{'none' if page_id is None else page_id}>")
    if url is not None:
        safe = "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in url)
        lines.append(f"WARC-Target-URI: {safe}")
    lines += ["WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}", *more]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {block}", "", ""]
    return "\r\n".join(lines).encode()


def _http(length: int) -> bytes:
    return (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {length}\r\n\r\n"
    ).encode()


def _response(page_id: int | None, url: str | None, payload: bytes) -> bytes:
    block = _http(len(payload)) + payload
    return _head("response", page_id, url, base32_sha1(payload), [], len(block)) + block + b"\r\n\r\n"


def _revisit(page_id: int | None, url: str | None, payload: bytes, refers_to: int) -> bytes:
    block = _http(len(payload))
    more = [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <{RECORD_NAME}{refers_to}>"]
    return _head("revisit", page_id, url, base32_sha1(payload), more, len(block)) + block + b"\r\n\r\n"


def _qualified(spark: SparkSession, folder: str) -> str:
    """A folder without a scheme, with that of Spark's default file system, unless
    that is the local one; so tasks write where Spark's own tables are."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = system.makeQualified(path).toString()
    return folder if found.startswith("file:") else found


def _open(path: str) -> tuple[fs.FileSystem, str]:
    path = f"s3://{path[6:]}" if path.startswith("s3a://") else path
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def write_archives(marked: DataFrame, folder: str, dictionary: bytes) -> DataFrame:
    """Write rows of ``mark_revisits`` as archives below ``folder``; one row per
    file. Stage the result before reading, so that files are written once. A folder
    without a scheme lies in Spark's default file system."""
    folder = _qualified(marked.sparkSession, folder)

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        system, base = _open(folder)
        system.create_dir(base, recursive=True)
        known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        packer = zstandard.ZstdCompressor(level=3, dict_data=known)
        frame = struct.pack("<II", SKIPPABLE_MAGIC, len(dictionary)) + dictionary if dictionary else b""
        out, path, records, size = None, "", 0, 0

        def report() -> pa.RecordBatch:
            values = [[f"{folder}/{path}"], [records], [size]]
            kinds = [pa.string(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(values, kinds)], ["path", "records", "bytes"]
            )

        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    path = f"{task.partitionId():06d}-{uuid.uuid4().hex}.warc.zst"
                    out, records, size = system.open_output_stream(f"{base}/{path}", compression=None), 0, len(frame)
                    out.write(frame)
                payload = row["html"].encode()
                if row["refers_to"] is None:
                    record = _response(row["page_id"], row["url"], payload)
                else:
                    record = _revisit(row["page_id"], row["url"], payload, row["refers_to"])
                packed = packer.compress(record)
                out.write(packed)
                records, size = records + 1, size + len(packed)
                if size >= FILE_BYTES:
                    out.close()
                    out = None
                    yield report()
        if out is not None:
            out.close()
            yield report()

    return marked.mapInArrow(written, FILES_SCHEMA)


def frames(path: str, start: int | None = None) -> Iterator[tuple[int, bytes]]:
    """Offset and content of every record of an archive, as a stream, from the
    first record or from the one at offset ``start``."""
    system, name = _open(path)
    with system.open_input_file(name) as source:
        head = source.read(8)
        known, at, rest = None, 0, head
        if len(head) == 8 and struct.unpack("<I", head[:4])[0] == SKIPPABLE_MAGIC:
            size = struct.unpack("<I", head[4:])[0]
            known, at, rest = zstandard.ZstdCompressionDict(source.read(size)), 8 + size, b""
        if start is not None:
            source.seek(start)
            at, rest = start, b""
        unpacker = zstandard.ZstdDecompressor(dict_data=known)
        while True:
            rest = rest or source.read(READ_BYTES)
            if not rest:
                return
            frame, parts, used = unpacker.decompressobj(), [], 0
            while not frame.eof:
                if not rest:
                    rest = source.read(READ_BYTES)
                    if not rest:
                        raise ValueError(f"record cut off at {at} in {path}")
                parts.append(frame.decompress(rest))
                used += len(rest)
                rest = b""
            rest = frame.unused_data
            used -= len(rest)
            yield at, b"".join(parts)
            at += used


def parse_record(record: bytes) -> dict:
    """The fields of one record; a revisit has no payload of its own."""
    head, _, block = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    http, _, payload = block[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    inner = dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])
    number = lambda name: fields[name][1 + len(RECORD_NAME) : -1] if name in fields else "none"
    page_id, refers_to = number("WARC-Record-ID"), number("WARC-Refers-To")
    return {
        "record_type": fields["WARC-Type"],
        "page_id": None if page_id == "none" else int(page_id),
        "url": fields.get("WARC-Target-URI"),
        "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"),
        "payload_bytes": int(inner["Content-Length"]),
        "refers_to": None if refers_to == "none" else int(refers_to),
        "payload": payload if fields["WARC-Type"] == "response" else None,
    }


def read_archives(files: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of archives, given a table with their ``path``. Payloads of
    responses are checked against their digest."""
    require_columns(files, "path")
    kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
    names = [f.split()[0] for f in RECORDS_SCHEMA.split(", ")]

    def batch_of(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds)], names
        )

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, size = [], 0
                for offset, record in frames(path):
                    row = {"path": path, "offset": offset} | parse_record(record)
                    if row["payload"] is not None:
                        if len(row["payload"]) != row["payload_bytes"] or base32_sha1(row["payload"]) != row["payload_digest"]:
                            raise ValueError(f"damaged payload at {offset} in {path}")
                        size += len(row["payload"])
                    if not payloads:
                        row["payload"] = None
                    rows.append(row)
                    if size > (8 << 20) or len(rows) >= 2000:
                        yield batch_of(rows)
                        rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    return files.select("path").mapInArrow(records, RECORDS_SCHEMA)


def read_record(path: str, offset: int) -> dict:
    """One record by its offset."""
    return next(parse_record(record) for _, record in frames(path, offset))


def spread_files(spark: SparkSession, files: DataFrame) -> DataFrame:
    """One task per few archives: the list itself is one small split."""
    return files.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path")
