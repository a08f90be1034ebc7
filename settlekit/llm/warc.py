"""WARC archives: a writer with revisit records and a splittable reader.

Writing: the page with the smallest id among equal payloads becomes the response
record, the others revisit it. Every record is a gzip member of its own, so a
reader can start at any member. A task writes its records to a file with a name
of its own in a shared folder; only the files that finished tasks report are
part of the archive, so a lost executor leaves at most a file that nobody reads.

Reading: files are cut into byte ranges. A task looks for the gzip magic in its
range, accepts a candidate only if it decodes to a WARC header, and owns the
records that start inside its range; the last one may end beyond it.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_folder
from .common import salt

MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.0\r\n"
#: Bytes that a task of the reader scans, and that it reads at once.
SPLIT_BYTES = 8 << 20
READ_BYTES = 1 << 20
#: Equal payloads shorter than this are all written as responses.
MIN_REVISIT_BYTES = 0
GZIP_LEVEL = 1
PROFILE = b"http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """The store of a path and the path in it; a path without a scheme is a local one."""
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_bytes(fields: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member. Control characters of a header value become spaces."""
    clean = lambda s: "".join(c if c >= " " and c != "\x7f" else " " for c in s)
    head = "".join(f"{k}: {clean(v)}\r\n" for k, v in fields).encode()
    z = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, 31)
    return z.compress(VERSION + head + b"Content-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n") + z.flush()


def with_first(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """page_id, url, payload, and ``first``: the smallest page_id with this payload (null if shorter than ``min_bytes``).

    A payload that a third of all pages share is reduced in pieces, and the result goes
    back to the pages piece by piece, so no task holds all of them.
    """
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    keyed = pages.select("page_id", "url", payload.alias("payload")).withColumns(
        {"digest": F.unhex(F.sha1("payload")), "piece": salt("page_id")})
    parts = keyed.filter(F.octet_length("payload") >= min_bytes).groupBy("digest", "piece").agg(F.min("page_id").alias("first"))
    firsts = parts.groupBy("digest").agg(F.min("first").alias("first"))
    back = parts.select("digest", "piece").join(firsts, "digest").select(F.col("digest").alias("d"), F.col("piece").alias("p"), "first")
    return keyed.join(back, (keyed["digest"] == back["d"]) & (keyed["piece"] == back["p"]), "left").select("page_id", "url", "payload", "first")


def write_archive(pages: DataFrame, path: str, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Write a record per page below ``path``; returns the archive's files: file, bytes, records (written once, checkpointed).

    A null html is an empty payload, a null url an empty one. Pages that repeat id and
    html are all responses, as are pages without an id.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = file_system(path)
        out, name, size, count = None, f"{path.rstrip('/')}/part-{uuid.uuid4().hex}.warc.gz", 0, 0
        for batch in batches:
            for page, url, payload, first in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    store.create_dir(folder, recursive=True)
                    out = store.open_output_stream(file_system(name)[1], compression=None)
                revisit = first is not None and page is not None and page != first
                digest = sha1_base32(payload)
                fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", f"<urn:page:{'' if page is None else page}>"),
                          ("WARC-Target-URI", url or ""), ("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Payload-Length", str(len(payload)))]
                if revisit:
                    fields += [("WARC-Refers-To", f"<urn:page:{first}>"), ("WARC-Profile", PROFILE.decode())]
                data = record_bytes(fields, b"" if revisit else payload)
                out.write(data)
                size, count = size + len(data), count + 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"file": [name], "bytes": [size], "records": [count]})

    return with_first(pages, min_bytes).mapInArrow(run, "file string, bytes long, records long").checkpoint()


class _Window:
    """Bytes of a file from a moving start, read as far as they are asked for."""

    def __init__(self, source: pa.NativeFile, start: int):
        self.source, self.start, self.data, self.ended = source, start, b"", False
        source.seek(start)

    def more(self) -> bool:
        got = b"" if self.ended else self.source.read(READ_BYTES)
        self.ended = not got
        self.data += got
        return bool(got)

    def drop(self, n: int) -> None:
        self.data, self.start = self.data[n:], self.start + n


def _member(window: _Window, at: int) -> tuple[dict[str, str], bytes, int] | None:
    """Fields, block and the offset after the member at this offset of the window.

    None unless it decodes to a WARC record and the file ends or goes on with a member after it.
    """
    z, decoded, pos = zlib.decompressobj(31), bytearray(), at
    try:
        while not z.eof:
            if pos >= len(window.data) and not window.more():
                return None
            chunk = window.data[pos:pos + READ_BYTES]
            pos += len(chunk)
            decoded += z.decompress(chunk)
            if len(decoded) >= len(VERSION) and not decoded.startswith(VERSION):
                return None
    except zlib.error:
        return None
    after = pos - len(z.unused_data)
    while len(window.data) < after + len(MAGIC) and window.more():
        pass
    if window.data[after:after + len(MAGIC)] not in (MAGIC, b""):
        return None
    found = parse_record(bytes(decoded))
    return (*found, after) if found else None


def parse_record(record: bytes) -> tuple[dict[str, str], bytes] | None:
    """Header fields (names in lower case) and block, if this is a whole WARC record."""
    head, found, rest = record.partition(b"\r\n\r\n")
    if not found or not head.startswith(VERSION):
        return None
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in head[len(VERSION):].decode("utf-8", "replace").split("\r\n"))}
    size = fields.get("content-length", "")
    if not size.isdigit() or "warc-type" not in fields or len(rest) < int(size):
        return None
    return fields, rest[:int(size)]


def records_starting_in(source: pa.NativeFile, start: int, end: int) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Offset, fields and block of the records whose first byte lies in [start, end)."""
    window, at = _Window(source, start), 0
    while window.start + at < end:
        at = window.data.find(MAGIC, at)
        if at < 0:
            window.drop(max(0, len(window.data) - len(MAGIC) + 1))
            at = 0
            if window.start >= end or not window.more():
                return
            continue
        if window.start + at >= end:
            return
        found = _member(window, at)
        if found is None:
            at += 1
            continue
        fields, block, after = found
        yield window.start + at, fields, block
        window.drop(after)
        at = 0


def read_archive(spark: SparkSession, files: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """file, offset, fields (map), block of every record of the archive files (columns file, bytes).

    A response whose block does not have the digest that its header names fails the job.
    """
    ranges = (files.filter("bytes > 0").select("file", F.explode(F.sequence(F.lit(0), F.col("bytes") - 1, F.lit(split_bytes).cast("long"))).alias("start"))
              .withColumn("end", F.col("start") + split_bytes))
    n = max(1, files.agg(F.sum(F.ceil(F.col("bytes") / split_bytes))).first()[0] or 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, start, end in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                store, path = file_system(name)
                rows: list[tuple] = []
                size = 0
                with store.open_input_file(path) as source:
                    for offset, fields, block in records_starting_in(source, start, end):
                        if fields["warc-type"] == "response" and fields.get("warc-payload-digest", "").removeprefix("sha1:") not in ("", sha1_base32(block)):
                            raise ValueError(f"{name}: the record at {offset} is damaged")
                        rows.append((name, offset, list(fields.items()), block))
                        size += len(block)
                        if size > READ_BYTES:
                            yield _batch(rows)
                            rows, size = [], 0
                if rows:
                    yield _batch(rows)

    kinds = "file string, offset long, fields map<string,string>, block binary"
    return ranges.repartition(int(n)).mapInArrow(run, kinds)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    file, offset, fields, block = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(file, pa.string()), pa.array(offset, pa.int64()), pa.array(fields, pa.map_(pa.string(), pa.string())),
                                       pa.array(block, pa.binary())], ["file", "offset", "fields", "block"])


def page_records(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, url and block of the records of pages.

    The length of a response is that of the block that was read; a revisit names that of its payload.
    """
    field = lambda k: F.col("fields")[k]
    page = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1)
    number = lambda c: F.when(page(c) != "", page(c).cast("long"))
    revisit = field("warc-type") == "revisit"
    return records.select(
        number(field("warc-record-id")).alias("page_id"),
        F.when(revisit, field("warc-payload-length").cast("long")).otherwise(F.octet_length("block").cast("long")).alias("payload_bytes"),
        F.regexp_replace(field("warc-payload-digest"), "^sha1:", "").alias("payload_digest"), field("warc-type").alias("record_type"),
        number(field("warc-refers-to")).alias("refers_to"), field("warc-target-uri").alias("url"), "block")


def round_trip(pages: DataFrame, path: str | None = None) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every page, written to WARC and read back.

    Rows as in ``write_archive``; an empty table gives no rows. Only page_id, url and html are read.
    """
    spark = pages.sparkSession
    files = write_archive(pages, path or scratch_folder(spark, "warc"))
    found = page_records(read_archive(spark, files))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
