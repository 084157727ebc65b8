"""Operator 3 - WARC archives as a table of record chunks.

``write`` turns pages into gzipped WARC files on shared storage, one record per
page; a payload that an earlier page already has becomes a revisit record. ``read``
streams the files back as rows of (record id, chunk number): a payload of any size
passes through in pieces of ``CHUNK`` bytes, each with the digest and the length of
the payload up to and with it, so neither writer's output nor reader ever holds a
whole record.

Files go through ``pyarrow.fs`` under the folder of ``spark.checkpoint.dir`` (local or
mounted folders, hdfs://, s3://), never a machine's own temporary folder. A file
counts once the manifest names it, so files of failed or repeated tasks are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.scratch import save, small_batches
from quarry.session import scratch_table_path

CHUNK = 256 << 10
_READ = 1 << 20
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


@dataclass(frozen=True)
class Rule:
    """Payloads under ``least`` bytes are never revisits; a task starts a new file after ``roll`` bytes."""

    least: int = 100
    roll: int = 1 << 30
    level: int = 6


def _storage(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return fs.FileSystem.from_uri(uri)


def classify(pages: DataFrame, rule: Rule, name: str) -> DataFrame:
    """``pages`` (page_id, url, html) plus ``digest, bytes, record_type, refers_to``.

    The pages that share a payload are met only in a partial minimum per digest, written
    before it is joined, so that a payload of a third of all pages can be split.
    """
    payload = F.coalesce("html", F.lit("")).cast("binary")
    pages = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"),
                         F.sha2(payload, 256).alias("digest"), F.octet_length(payload).cast("long").alias("bytes"))
    firsts = save(pages.where(F.col("bytes") >= rule.least).groupBy("digest").agg(
        F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first"), name)
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return pages.join(firsts, "digest", "left").select(
        "page_id", "url", "html", "digest", "bytes", F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("first")).alias("refers_to"))


def _record_id(page: int | None, digest: str) -> str:
    return f"<urn:page:{'' if page is None else page}:{digest[:32]}>"


def _head(page: dict) -> tuple[bytes, bytes]:
    """The WARC header and the HTTP header of a page's record."""
    size = page["bytes"]
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n").encode()
    revisit = page["record_type"] == "revisit"
    lines = ["WARC/1.1", f"WARC-Type: {page['record_type']}",
             f"WARC-Record-ID: {_record_id(page['page_id'], page['digest'])}", "WARC-Date: 2000-01-01T00:00:00Z",
             "Content-Type: application/http;msgtype=response", f"WARC-Payload-Digest: sha256:{page['digest']}"]
    if page["url"]:
        lines.append("WARC-Target-URI: " + page["url"].replace("\r", "%0D").replace("\n", "%0A"))
    if revisit:
        lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {_record_id(page['refers_to'], page['digest'])}"]
    lines.append(f"Content-Length: {len(http) + (0 if revisit else size)}")
    return ("\r\n".join(lines) + "\r\n\r\n").encode(), http


def write(pages: DataFrame, folder: str | None = None, rule: Rule | None = None, name: str = "warc") -> DataFrame:
    """Write a record per page under ``folder``; returns the manifest ``path, records``.

    * Null html is an empty payload; null urls give no target; a null page id is an empty one.
    * Of pages with equal payloads of ``least`` bytes or more, those with the smallest page id are responses.
    * Repeated rows are repeated records. An empty table writes no file. Other columns are not read.
    """
    rule = rule or Rule()
    folder = folder or scratch_table_path(pages.sparkSession, name)
    small_batches(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _storage(folder)
        out, path, records = None, "", 0
        for batch in batches:
            for i in range(batch.num_rows):
                page = {c: batch.column(c)[i].as_py() for c in batch.schema.names if c != "html"}
                if out is None:
                    store.create_dir(root, recursive=True)
                    file = f"{uuid.uuid4().hex}.warc.gz"
                    path, records = f"{folder}/{file}", 0
                    out = store.open_output_stream(f"{root}/{file}", compression=None)
                member = zlib.compressobj(rule.level, wbits=31)
                warc, http = _head(page)
                out.write(member.compress(warc + http))
                if page["record_type"] == "response":
                    payload = batch.column("html")[i].as_buffer()
                    for at in range(0, payload.size, CHUNK):
                        out.write(member.compress(payload[at:at + CHUNK]))
                out.write(member.compress(b"\r\n\r\n") + member.flush())
                records += 1
                if out.tell() >= rule.roll:
                    out.close()
                    out = None
                    yield _manifest(path, records)
        if out is not None:
            out.close()
            yield _manifest(path, records)

    return save(classify(pages, rule, f"{name}-firsts").mapInArrow(run, "path string, records long"), f"{name}-manifest")


def _manifest(path: str, records: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"path": pa.array([path]), "records": pa.array([records], pa.int64())})


class _Stream:
    """Decompressed bytes of a file of gzip members, read in bounded pieces."""

    def __init__(self, source):
        self.source, self.member, self.held, self.raw = source, None, bytearray(), b""

    def fill(self) -> bool:
        """Add to ``held``; False at the end of the file."""
        while True:
            if not self.raw:
                self.raw = self.source.read(_READ)
                if not self.raw:
                    if self.member is not None:
                        raise ValueError("the archive ends within a record")
                    return False
            if self.member is None:
                self.member = zlib.decompressobj(wbits=31)
            got = self.member.decompress(self.raw, CHUNK)
            if self.member.eof:
                self.raw, self.member = self.member.unused_data, None
            else:
                self.raw = self.member.unconsumed_tail
            if got:
                self.held += got
                return True

    def until(self, mark: bytes) -> bytes | None:
        """Bytes up to ``mark``, which is passed over; None at the end of the file."""
        seen = 0
        while (at := self.held.find(mark, seen)) < 0:
            seen = max(0, len(self.held) - len(mark))
            if not self.fill():
                if self.held:
                    raise ValueError("the archive ends within a header")
                return None
        out = bytes(self.held[:at])
        del self.held[:at + len(mark)]
        return out

    def take(self, n: int) -> bytes:
        while len(self.held) < n and self.fill():
            pass
        if len(self.held) < n:
            raise ValueError("the archive ends within a record")
        out = bytes(self.held[:n])
        del self.held[:n]
        return out


def _fields(head: bytes) -> dict[str, str]:
    return {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode().split("\r\n")[1:])}


def records(source) -> Iterator[tuple]:
    """``(record_id, record_type, refers_to, chunk, data, bytes_so_far, digest_so_far, last)`` of a stream."""
    stream = _Stream(source)
    while (head := stream.until(b"\r\n\r\n")) is not None:
        fields = _fields(head)
        http = stream.until(b"\r\n\r\n") or b""
        left = int(fields["content-length"]) - len(http) - 4
        digest, so_far, chunk = hashlib.sha256(), 0, 0
        while True:
            data = stream.take(min(left, CHUNK))
            digest.update(data)
            left, so_far = left - len(data), so_far + len(data)
            yield (fields["warc-record-id"], fields["warc-type"], fields.get("warc-refers-to"), chunk, data, so_far,
                   digest.hexdigest(), left == 0)
            chunk += 1
            if not left:
                break
        if stream.take(4) != b"\r\n\r\n":
            raise ValueError(f"record {fields['warc-record-id']} does not end where it says")


CHUNKS = ("record_id string, record_type string, refers_to string, chunk int, data binary, bytes_so_far long, "
          "digest_so_far string, last boolean")


def read(manifest: DataFrame) -> DataFrame:
    """The chunk table of the archives that ``manifest`` names: one row per record and chunk, in file order.

    A record without payload has one empty chunk. Files are dealt over tasks; each is streamed.
    """
    kinds = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string()),
                       ("chunk", pa.int32()), ("data", pa.binary()), ("bytes_so_far", pa.int64()),
                       ("digest_so_far", pa.string()), ("last", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column("path").to_pylist():
                store, path = _storage(uri)
                held, size = [], 0
                with store.open_input_stream(path, compression=None) as source:
                    for row in records(source):
                        held.append(row)
                        size += len(row[4])
                        if size >= 4 << 20 or len(held) >= 4096:
                            yield _chunk_rows(held, kinds)
                            held, size = [], 0
                if held:
                    yield _chunk_rows(held, kinds)

    return manifest.select("path").repartition(max(1, manifest.count()), "path").mapInArrow(run, CHUNKS)


def _chunk_rows(held: list[tuple], kinds: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), kinds, strict=True)],
                                      schema=kinds)


def payloads(chunks: DataFrame, name: str = "warc") -> DataFrame:
    """Per record: ``page_id, payload_bytes, payload_digest, record_type, refers_to`` (a page id).

    A revisit has the length and the digest of the record it refers to.
    """
    page = F.nullif(F.split("record_id", ":")[2], F.lit("")).cast("long")
    ends = save(chunks.where("last").select("record_id", "record_type", "refers_to", "bytes_so_far", "digest_so_far"),
                f"{name}-ends")
    whole = save(ends.where("record_type = 'response'").groupBy("record_id").agg(
        F.first("bytes_so_far").alias("bytes"), F.first("digest_so_far").alias("digest"))
        .withColumnRenamed("record_id", "refers_to"), f"{name}-whole")
    own = ends.where("record_type = 'response'").select(
        "record_id", "record_type", "refers_to", F.col("bytes_so_far").alias("bytes"), F.col("digest_so_far").alias("digest"))
    again = ends.where("record_type = 'revisit'").join(whole, "refers_to", "left").select(*own.columns)
    return own.unionByName(again).select(
        page.alias("page_id"), F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
        "record_type", F.nullif(F.split("refers_to", ":")[2], F.lit("")).cast("long").alias("refers_to"))
