"""WARC archives (op5): written as one gzip member per record, read back in byte ranges.

The reader needs no index.  A task gets a byte range of one file, looks for gzip magic from its
start, and takes a place for a record only if a member decodes there whose first bytes are a WARC
header that parses.  It owns the records that start inside its range: the last one is read past
the range's end, and one that began before it is left to the task before.  From a record's end the
next is found without a search.  A record that doesn't decode, has no valid length, or whose
payload doesn't match its digest is an error, not a gap.

Files are opened with Arrow's file systems by their URI, in the tasks.  A writer task names its
file by a random id and returns its path; only paths that came back with a finished task are read,
so files of lost or repeated tasks don't count.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm.store import modest_batches, table, written
from rollcall.session import scratch_path

MIN_BYTES = 0  # smaller payloads are never revisits
MAX_FILE = 1 << 30
RANGE = 64 << 20
LEAST_RANGE = 256 << 10
BLOCK = 256 << 10
LEVEL = 4
DATE = "2024-01-01T00:00:00Z"
MAGIC = b"\x1f\x8b\x08"


def file_system(uri: str) -> tuple[arrow_fs.FileSystem, str]:
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:") :]
    return arrow_fs.FileSystem.from_uri(uri)


def _record_id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def _line(value: str) -> str:
    return value.replace("\r", "%0D").replace("\n", "%0A")


def member(page_id, url, payload: bytes, first) -> bytes:
    """One record as a gzip member; ``first`` is the page that a revisit refers to, None for a response."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if first is not None else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if first is None else 'revisit'}", f"WARC-Record-ID: {_record_id(page_id, digest)}", f"WARC-Date: {DATE}"]
    lines += [f"WARC-Target-URI: {_line(url)}"] if url is not None else []
    lines += [f"X-Page-ID: {page_id}"] if page_id is not None else []
    lines += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    if first is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_record_id(first, digest)}", f"X-Refers-To-Page-ID: {first}"]
    press = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return press.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + press.flush()


def _headers(data: bytes, end: int) -> dict[str, str]:
    pairs = (line.partition(":") for line in data[:end].decode("utf-8", "replace").split("\r\n")[1:])
    return {k.strip().lower(): v.strip() for k, _, v in pairs}


class Archive:
    """A WARC file read by position."""

    def __init__(self, path: str):
        system, name = file_system(path)
        self.file = system.open_input_file(name)
        self.size = self.file.size()

    def at(self, start: int, length: int = BLOCK) -> bytes:
        return self.file.read_at(max(0, min(length, self.size - start)), start)

    def decode(self, start: int) -> tuple[bytes, int] | None:
        """The member at ``start`` and where it ends; None if no WARC record decodes there."""
        unpack, out, here = zlib.decompressobj(31), [], start
        try:
            while not unpack.eof:
                data = self.at(here)
                if not data:
                    return None
                here += len(data)
                out.append(unpack.decompress(data))
                if len(out) == 1 and not out[0].startswith(b"WARC/"):
                    return None
        except zlib.error:
            return None
        record = b"".join(out)
        end = record.find(b"\r\n\r\n")
        if end < 0 or "warc-type" not in _headers(record, end):
            return None
        return record, here - len(unpack.unused_data)

    def records(self, start: int, end: int) -> Iterator[bytes]:
        """Records whose member starts in ``[start, end)``."""
        here, sure = start, start == 0
        while here < end:
            found = self.decode(here) if sure or self.at(here, 3) == MAGIC else None
            if found:
                sure = True
                yield found[0]
                here = found[1]
            elif sure:
                raise ValueError(f"no WARC record at byte {here}")
            else:
                data = self.at(here + 1, min(BLOCK, end - here) + 1)  # two bytes past, for magic across the edge
                next_ = data.find(MAGIC)
                here = here + 1 + next_ if next_ >= 0 else here + max(1, len(data) - 2)
                if len(data) < 3:
                    return


def parse(record: bytes) -> dict:
    """Fields of a record; its payload and digest are checked."""
    end = record.find(b"\r\n\r\n")
    head = _headers(record, end)
    block = record[end + 4 : end + 4 + int(head["content-length"])]
    if len(block) != int(head["content-length"]):
        raise ValueError("a record is shorter than its length")
    split = block.find(b"\r\n\r\n")
    response, payload = head["warc-type"] == "response", block[split + 4 :]
    digest = head["warc-payload-digest"].removeprefix("sha1:")
    if response and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
        raise ValueError("a payload doesn't match its digest")
    number = lambda key: int(head[key]) if key in head else None
    return {
        "page_id": number("x-page-id"), "url": head.get("warc-target-uri"), "payload_bytes": len(payload) if response else int(_headers(block, split)["content-length"]),
        "payload_digest": digest, "record_type": head["warc-type"], "refers_to": number("x-refers-to-page-id"), "payload": payload if response else None,
    }


def write(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = MIN_BYTES) -> DataFrame:
    """Archives every row; returns ``path, bytes, records`` per file.

    Of rows with equal payloads of at least ``min_bytes`` bytes, that with the smallest page_id is
    the response and the others revisit it; rows that repeat that page_id are responses too.  A
    null html is an empty payload, a null url no target.  A null page_id comes after all others;
    if a payload has no other, all its rows are responses.  An empty table writes nothing.
    """
    modest_batches(pages.sparkSession)
    folder = scratch_path(pages.sparkSession, "warc")
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(html).cast("binary"), F.lit("").cast("binary")).alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    first = written(rows.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("c")).where("c > 1").drop("c"), "first")
    linked = rows.join(first, "digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")) & (F.octet_length("payload") >= min_bytes)
    linked = linked.select("page_id", "url", "payload", F.when(revisit, F.col("first")).alias("first"))

    def store(batches):
        system, root = file_system(folder)
        out, path, done = None, "", []
        size = count = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None or size >= MAX_FILE:
                    if out is not None:
                        out.close()
                        done.append((path, size, count))
                    system.create_dir(root, recursive=True)
                    name = f"part-{uuid.uuid4().hex}.warc.gz"
                    out, path, size, count = system.open_output_stream(f"{root}/{name}", compression=None), f"{folder}/{name}", 0, 0
                data = member(*row)
                out.write(data)
                size, count = size + len(data), count + 1
        if out is not None:
            out.close()
            done.append((path, size, count))
        yield pa.RecordBatch.from_pylist([dict(zip(("path", "bytes", "records"), d, strict=True)) for d in done], pa.schema([("path", pa.string()), ("bytes", pa.int64()), ("records", pa.int64())]))

    return written(linked.mapInArrow(store, "path string, bytes long, records long"), "archives")


def read(files: DataFrame, payload: bool = True, range_bytes: int | None = None) -> DataFrame:
    """One row per record of the archives ``path, bytes``, in ranges of ``range_bytes`` (by default the size that gives every core a few, up to 64 MB)."""
    spark = files.sparkSession
    total = files.agg(F.sum("bytes")).first()[0] or 0
    step = range_bytes or max(LEAST_RANGE, min(RANGE, total // (4 * spark.sparkContext.defaultParallelism)))
    ranges = files.where("bytes > 0").select("path", "bytes", F.explode(F.expr(f"sequence(0L, bytes - 1, {step}L)")).alias("start"))
    ranges = ranges.select("path", "start", F.least(F.col("start") + step, "bytes").alias("end"))
    ranges = ranges.repartition(max(1, ranges.count()))
    fields = [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
    schema = pa.schema(fields + [("payload", pa.binary())] * payload)

    def load(batches):
        for batch in batches:
            for path, start, end in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows, held = [], 0
                for record in Archive(path).records(start, end):
                    rows.append({k: v for k, v in parse(record).items() if payload or k != "payload"})
                    held += len(record) if payload else 200
                    if held >= 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    return ranges.mapInArrow(load, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long" + ", payload binary" * payload)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(write(table(spark, sf_dir, "pages")), payload=False).drop("url")
