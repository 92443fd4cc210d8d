"""WARC archives as chunked record tables (operator 10).

An archive is a folder of Parquet files with rows (record_id, chunk, data, payload_bytes_so_far, digest_so_far, last): the
data of a record's chunks, in order, are its bytes in a WARC 1.1 file. A payload over CHUNK_BYTES spreads over as many rows, each
with the SHA-256 of the payload up to its end, so neither writer nor reader holds more than a chunk beside the input's value, and
each prefix of a payload can be checked alone. `export_warc` writes an archive's records as .warc files.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hintforge.llm.common import shared_dir

CHUNK_BYTES = 64 << 10
#: Rows are sent on when they hold so many bytes.
FLUSH_BYTES = 4 << 20
SCHEMA = "record_id string, chunk int, data binary, payload_bytes_so_far long, digest_so_far string, last boolean"
ARROW = pa.schema([("record_id", pa.string()), ("chunk", pa.int32()), ("data", pa.binary()), ("payload_bytes_so_far", pa.int64()), ("digest_so_far", pa.string()), ("last", pa.bool_())])
EMPTY_DIGEST = hashlib.sha256(b"").hexdigest()


def revisits(pages: DataFrame, min_bytes: int = 100) -> DataFrame:
    """(page_id, payload_digest, refers_to) of the pages that repeat an earlier page's payload; keys are distinct.

    Of equal payloads the row with the smallest page_id is first; a null page_id never is, unless none has one.
    """
    payload = F.coalesce("html", F.lit("")).cast("binary")
    slim = pages.select(F.col("page_id").cast("long"), F.sha2(payload, 256).alias("payload_digest"), F.octet_length(payload).alias("n")).where(F.col("n") >= min_bytes)
    firsts = slim.groupBy("payload_digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("k")).where("k > 1").drop("k")
    return slim.select("page_id", "payload_digest").distinct().join(firsts, "payload_digest").where(~F.col("page_id").eqNullSafe(F.col("refers_to")))


def write_archive(pages: DataFrame, path: str, min_bytes: int = 100, chunk_bytes: int = CHUNK_BYTES, date: str | None = None) -> None:
    """One record for each row of pages(page_id long, url string, html string, ...); date: all records' WARC-Date, else the time of writing.

    A null html is an empty payload; a null url gives no target; a null page_id is written as such. Rows equal in page_id and
    payload get the same record type, each its own record and record id. An empty table gives an empty archive. Other columns are not read.
    """
    date = date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long"), "url", payload.alias("payload"), F.sha2(payload, 256).alias("payload_digest"))
    again = revisits(pages, min_bytes).withColumn("again", F.lit(True))
    marked = rows.alias("r").join(again.alias("a"), F.col("r.page_id").eqNullSafe(F.col("a.page_id")) & (F.col("r.payload_digest") == F.col("a.payload_digest")), "left")
    # the number tells repeated rows apart
    marked = marked.select("r.page_id", "r.url", "r.payload", "r.payload_digest", "a.refers_to", F.col("a.again").isNotNull().alias("again"), F.monotonically_increasing_id().alias("number"))
    names = uuid.uuid4()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        held = 0
        for batch in batches:
            for page_id, url, data, digest, refers_to, again, number in zip(*(c.to_pylist() if k != 2 else c for k, c in enumerate(batch.columns))):
                view = memoryview(data.as_buffer())
                record = f"urn:uuid:{uuid.uuid5(names, str(number))}"
                head = record_head(record, date, page_id, url, len(view), digest, refers_to, again)
                size, so_far, at, chunk = (0 if again else len(view)), hashlib.sha256(), 0, 0
                while True:
                    piece = view[at : min(at + chunk_bytes, size)]
                    so_far.update(piece)
                    at += len(piece)
                    last = at >= size
                    rows.append({"record_id": record, "chunk": chunk, "data": (head if not chunk else b"") + bytes(piece) + (b"\r\n\r\n" if last else b""), "payload_bytes_so_far": at, "digest_so_far": so_far.hexdigest(), "last": last})
                    held, chunk = held + len(rows[-1]["data"]), chunk + 1
                    if held >= FLUSH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema=ARROW)
                        rows, held = [], 0
                    if last:
                        break
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=ARROW)

    marked.mapInArrow(write, SCHEMA).write.option("compression", "zstd").parquet(path)


def record_head(record: str, date: str, page_id: int | None, url: str | None, size: int, digest: str, refers_to: int | None, again: bool) -> bytes:
    """WARC header and HTTP header; their lengths are counted in Content-Length as the standard asks. Page-ID fields are extensions of our own."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if again else 'response'}", f"WARC-Record-ID: <{record}>", f"WARC-Date: {date}", f"Page-ID: {'' if page_id is None else page_id}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    lines += ["Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha256:{digest}"]
    if again:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"Refers-To-Page-ID: {'' if refers_to is None else refers_to}"]
    lines.append(f"Content-Length: {len(http) + (0 if again else size)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + http


def export_warc(spark, path: str, folder: str) -> int:
    """Writes the archive's records, byte for byte, into .warc files of a new folder on a file system that all executors mount (or the driver's,
    when local), one file for each of Spark's partitions, chunk by chunk. Returns the number of files; a task that runs again replaces its own."""
    import os

    os.makedirs(folder, exist_ok=False)
    rows = spark.read.schema(SCHEMA).parquet(path).select("record_id", "chunk", "data").repartition("record_id").sortWithinPartitions("record_id", "chunk")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        name, file = f"part-{TaskContext.get().partitionId():05d}", None
        for batch in batches:
            for data in batch.column("data"):
                if file is None:
                    unfinished = f"{folder}/.{name}-{uuid.uuid4().hex}"
                    file = open(unfinished, "wb")  # noqa: SIM115
                file.write(data.as_buffer())
        if file is not None:
            file.close()
            os.replace(unfinished, f"{folder}/{name}.warc")
            yield pa.RecordBatch.from_pydict({"name": [name]})

    return rows.mapInArrow(write, "name string").count()


HEAD = re.compile(rb"WARC/1\.1\r\n(.*?)\r\n\r\n(HTTP/.*?\r\n\r\n)", re.S)


def read_archive(spark, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of each record, parsed from the archive's bytes.

    Records of one row are read where they lie. Only chunks of longer ones are brought together, ordered and streamed. A response's
    digest is computed anew and compared with the header's and with every chunk's.
    """
    rows = spark.read.schema(SCHEMA).parquet(path)
    whole = rows.where("chunk = 0 AND last")
    parts = rows.where("NOT (chunk = 0 AND last)").repartition("record_id").sortWithinPartitions("record_id", "chunk")
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    arrow = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_record, at, digest, head = None, -1, None, {}
        for batch in batches:
            out: list[dict] = []
            for record, chunk, data, so_far, last in zip(*(batch.column(n).to_pylist() for n in ("record_id", "chunk")), batch.column("data"), *(batch.column(n).to_pylist() for n in ("digest_so_far", "last"))):
                view = memoryview(data.as_buffer())
                if chunk == 0 and last:
                    head, rest = parse_head(bytes(view))
                    digest = hashlib.sha256(view[rest : len(view) - 4])
                    out.append(finish(head, digest.hexdigest()))
                    continue
                rest = 0
                if chunk == 0:
                    (head, rest), digest = parse_head(bytes(view)), hashlib.sha256()
                elif (record, chunk) != (open_record, at + 1):
                    raise ValueError(f"chunk {chunk} of {record} does not follow chunk {at} of {open_record}")
                digest.update(view[rest : len(view) - (4 if last else 0)])
                open_record, at = record, chunk
                if digest.hexdigest() != so_far:
                    raise ValueError(f"chunk {chunk} of {record} is damaged")
                if last:
                    out.append(finish(head, digest.hexdigest()))
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    cols = ["record_id", "chunk", "data", "digest_so_far", "last"]
    return whole.select(cols).mapInArrow(parse, schema).unionByName(parts.select(cols).mapInArrow(parse, schema)).select(names)


def parse_head(data: bytes) -> tuple[dict, int]:
    """The record's fields and where its payload begins."""
    m = HEAD.match(data)
    if not m:
        raise ValueError("not a WARC record")
    fields = dict(line.split(b": ", 1) for line in m[1].split(b"\r\n"))
    size = int(re.search(rb"Content-Length: (\d+)", m[2])[1])
    number = lambda name: int(fields[name]) if fields.get(name) else None
    kind, digest = fields[b"WARC-Type"].decode(), fields[b"WARC-Payload-Digest"].split(b":")[1].decode()
    return {"page_id": number(b"Page-ID"), "payload_bytes": size, "payload_digest": digest, "record_type": kind, "refers_to": number(b"Refers-To-Page-ID")}, m.end()


def finish(head: dict, digest: str) -> dict:
    if digest != (head["payload_digest"] if head["record_type"] == "response" else EMPTY_DIGEST):
        raise ValueError(f"the payload of page {head['page_id']} does not match its digest")
    return head


def archive_pages(pages: DataFrame, min_bytes: int = 100, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Writes the pages to an archive in the shared folder and reads it back."""
    path = shared_dir(pages.sparkSession, "warc")
    write_archive(pages, path, min_bytes, chunk_bytes)
    return read_archive(pages.sparkSession, path)
