"""Token-ID output as directly addressable codes (operator 3).

File format. A table is a folder of Parquet files whose rows are segments; a segment is a self-contained binary value:

    magic "DAC1" | chunk bits u32 | documents D u64 | tokens n u64 | level count u32
    doc ids D x i64 | null flags of doc ids D x u8 | token counts D x u32
    per level: entries m u64 | packed chunks, m x chunk bits, in 8- or 16-bit words
               if not last: continuation bitmap, ceil(m / 64) u64 words | rank directory, one u64 per word (ones before it)

An id's lowest chunk is in level 0; a one in the continuation bitmap says that its next chunk is in the level above, at the
index that the rank directory gives. Any token is read with one rank per level and no block is decoded.

Rows are in ascending doc_id order (null first; equal ids by text) inside a partition, and partitions are ranges of doc_id.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hintforge.llm.common import shared_dir, text_chunks
from hintforge.llm.tokenizing import WordTokenizer

MAGIC = b"DAC1"
#: Tokens after which a segment is closed.
SEGMENT_TOKENS = 1 << 20
WORDS = {8: np.uint8, 16: np.uint16}


def encode_segment(doc_ids: list, counts: np.ndarray, ids: np.ndarray, bits: int = 8) -> bytes:
    """doc_ids may hold None; ids are all tokens of the documents, one after the other."""
    out, rest, levels = [], ids.astype(np.uint32), []
    while True:
        more = (rest >> np.uint32(bits)) > 0
        levels.append((rest & np.uint32((1 << bits) - 1), more))
        if not more.any():
            break
        rest = rest[more] >> np.uint32(bits)
    out.append(MAGIC + struct.pack("<IQQI", bits, len(doc_ids), len(ids), len(levels)))
    out.append(np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes())
    out.append(np.array([d is None for d in doc_ids], np.uint8).tobytes())
    out.append(counts.astype("<u4").tobytes())
    for k, (low, more) in enumerate(levels):
        out.append(struct.pack("<Q", len(low)) + low.astype(WORDS[bits]).tobytes())
        if k < len(levels) - 1:
            packed = np.zeros(-(-len(more) // 64) * 8, np.uint8)
            packed[: -(-len(more) // 8)] = np.packbits(more, bitorder="little")
            ones = np.bitwise_count(packed.view("<u8")).astype(np.uint64)
            out.append(packed.tobytes() + (np.cumsum(ones) - ones).astype("<u8").tobytes())
    return b"".join(out)


class Segment:
    """Random access into one encoded segment."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a segment of directly addressable codes")
        self.bits, docs, self.n, levels = struct.unpack_from("<IQQI", data, 4)
        at = 28

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(data, kind, count, at)
            at += found.nbytes
            return found

        ids, empty = take("<i8", docs), take("u1", docs)
        self.doc_ids = [None if e else int(d) for d, e in zip(ids, empty)]
        self.counts = take("<u4", docs).astype(np.int64)
        self.starts = np.cumsum(self.counts) - self.counts
        self.levels = []
        for k in range(levels):
            m = int(take("<u8", 1)[0])
            low = take(np.dtype(WORDS[self.bits]).str, m)
            words = -(-m // 64)
            self.levels.append((low, *((take("<u8", words), take("<u8", words)) if k < levels - 1 else (None, None))))

    def tokens(self, at: np.ndarray) -> np.ndarray:
        """The ids at any positions of the segment."""
        at = np.asarray(at, np.int64)
        out, where = np.zeros(len(at), np.uint32), np.arange(len(at))
        for k, (low, bitmap, ranks) in enumerate(self.levels):
            out[where] |= low[at].astype(np.uint32) << np.uint32(k * self.bits)
            if bitmap is None or not len(at):
                break
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            held = bitmap[word]
            more = (held >> bit) & np.uint64(1) == 1
            before = np.bitwise_count(held & ((np.uint64(1) << bit) - np.uint64(1)))
            at, where = (ranks[word].astype(np.int64) + before)[more], where[more]
        return out

    def every(self) -> np.ndarray:
        """All ids in order, level by level: the ones of a bitmap are the places of the level above, so no rank is asked."""
        out, at = np.zeros(self.n, np.uint32), None
        for k, (low, bitmap, _) in enumerate(self.levels):
            if at is None:
                out |= low
            else:
                out[at] |= low.astype(np.uint32) << np.uint32(k * self.bits)
            if bitmap is not None:
                more = np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), count=len(low), bitorder="little"))
                at = more if at is None else at[more]
        return out

    def document(self, i: int) -> np.ndarray:
        return self.tokens(np.arange(self.starts[i], self.starts[i] + self.counts[i]))


def write_codes(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, bits: int = 8, partitions: int | None = None) -> None:
    """Encodes docs(doc_id long, text string, ...) and writes the segments in ascending doc_id order.

    A null text counts as empty, so its document holds end_id alone; null doc_ids come first; rows with equal doc_ids are kept,
    in order of text; an empty table gives no segment. Other columns are not read.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, before, seq = WordTokenizer(tokenizer), 0, 0
        held: list[tuple[list, np.ndarray, np.ndarray]] = []
        tail = np.array([end_id], np.uint32)

        def close() -> pa.RecordBatch:
            nonlocal before, seq, held
            names, counts, ids = [d for h in held for d in h[0]], np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held])
            row = {"seq": seq, "before": before, "n_tokens": len(ids), "segment": encode_segment(names, counts, ids, bits)}
            before, seq, held = before + len(ids), seq + 1, []
            return pa.RecordBatch.from_pylist([row], schema=pa.schema([("seq", pa.int64()), ("before", pa.int64()), ("n_tokens", pa.int64()), ("segment", pa.binary())]))

        for part, texts in text_chunks(batches):
            ids, counts = words.ids(texts)
            ids = np.insert(ids, np.cumsum(counts), tail[0])
            held.append((part.column("doc_id").to_pylist(), counts + 1, ids))
            if sum(len(h[2]) for h in held) >= SEGMENT_TOKENS:
                yield close()
        if held:
            yield close()

    rows = docs.select("doc_id", "text")
    ordered = rows.repartitionByRange(partitions, "doc_id") if partitions else rows.repartitionByRange("doc_id")
    segments = ordered.sortWithinPartitions("doc_id", "text").mapInArrow(encode, "seq long, before long, n_tokens long, segment binary")
    segments.withColumn("part", F.spark_partition_id()).write.option("compression", "none").parquet(path)


def read_segments(spark, path: str) -> DataFrame:
    """The segments with each one's first token's place among all tokens.

    Only one total for each written partition is summed up in one place.
    """
    segments = spark.read.schema("seq long, before long, n_tokens long, segment binary, part int").parquet(path)
    totals = segments.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    bases = totals.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("base"))
    return segments.join(F.broadcast(bases), "part").select((F.col("base") + F.col("before")).alias("start"), "n_tokens", "segment")


def document_digests(spark, path: str) -> DataFrame:
    """Per document, decoded from the files: doc_id, start, n_tokens, ids_crc32."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, data in zip(batch.column("start").to_pylist(), batch.column("segment").to_pylist()):
                s = Segment(data)
                raw = memoryview(s.every().astype("<u4").tobytes())
                crcs = [zlib.crc32(raw[4 * a : 4 * (a + n)]) for a, n in zip(s.starts.tolist(), s.counts.tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(s.doc_ids, pa.int64()), pa.array(s.starts + start, pa.int64()), pa.array(s.counts, pa.int64()), pa.array(crcs, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return read_segments(spark, path).select("start", "segment").mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long")


def document_tokens(spark, path: str) -> DataFrame:
    """Per document, decoded from the files: doc_id, ids array<int>."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("segment").to_pylist():
                s = Segment(data)
                ids = pa.array(s.every().astype(np.int32))
                yield pa.RecordBatch.from_arrays([pa.array(s.doc_ids, pa.int64()), pa.ListArray.from_arrays(pa.array([*s.starts, s.n], pa.int32()), ids)], ["doc_id", "ids"])

    return read_segments(spark, path).select("segment").mapInArrow(decode, "doc_id long, ids array<int>")


def encode_documents(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    path = shared_dir(docs.sparkSession, "codes")
    write_codes(docs, path, tokenizer, end_id)
    return document_digests(docs.sparkSession, path)
