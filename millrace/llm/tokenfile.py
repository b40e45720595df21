"""Token ids as binary segments with Elias-Fano encoded document boundaries.

Documents are encoded in ascending order of id and their ids stand in one long array, cut
into segments of about ``SEGMENT_IDS``. A segment is one binary value:

    header    magic "EFT1", then little-endian: bytes per id (u1), 7 bytes of zero, documents
              (u8), documents with a null id (u8), the smallest id (i8), ids (u8)
    doc ids   an Elias-Fano list: each id less the smallest one
    ends      an Elias-Fano list: where each document's ids end, counted from the segment
    ids       the concatenated array, 2 or 4 bytes each

An Elias-Fano list of n numbers up to u keeps the low bits of each as they are and the high
bits in unary, in n * (2 + log2(u / n)) bits or so, with the place of every 64th number as a
select sample, so that the i-th is found without decoding the others. Segments are rows of
a Parquet table in the shared folder (any store that Spark reads will do), each with its
part, the ids of that part before it, and its own number of ids.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .bytebpe import encoder
from .text import id_and_text, slices

MAGIC = b"EFT1"
SEGMENT_IDS = 1 << 20
SAMPLE = 64
_HEADER = struct.Struct("<4sB7xQQqQ")
_LIST = struct.Struct("<QBxxxxxxxQQ")


class EliasFano:
    """A list of non-decreasing numbers in near-minimal space, each readable by itself."""

    def __init__(self, size: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray) -> None:
        self.size, self.low_bits = size, low_bits
        self.low, self.high, self.samples = low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, dtype=np.uint64)
        size = len(values)
        most = int(values[-1]) if size else 0
        low_bits = max(0, (most // size).bit_length() - 1) if size else 0
        places = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(size)
        bits = np.zeros((int(places[-1]) + 1) if size else 0, dtype=np.uint8)
        bits[places] = 1
        shifts = np.arange(low_bits, dtype=np.uint64)
        low = ((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8)
        return cls(size, low_bits, np.packbits(low.ravel(), bitorder="little"),
                   np.packbits(bits, bitorder="little"), places[::SAMPLE].astype("<u8"))

    def tobytes(self) -> bytes:
        head = _LIST.pack(self.size, self.low_bits, len(self.low), len(self.high))
        return head + self.low.tobytes() + self.high.tobytes() + self.samples.tobytes()

    @classmethod
    def read(cls, data: bytes, at: int) -> tuple[EliasFano, int]:
        """The list that begins at a byte, and the byte after it."""
        size, low_bits, low, high = _LIST.unpack_from(data, at)
        at += _LIST.size
        parts = []
        for count, kind in ((low, "u1"), (high, "u1"), (-(-size // SAMPLE), "<u8")):
            parts.append(np.frombuffer(data, kind, count, at))
            at += parts[-1].nbytes
        return cls(size, low_bits, *parts), at

    def _low(self, i: int) -> int:
        first, last = i * self.low_bits, (i + 1) * self.low_bits
        whole = int.from_bytes(self.low[first // 8:-(-last // 8)].tobytes(), "little")
        return (whole >> first % 8) & ((1 << self.low_bits) - 1)

    def select(self, i: int) -> int:
        """The i-th number: from its sample on, ones are counted byte by byte."""
        if not 0 <= i < self.size:
            raise IndexError(i)
        place = int(self.samples[i // SAMPLE])
        left = i % SAMPLE
        byte = place // 8
        bits = int(self.high[byte]) >> place % 8 << place % 8
        while left >= bits.bit_count():
            left -= bits.bit_count()
            byte += 1
            bits = int(self.high[byte])
        for _ in range(left):
            bits &= bits - 1
        place = byte * 8 + (bits & -bits).bit_length() - 1
        return (place - i) << self.low_bits | self._low(i)

    def all(self) -> np.ndarray:
        places = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[:self.size].astype(np.uint64)
        high = (places - np.arange(self.size, dtype=np.uint64)) << np.uint64(self.low_bits)
        bits = np.unpackbits(self.low, bitorder="little")[:self.size * self.low_bits].reshape(self.size, self.low_bits)
        weights = np.uint64(1) << np.arange(self.low_bits, dtype=np.uint64)
        return high + (bits.astype(np.uint64) * weights).sum(axis=1, dtype=np.uint64)


def pack(doc_ids: list[int | None], lengths: list[int], ids: bytes, width: int) -> bytes:
    """A segment: documents in ascending order of id, nulls first."""
    known = [d for d in doc_ids if d is not None]
    first = known[0] if known else 0
    gaps = np.array([d - first for d in known], dtype=np.uint64)
    head = _HEADER.pack(MAGIC, width, len(doc_ids), len(doc_ids) - len(known), first, len(ids) // width)
    ends = np.cumsum(np.array(lengths, dtype=np.uint64), dtype=np.uint64)
    return head + EliasFano.of(gaps).tobytes() + EliasFano.of(ends).tobytes() + ids


class Segment:
    """A packed segment, read in place."""

    def __init__(self, data: bytes) -> None:
        magic, self.width, self.documents, self.nulls, self.first, self.size = _HEADER.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a token segment")
        self.gaps, at = EliasFano.read(data, _HEADER.size)
        self.ends, at = EliasFano.read(data, at)
        self.ids = np.frombuffer(data, f"<u{self.width}", self.size, at)

    def doc_ids(self) -> list[int | None]:
        return [None] * self.nulls + [self.first + int(g) for g in self.gaps.all()]

    def bounds(self, i: int) -> tuple[int, int]:
        """Where the i-th document's ids begin and end, by select."""
        return (self.ends.select(i - 1) if i else 0), self.ends.select(i)


def _portions(batches: Iterator[pa.RecordBatch], size: int = 4_000_000) -> Iterator[tuple[list, list[str]]]:
    ids, texts, total = [], [], 0
    for batch in slices(batches):
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ids.append(doc)
            texts.append(text or "")
            total += len(texts[-1])
            if total >= size:
                yield ids, texts
                ids, texts, total = [], [], 0
    if ids:
        yield ids, texts


_SEGMENTS = "part int, segment int, before long, size long, data binary"


def write_tokens(
    docs: DataFrame, path: str, to: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Encode every whole text (null: empty), end each with ``end_id`` and write segments to ``to``.

    Documents lie in ascending order of id over all parts, nulls first; rows with equal ids
    are in order of a hash of their texts. An empty table writes an empty one.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        width = coder.kind.itemsize
        end = np.array([end_id], coder.kind).tobytes()
        part = TaskContext.get().partitionId()
        number = before = 0

        def packed(ids: list, lengths: list[int], data: list[bytes]) -> pa.RecordBatch:
            nonlocal number, before
            size = sum(lengths)
            row = [part, number, before, size, pack(ids, lengths, b"".join(data), width)]
            number, before = number + 1, before + size
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], _names(_SEGMENTS))

        ids, lengths, data, size = [], [], [], 0
        for some, texts in _portions(batches):
            for doc, found in zip(some, coder.encode(texts)):
                ids.append(doc)
                data.append(found.tobytes() + end)
                lengths.append(len(found) + 1)
                size += lengths[-1]
                if size >= SEGMENT_IDS:
                    yield packed(ids, lengths, data)
                    ids, lengths, data, size = [], [], [], 0
        if ids:
            yield packed(ids, lengths, data)

    (
        id_and_text(docs, id_col, text_col)
        .withColumn("tie", F.xxhash64("text"))  # a hot id is dealt out by text
        .repartitionByRange("doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie")
        .drop("tie")
        .mapInArrow(run, _SEGMENTS)
        .write.option("compression", "zstd").parquet(to)
    )


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """The segments of a folder with ``start``: the ids of all segments before each.

    Parts are totalled first, so what is put in order and broadcast is a row per part.
    """
    segments = spark.read.schema(_SEGMENTS).parquet(path)
    totals = segments.groupBy("part").agg(F.sum("size").alias("all"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col("part"), F.coalesce(F.sum("all").over(before), F.lit(0)).alias("offset"))
    return segments.join(F.broadcast(offsets), "part").withColumn("start", F.col("offset") + F.col("before"))


def document_ids(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, ids array<long>)`` of every document in a folder."""
    def rows(segment: Segment, start: int) -> Iterator[tuple]:
        for i, doc in enumerate(segment.doc_ids()):
            a, b = segment.bounds(i)
            yield doc, start + a, segment.ids[a:b].tolist()

    return _unpacked(spark, path, rows, "doc_id long, start long, ids array<long>",
                     [pa.int64(), pa.int64(), pa.list_(pa.int64())])


def document_digests(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document in a folder."""
    def rows(segment: Segment, start: int) -> Iterator[tuple]:
        for i, doc in enumerate(segment.doc_ids()):
            a, b = segment.bounds(i)
            yield doc, start + a, b - a, zlib.crc32(segment.ids[a:b].astype("<u4").tobytes())

    return _unpacked(spark, path, rows, "doc_id long, start long, n_tokens long, ids_crc32 long", [pa.int64()] * 4)


def _unpacked(spark, path, rows, schema: str, kinds: list[pa.DataType]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                found = list(zip(*rows(Segment(batch.column(0)[i].as_py()), batch.column(1)[i].as_py())))
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(found, kinds)], _names(schema))

    return read_segments(spark, path).select("data", "start").mapInArrow(run, schema)


def token_file(docs: DataFrame, path: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> str:
    """``write_tokens`` to a new folder under the shared one; its path."""
    to = scratch_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, to, end_id, id_col, text_col)
    return to
