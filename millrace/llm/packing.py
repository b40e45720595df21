"""Packing documents into windows of a fixed number of tokens by the sum-of-squares rule.

Each task packs its documents online, as they come. Whole windows are cut off a long document, and
what is left of it goes to the fill level at which the sum of squares of the numbers of partly
filled windows per level grows least (a new window counts as level zero). That keeps every
level's number small and levels that fit together both in stock. The numbers stand in an array by
level, so a placement is a few array operations over ``WINDOW`` numbers, however many windows are open.

Documents may be cut. When ``OPEN`` windows are open, and at the end of a task, the emptiest of them
are cut up to fill the fullest. So a task holds a bounded number of windows, and at its end
it has less than one window over, which is cut to powers of two, so nothing at all is padded.
Nothing is shuffled; a task that is run again packs its rows alike.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytebpe import encoder
from .text import id_and_text

#: Tokens of a window, and windows that a task keeps open.
WINDOW, OPEN = 2048, 4096
#: Texts are encoded so many at a time, and pieces are handed on at so many tokens.
TEXTS, HANDED = 200, 1 << 20

#: A piece: row of its document, ids of the document before it, its ids, ids of the whole document.
Piece = tuple[int | None, int, np.ndarray, int]


class Packer:
    """Windows partly filled, by level; ``close(window)`` is called with the pieces of each finished one."""

    def __init__(self, close: Callable[[list[Piece]], None], window: int = WINDOW, most_open: int = OPEN) -> None:
        self.close, self.window, self.most_open = close, window, most_open
        self.levels = np.zeros(window + 1, dtype=np.int64)
        self.windows: list[list[list[Piece]]] = [[] for _ in range(window)]
        self.open = 0

    def level(self, size: int) -> int:
        """The fill level for a piece of ``size``: least growth of the sum of squares, ties to the fullest."""
        levels, last = self.levels, self.window - size
        growth = 2 + 2 * (levels[size:] - levels[:last + 1])
        growth[0] = 2 * levels[size] + 1
        growth[last] -= 1  # a window that gets full is no longer counted
        growth[1:][levels[1:last + 1] == 0] = np.iinfo(np.int64).max
        return last - int(growth[::-1].argmin())

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        total, at = len(ids), 0
        while total - at >= self.window:
            self.close([(doc, at, ids[at:at + self.window], total)])
            at += self.window
        if at == total:
            return
        left = (doc, at, ids[at:], total)
        size = total - at
        level = self.level(size)
        if level:
            pieces = self.windows[level].pop()
            self.levels[level] -= 1
            pieces.append(left)
        else:
            pieces = [left]
            self.open += 1
        if level + size == self.window:
            self.open -= 1
            self.close(pieces)
            return
        self.windows[level + size].append(pieces)
        self.levels[level + size] += 1
        if self.open >= self.most_open:
            self.merge()

    def merge(self) -> None:
        """The emptiest windows are cut to fill the fullest, until at most one is open."""
        waiting = [pieces for at_level in reversed(self.windows) for pieces in at_level]
        self.windows = [[] for _ in range(self.window)]
        self.levels[:] = 0
        self.open = 0
        spare: list[Piece] = []
        while waiting:
            pieces = waiting.pop(0) if not spare else spare
            spare = []
            filled = sum(len(p[2]) for p in pieces)
            while filled < self.window and waiting:
                donor = waiting.pop()
                for doc, start, ids, total in donor:
                    room = self.window - filled
                    if room:
                        pieces.append((doc, start, ids[:room], total))
                        filled += len(ids[:room])
                    if len(ids) > room:
                        spare.append((doc, start + room, ids[room:], total))
            if filled == self.window:
                self.close(pieces)
            else:
                self.windows[filled].append(pieces)
                self.levels[filled] += 1
                self.open += 1
        if spare:
            filled = sum(len(p[2]) for p in spare)
            self.windows[filled].append(spare)
            self.levels[filled] += 1
            self.open += 1

    def finish(self) -> None:
        """Close all: whole windows, and the rest as windows of a power of two each."""
        self.merge()
        for filled in np.flatnonzero(self.levels):
            (pieces,) = self.windows[filled]
            for bit in reversed(range(int(filled).bit_length())):
                room, part = int(filled) & 1 << bit, []
                while room:
                    doc, start, ids, total = pieces.pop(0)
                    part.append((doc, start, ids[:room], total))
                    if len(ids) > room:
                        pieces.insert(0, (doc, start + room, ids[room:], total))
                    room -= len(part[-1][2])
                if part:
                    self.close(part)
        self.levels[:] = 0
        self.windows = [[] for _ in range(self.window)]
        self.open = 0


_PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long"


def _packed(
    docs: DataFrame, path: str, end_id: int, window: int, most_open: int, id_col: str, text_col: str,
    last: str, of: Callable[[np.ndarray], object], kind: pa.DataType,
) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        first = TaskContext.get().partitionId() << 40
        out: list[list] = [[] for _ in range(7)]
        number = tokens = 0

        def close(pieces: list[Piece]) -> None:
            nonlocal number, tokens
            at = 0
            for doc, start, ids, total in pieces:
                for column, value in zip(out, (doc, start, len(ids), total, first + number, at, of(ids))):
                    column.append(value)
                at += len(ids)
            number += 1
            tokens += at

        def handed() -> pa.RecordBatch:
            nonlocal out, tokens
            made = pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, [pa.int64()] * 6 + [kind])],
                [field.split()[0] for field in _PIECES.split(", ")] + [last.split()[0]])
            out, tokens = [[] for _ in range(7)], 0
            return made

        packer = Packer(close, window, most_open)
        end = np.array([end_id])
        for batch in batches:
            for begin in range(0, batch.num_rows, TEXTS):
                part = batch.slice(begin, TEXTS)
                texts = part.column(1).to_pylist()
                for doc, text in zip(part.column(0).to_pylist(), texts):
                    packer.add(doc, np.concatenate([coder.ids(text or ""), end]).astype("<u4"))
                    if tokens >= HANDED:
                        yield handed()
        packer.finish()
        if out[0]:
            yield handed()

    return id_and_text(docs, id_col, text_col).mapInArrow(run, f"{_PIECES}, {last}")


def pieces(
    docs: DataFrame, path: str, end_id: int = 1, window: int = WINDOW, most_open: int = OPEN,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``(doc_id, start, length, doc_tokens, sequence_id, offset, ids)``: every id of every document once.

    A document is its whole text (null: empty) encoded by the file at ``path``, and ``end_id``, so
    none is without a piece. ``start`` is where the piece begins in its document and ``offset`` in its
    sequence. A sequence is full or a power of two long. Rows with equal or null ids are documents
    of their own. An empty table gives an empty one; other columns are not read.
    """
    return _packed(docs, path, end_id, window, most_open, id_col, text_col, "ids array<long>", lambda ids: ids.tolist(), pa.list_(pa.int64()))


def piece_digests(
    docs: DataFrame, path: str, end_id: int = 1, window: int = WINDOW, most_open: int = OPEN,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """As ``pieces``, with ``ids_crc32`` (of the ids as little-endian unsigned 32-bit numbers) in place of the ids."""
    return _packed(docs, path, end_id, window, most_open, id_col, text_col, "ids_crc32 long", lambda ids: zlib.crc32(ids.tobytes()), pa.int64())


def sequences(found: DataFrame, window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """``(sequence_id, ids, n_tokens)`` of ``pieces``: padded to ``window`` unless a power of two long."""
    ids = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"]))
    whole = found.groupBy("sequence_id").agg(ids.alias("ids")).withColumn("n_tokens", F.size("ids").cast("long"))
    missing = F.when(F.bit_count("n_tokens") == 1, 0).otherwise(window - F.col("n_tokens")).cast("int")
    return whole.select("sequence_id", F.concat("ids", F.array_repeat(F.lit(pad_id).cast("long"), missing)).alias("ids"), "n_tokens")
