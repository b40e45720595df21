"""Benchmark decontamination: rare n-gram seeds and Smith-Waterman alignment.

Every test item is cut into word n-grams. How many documents hold each is counted over the
whole corpus, and of every ``WINDOW`` n-grams in a row the rarest is a seed, so that any
stretch of ``GRAM + WINDOW - 1`` words copied from an item holds one of its seeds. Where a
seed stands in a document, the passage around it is aligned with the item (local alignment
of words), which scores edited copies as well as exact ones: the score is that of the best
alignment over that of an exact copy.

The test items go to the tasks in blocks of bounded size, so a test set of any size is
handled, by a pass over the documents for each block. Documents are not shuffled.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_root
from .text import bytes_of, id_and_text, in_batches, slices, words

GRAM, WINDOW = 5, 4
MATCH, MISMATCH, GAP = 2, -1, -1
#: Share of an exact copy's score from which a document is contaminated, the copy being that of
#: the item or of so many words of it, if it is longer: a passage counts however long its item is.
THRESHOLD, PASSAGE = 0.5, 40
#: Bytes of item text that are sent to the tasks at once (an item is never cut).
BLOCK_BYTES = 4_000_000
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """The best local alignment of two word sequences: (score, first, stop) in the passage.

    Of equally good ones the first to end counts. A word numbered zero equals no other. Memory
    is that of two rows: every score carries along where its alignment begins.
    """
    size = len(passage) + 1
    places = np.arange(size)
    steps = places * -GAP
    row, first = np.zeros(size, dtype=np.int64), places  # scores of a row, and where the best alignments to them begin
    top, begin, stop = 0, 0, 0
    for word in item:
        score = np.where((passage == word) & (passage > 0), MATCH, MISMATCH)
        above, across = row + GAP, row[:-1] + score
        best = np.maximum(above, 0)
        best[1:] = np.maximum(best[1:], across)
        row = np.maximum.accumulate(best + steps) - steps  # gaps along the passage
        # each step comes from both words, else from the item's word, else from the passage's
        before = np.where(row == above, first, -1)
        before[1:] = np.where(row[1:] == across, first[:-1], before[1:])
        before[row == 0] = places[row == 0]
        first = before[np.maximum.accumulate(np.where(before >= 0, places, 0))]
        at = int(row.argmax())
        if row[at] > top or (row[at] == top and at < stop):
            top, begin, stop = int(row[at]), int(first[at]), at
    return top, begin, stop


class Items:
    """A block of test items: their words numbered from one, and where each n-gram stands."""

    def __init__(self, rows: list[tuple[int | None, bytes]]) -> None:
        self.ids = [i for i, _ in rows]
        self.numbers: dict[bytes, int] = {}
        self.words = [
            np.array([self.numbers.setdefault(w, len(self.numbers) + 1) for w in words(text)], dtype=np.int64)
            for _, text in rows
        ]
        #: n-grams by their size (an item of fewer words is one n-gram), hashed, in order
        self.keys: dict[int, np.ndarray] = {}
        #: (size, place in keys) -> where it stands: item and first word
        self.places: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)
        grams: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        for k, own in enumerate(self.words):
            size = min(GRAM, len(own))
            if size:
                grams[size] += [(int(h), k, at) for at, h in enumerate(_hashes(own, size))]
        for size, found in grams.items():
            self.keys[size] = np.unique(np.array([h for h, _, _ in found], dtype=np.uint64))
            for h, k, at in found:
                self.places[size, int(np.searchsorted(self.keys[size], np.uint64(h)))].append((k, at))
        #: seeds as a mask over each size's keys; all until ``choose`` is called
        self.seeds = {size: np.ones(len(keys), dtype=bool) for size, keys in self.keys.items()}

    def numbered(self, text: bytes) -> np.ndarray:
        found = words(text)
        return np.fromiter(map(self.numbers.get, found, _zeros(len(found))), dtype=np.int64, count=len(found))

    def hits(self, text: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Where n-grams of the items stand in a text, and which: places in the text and in keys."""
        if len(text) < size:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        ends = np.cumsum(text == 0)
        whole = ends[size - 1:] - np.concatenate([[0], ends[:len(text) - size]]) == 0
        at = np.flatnonzero(whole)  # no word in it is unknown to the items
        if not len(at):
            return at, at
        hashes = _hashes_at(text, size, at)
        keys = self.keys[size]
        place = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
        same = keys[place] == hashes
        return at[same], place[same]

    def choose(self, counts: dict[tuple[int, int], int]) -> None:
        """Seeds: in every window of an item's n-grams the one that fewest documents hold."""
        for size, keys in self.keys.items():
            self.seeds[size] = np.zeros(len(keys), dtype=bool)
        where = defaultdict(dict)
        for (size, place), stands in self.places.items():
            for k, at in stands:
                where[k][at] = (counts.get((size, place), 0), at, size, place)
        for grams in where.values():
            ordered = [grams[at] for at in range(len(grams))]
            for start in range(max(1, len(ordered) - WINDOW + 1)):
                _, _, size, place = min(ordered[start:start + WINDOW])
                self.seeds[size][place] = True

    def matches(self, text: bytes, memo: dict) -> Iterator[tuple[int | None, float, int, int]]:
        """(item, score, first word, word after the last) for items that the text holds."""
        document = self.numbered(text)
        near: dict[int, set[int]] = defaultdict(set)  # item -> where it would begin
        for size in self.keys:
            at, place = self.hits(document, size)
            seeded = self.seeds[size][place]
            for i, p in zip(at[seeded].tolist(), place[seeded].tolist()):
                for k, first in self.places[size, p]:
                    near[k].add(i - first)
        for k, starts in near.items():
            own = self.words[k]
            room = max(8, len(own) // 2)  # edits may shift and stretch the copy by so much
            best = (0, 0, 0)
            done = -math.inf
            for start in sorted(starts):
                if start >= 0 and np.array_equal(document[start:start + len(own)], own):
                    best = max(best, (MATCH * len(own), -start, start + len(own)))
                    continue
                left, right = max(0, start - room), start + len(own) + room
                if start <= done:  # the passage before took this in
                    continue
                done = start + room // 2
                passage = document[left:right + room // 2]
                key = (k, passage.tobytes())
                if key not in memo:
                    if len(memo) >= 10_000:
                        memo.clear()
                    memo[key] = align(own, passage)
                score, first, stop = memo[key]
                best = max(best, (score, -(left + first), left + stop))
            if best[0] >= THRESHOLD * MATCH * min(len(own), PASSAGE):
                yield self.ids[k], best[0] / (MATCH * len(own)), -best[1], best[2]


def _zeros(n: int) -> Iterator[int]:
    return iter([0] * n)


def _hashes(numbers: np.ndarray, size: int) -> np.ndarray:
    return _hashes_at(numbers, size, np.arange(len(numbers) - size + 1))


def _hashes_at(numbers: np.ndarray, size: int, at: np.ndarray) -> np.ndarray:
    out = np.zeros(len(at), dtype=np.uint64)
    for k in range(size):
        out = (out ^ numbers[at + k].astype(np.uint64)) * _FACTOR
        out ^= out >> np.uint64(29)
    return out


def _key(text_col: str) -> Column:
    """What a test item is known by: a hash of its text."""
    return F.xxhash64(F.col(text_col).cast("string"))


def blocks(benchmark: DataFrame, docs: DataFrame, item_text_col: str = "text") -> list[Items]:
    """The distinct texts of the test set in blocks of about ``BLOCK_BYTES``, known by their hashes, with
    seeds chosen by their rarity in ``docs(doc_id, text)``. Items without a word are left out:
    nothing can hold them."""
    items = benchmark.select(_key(item_text_col).alias("item"), F.encode(F.col(item_text_col).cast("string"), "UTF-8").alias("text"))
    items = items.where("text IS NOT NULL").distinct()
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    count = max(1, math.ceil(size / BLOCK_BYTES))
    out = []
    for part in range(count):
        own = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(count)) == part).sort("item", "text").collect()
        block = Items([(r.item, bytes(r.text)) for r in own])
        if block.keys:
            block.choose(_counts(docs, block))
            out.append(block)
    return out


def _counts(docs: DataFrame, block: Items) -> dict[tuple[int, int], int]:
    """How many documents hold each n-gram of a block: summed in the task, then over tasks."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = {size: np.zeros(len(keys), dtype=np.int64) for size, keys in block.keys.items()}
        for batch in slices(batches):
            for text in bytes_of(batch.column(0)):
                numbered = block.numbered(text)
                for size, total in totals.items():
                    place = block.hits(numbered, size)[1]
                    if len(place):
                        total[np.unique(place)] += 1
        for size, total in totals.items():
            held = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(held), size)), pa.array(held), pa.array(total[held])], ["size", "place", "n"])

    rows = docs.select("text").mapInArrow(counted, "size long, place long, n long")
    return {(r["size"], r.place): r.n for r in rows.groupBy("size", "place").agg(F.sum("n").alias("n")).collect()}


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """``(doc_id, item_id, score, first_word, stop_word)``: test items found in whole texts.

    A row for each document row and item whose best alignment scores at least ``THRESHOLD``
    of an exact copy of the item, or of ``PASSAGE`` words if it is longer (``score`` is the share of
    the whole item, so that it may be less); the two places are in words of the text. Null, empty and wordless texts hold nothing; an
    empty test set finds nothing; equal items are found each; rows with equal or null ids
    stay separate rows. Other columns are not read.
    """
    checkpoint_root(docs.sparkSession)
    texts = id_and_text(docs, id_col, text_col)
    found = None
    names = ["doc_id", "item", "score", "first_word", "stop_word"]
    schema = "doc_id long, item long, score double, first_word long, stop_word long"
    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
    for block in blocks(benchmark, texts, item_text_col):
        def start(block: Items = block):
            memo: dict = {}

            def step(batch: pa.RecordBatch) -> pa.RecordBatch:
                rows = [
                    (doc, *match)
                    for doc, text in zip(batch.column(0).to_pylist(), bytes_of(batch.column(1)))
                    for match in block.matches(text, memo)
                ]
                return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names)

            return step

        part = in_batches(texts, schema, start)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = docs.sparkSession.createDataFrame([], schema)
    named = benchmark.select(_key(item_text_col).alias("item"), F.col(item_col).cast("long").alias("item_id"))
    return found.join(named, "item").select("doc_id", "item_id", *names[2:])


def keep_clean(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs`` that hold no test item, all columns as they are."""
    place = docs.columns.index(text_col)
    for block in blocks(benchmark, id_and_text(docs, id_col, text_col), item_text_col):
        def start(block: Items = block):
            memo: dict = {}

            def step(batch: pa.RecordBatch) -> pa.RecordBatch:
                clean = [next(block.matches(t, memo), None) is None for t in bytes_of(batch.column(place))]
                return batch.filter(pa.array(clean, pa.bool_()))

            return step

        docs = in_batches(docs, docs.schema, start)
    return docs
