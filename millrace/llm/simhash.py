"""Near duplicates by SimHash, joined by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most r bits have a common variant within r / 2 bits of
both. So each distinct fingerprint emits all its variants within that half radius, the
variants are shuffled, and fingerprints that meet on one are verified. With r = 2 a
fingerprint emits 65 variants (itself and one bit flipped), and no more than 65 distinct
fingerprints can ever meet on one variant, however many copies the corpus has: copies are
folded into their fingerprint first.

``keep_one`` groups all texts that share at least ``SIMILAR`` of their distinct five-word shingles.
Fingerprints go first: sets of shingles with one fingerprint, or with two that are linked, are compared,
and those alike are one group from there on. A fingerprint misses near copies (blocks appended or cut
off), so texts that are still in two groups are joined by the prefix filter of set joins, which loses none:
if the shingles of every text stand in one common order, two such texts share one of the
first ``n - ceil(SIMILAR * n) + 1`` of either. Rare ones come first, by a sketch of counts, so
that few texts meet that are not alike. Of a pair the smaller text must share one of its first
``n - ceil(n * 2 SIMILAR / (1 + SIMILAR)) + 1`` even, so a shingle brings texts together only where one
of them holds it that early, and only texts of neighbouring size bands: pages of one template that
are not near copies differ in more shingles than that and never meet. Those who meet are linked
star by star first, and then every pair that is not yet in one component is compared.

Texts are cut into shingles three times: once for their identity and the sketch, once for their
prefixes, and those in a pair that has to be compared once more, so no table of all shingles is
written.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_root
from .components import components
from .text import bytes_of, id_and_text, in_batches, slices, written

BITS = 64
SEED = 42
#: Jaccard similarity of near copies, on distinct shingles of so many words.
SIMILAR, SHINGLE = 0.8, 5
#: Slots of the sketch that puts shingles in order; it decides how many texts meet, not which are found.
SLOTS, BLOCK_SLOTS = 1 << 20, 1 << 14
#: So much of the smaller of two near copies they share at least.
EARLY = 2 * SIMILAR / (1 + SIMILAR)
#: Texts of a bucket that are compared with each other in one group of a join.
PART = 256
#: Sets that are compared with one set by one task.
HELD = 4096
#: Stars are drawn anew while more pairs than so many times the rows of the buckets are left.
LEFT = 4
#: Bytes of sets that a task gives on at once: a set goes to each of its partners, however many they are.
SENT = 4 << 20
#: So many ids are broadcast to find texts (some 30 MB as a hash relation); more are joined by shuffle.
BROADCAST = 500_000


def fingerprint(text: bytes, size: int = 3) -> int:
    """The 64-bit SimHash of a text's word shingles, unsigned; 0 without words."""
    words = text.lower().split()  # on bytes: A-Z only, and ASCII white space only
    if not words:
        return 0
    if len(words) < size:
        shingles = [words]
    else:
        shingles = zip(*[words[i:] for i in range(size)])
    join, digest = b" ".join, xxhash.xxh64_intdigest
    hashes = np.array([digest(join(s), SEED) for s in shingles], dtype="<u8")
    counts = np.zeros(BITS, dtype=np.int64)
    for start in range(0, len(hashes), 1 << 16):  # a very long text is counted in parts
        part = hashes[start:start + (1 << 16)]
        counts += np.unpackbits(part.view(np.uint8), bitorder="little").reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def _mixed(x: np.ndarray) -> np.ndarray:
    """Each 64-bit number spread over all bits (the finaliser of the public splitmix generator)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprints(
    docs: DataFrame, size: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, fp)``: every whole text's fingerprint as a signed long."""

    def start():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = np.array([fingerprint(t, size) for t in bytes_of(batch.column(1))], dtype=np.uint64)
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"])

        return step

    return in_batches(id_and_text(docs, id_col, text_col), "doc_id long, fp long", start)


def near_links(prints: DataFrame) -> DataFrame:
    """``(a, b)``: verified links between distinct fingerprints that join all within 2 bits.

    All who meet on a variant are within 2 bits of each other, so neighbours in order of
    value are linked and the rest follows by them; every pair within the radius is
    connected by links given here, and each link given is within it.
    """
    fp = F.col("fp")
    flips = [fp, *[fp.bitwiseXOR(F.lit((1 << i) - (1 << BITS if i == BITS - 1 else 0))) for i in range(BITS)]]
    met = Window.partitionBy("variant").orderBy("fp")
    return (
        prints.select("fp", F.explode(F.array(*flips)).alias("variant"))
        .select("fp", F.lag("fp").over(met).alias("before"))
        .where(F.col("before").isNotNull() & (F.bit_count(F.col("fp").bitwiseXOR(F.col("before"))) <= 2))
        .select(F.col("before").alias("a"), F.col("fp").alias("b"))
        .distinct()
    )


def shingles(text: bytes) -> np.ndarray:
    """The distinct five-word shingles of a text, hashed, as signed longs (fewer words: all of them)."""
    words = text.lower().split()
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))
    size = min(SHINGLE, len(words))
    if not size:
        return hashes.view(np.int64)
    found = hashes[:len(words) - size + 1]
    for k in range(1, size):
        found = _mixed(found) + hashes[k:len(words) - size + 1 + k]
    return np.unique(found).view(np.int64)


def set_hash(own: np.ndarray) -> int:
    """One signed number for a set of shingles: texts that share all of them are one node."""
    return int(np.uint64(xxhash.xxh64_intdigest(own.tobytes(), SEED)).view(np.int64))


def shingled(texts: DataFrame) -> DataFrame:
    """``(doc_id, hash, node, block, counts, fp)``: a row per row of ``texts(doc_id, hash, text)`` with its
    set of shingles as ``node`` and its fingerprint, and rows of a task's counts of shingles by slot, block by block."""
    schema = "doc_id long, hash long, node long, block int, counts binary, fp long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros(SLOTS, dtype=np.int32), set()
        for batch in slices(batches):
            nodes, prints = [], []
            for text in bytes_of(batch.column(2)):
                own = shingles(text)
                nodes.append(set_hash(own))
                prints.append(fingerprint(text))
                if nodes[-1] not in seen:
                    if len(seen) >= 100_000:
                        seen.clear()
                    seen.add(nodes[-1])
                    np.add.at(total, own & (SLOTS - 1), 1)
            count = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(nodes, pa.int64()), pa.nulls(count, pa.int32()), pa.nulls(count, pa.binary()),
                 pa.array(np.array(prints, dtype=np.uint64).view(np.int64))], _names(schema))
        blocks = [(i, b) for i, b in enumerate(total.reshape(-1, BLOCK_SLOTS)) if b.any()]
        none = pa.nulls(len(blocks), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [none, none, none, pa.array([i for i, _ in blocks], pa.int32()), pa.array([b.tobytes() for _, b in blocks], pa.binary()), none], _names(schema))

    return texts.mapInArrow(run, schema)


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def sketch(marked: DataFrame) -> np.ndarray:
    """About how many texts hold the shingles of each slot: 0 for one at most, then by sixteenths of a
    power of two. The blocks of counts that tasks left in ``shingled`` are summed by tasks."""
    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = np.frombuffer(counts.as_buffer(), dtype=np.int32).astype(np.int64)
                totals[block] = totals[block] + own if block in totals else own
        levels = [np.minimum(255, np.round(16 * np.log2(np.maximum(t, 1)))).astype(np.uint8).tobytes() for t in totals.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(totals), pa.int32()), pa.array(levels, pa.binary())], ["block", "levels"])

    blocks = marked.where("block IS NOT NULL").select("block", "counts").repartition("block")
    levels = np.zeros((SLOTS // BLOCK_SLOTS, BLOCK_SLOTS), dtype=np.uint8)
    for row in blocks.mapInArrow(summed, "block int, levels binary").collect():  # a byte for each slot
        levels[row.block] = np.frombuffer(row.levels, dtype=np.uint8)
    return levels.ravel()


def prefixes(texts: DataFrame, levels: np.ndarray) -> DataFrame:
    """``(key, node, size, at, low)``: the shingles by which a text must meet any near copy, their
    places in its order, how many it has, and whether it may meet larger ones there. What only one
    text can hold is left out. Equal texts are mostly given once."""
    schema = "key long, node long, size int, at int, low boolean"

    def start():
        seen: set[int] = set()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            out: list[list[np.ndarray]] = [[], [], [], [], []]
            for text in bytes_of(batch.column(0)):
                own = shingles(text)
                node, size = set_hash(own), len(own)
                if node in seen:
                    continue
                if len(seen) >= 100_000:
                    seen.clear()
                seen.add(node)
                level = levels[own & (SLOTS - 1)]
                order = np.lexsort((own, level))[:size - math.ceil(SIMILAR * size - 1e-9) + 1]
                at = np.flatnonzero(level[order])
                low = at <= size - math.ceil(EARLY * size - 1e-9)
                for column, values in zip(out, (own[order[at]], np.full(len(at), node), np.full(len(at), size), at, low)):
                    column.append(values)
            kinds = (np.int64, np.int64, np.int32, np.int32, np.bool_)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(c).astype(k) if c else np.zeros(0, k)) for c, k in zip(out, kinds)], _names(schema))

        return step

    return in_batches(texts.select("text"), schema, start)


def _fit(a: str, b: str) -> Column:
    """Whether two texts that meet can be near copies by their sizes and by what follows the place
    where they meet. A pair of near copies passes where it meets first."""
    size, other, at, there = F.col(f"{a}.size"), F.col(f"{b}.size"), F.col(f"{a}.at"), F.col(f"{b}.at")
    shared = F.least(size - at, other - there)
    return (F.least(size, other) >= SIMILAR * F.greatest(size, other) - 1e-9) & (
        shared >= SIMILAR / (1 + SIMILAR) * (size + other) - 1e-9)


def meetings(rows: DataFrame) -> DataFrame:
    """``(key, band, node, size, at, low)``: the buckets of ``prefixes`` in which two texts can meet.

    A text is in the bucket of its own size band, and one that may meet larger ones also in the
    next band's, since no near copy is larger than that.
    """
    two = rows.groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("b"), F.max("low").alias("low"))
    met = rows.join(two.where("a < b AND low").select("key"), "key", "left_semi").distinct()
    band = F.floor(F.log("size") / math.log(1 / SIMILAR)).cast("int")
    bands = F.when(F.col("low"), F.array(band, band + 1)).otherwise(F.array(band))
    return met.select("key", F.explode(bands).alias("band"), "node", "size", "at", "low")


def _stars(buckets: DataFrame, turn: int) -> DataFrame:
    """``(a, b)``: in every bucket each text with a first one ``b``, drawn anew each turn."""
    drawn = F.struct(F.xxhash64("node", F.lit(turn)).alias("draw"), "node", "root", "size", "at")
    hubs = buckets.where("low").groupBy("key", "band").agg(F.min(drawn).alias("x"))
    own = F.struct("node", "root", "size", "at")
    return (
        buckets.select("key", "band", own.alias("y")).join(hubs, ["key", "band"])
        .where((F.col("x.root") != F.col("y.root")) & _fit("x", "y"))
        .select(F.col("y.node").alias("a"), F.col("x.node").alias("b")).distinct()
    )


def _pairs(buckets: DataFrame) -> DataFrame:
    """``(a, b)``: all pairs of a bucket that are in two components, one of them early enough. Buckets
    are dealt out in parts of about a bounded size and every two parts meet in a group of their own."""
    counts = buckets.groupBy("key", "band").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts"))
    own = F.struct("node", "root", "size", "at")
    dealt = buckets.join(counts, ["key", "band"]).withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    left = dealt.where("low").select("key", "band", own.alias("x"), F.col("part").alias("p"), every.alias("q"))
    right = dealt.select("key", "band", own.alias("y"), F.col("part").alias("q"), every.alias("p"))
    return (
        left.join(right, ["key", "band", "p", "q"])
        .where((F.col("x.size") <= F.col("y.size")) & (F.col("x.root") != F.col("y.root")) & _fit("x", "y"))
        .select(F.greatest("x.node", "y.node").alias("a"), F.least("x.node", "y.node").alias("b"))
        .distinct()
    )


def _alike(pairs: DataFrame, texts: DataFrame, firsts: DataFrame) -> DataFrame:
    """Those of ``pairs(a, b)`` that share enough of their shingles.

    Sets of shingles travel once: that of ``a`` to each of its ``b``, where one task holds the set of
    ``b`` and reads the others one by one. A ``b`` of many pairs is held by several tasks.
    """
    many = pairs.groupBy("b").agg(F.ceil(F.count("*") / HELD).cast("int").alias("parts"))
    sent = pairs.join(many, "b").select(F.col("a").alias("node"), "b", F.pmod(F.xxhash64("a"), F.col("parts")).cast("int").alias("part"))
    to = F.struct(F.col("b"), F.col("part"))
    own = many.select(F.col("b").alias("node"), "b", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    asked = sent.unionByName(own).groupBy("node").agg(F.collect_list(to).alias("to"))
    named = asked.join(firsts, "node").select(F.col("first").alias("doc_id"), "node", "to").checkpoint()
    total = named.agg((F.count("*") + F.coalesce(F.sum(F.size("to")), F.lit(0))).alias("n")).first().n
    wanted = texts.select("doc_id", "text").join(F.broadcast(named) if total <= BROADCAST else named, "doc_id")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                node, own = batch.column(0)[i].as_py(), shingles(bytes_of(batch.column(2).slice(i, 1))[0])
                if set_hash(own) == node:  # a repeated id may have other texts than the one that is meant
                    every, each = batch.column(1)[i].as_py(), max(1, SENT // max(1, own.nbytes))
                    for start in range(0, len(every), each):
                        to = every[start:start + each]
                        yield pa.RecordBatch.from_arrays([
                            pa.array([t["b"] for t in to], pa.int64()), pa.array([t["part"] for t in to], pa.int32()),
                            pa.array([t["b"] != node for t in to]), pa.array([node] * len(to), pa.int64()),
                            pa.array([own.tobytes()] * len(to), pa.binary())], _names(schema))

    schema = "b long, part int, other boolean, node long, set binary"

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, there = None, np.zeros(0, dtype=np.int64)
        for batch in batches:
            a, b = [], []
            for hub, part, other, node, own in zip(*(batch.column(i) for i in range(5))):
                hub, own = (hub.as_py(), part.as_py()), np.frombuffer(own.as_buffer(), dtype=np.int64)
                if not other.as_py():
                    held, there = hub, own
                elif hub == held:
                    shared = len(np.intersect1d(own, there, assume_unique=True))
                    if shared >= SIMILAR * (len(own) + len(there) - shared) - 1e-9:
                        a.append(node.as_py())
                        b.append(hub[0])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    sets = wanted.select("node", "to", "text").mapInArrow(cut, schema).repartition("b", "part")
    return sets.sortWithinPartitions("b", "part", "other").mapInArrow(compared, "a long, b long").distinct()


def print_pairs(prints: DataFrame) -> DataFrame:
    """``(a, b)``: pairs of sets of ``prints(node, fp)`` to be compared, since their fingerprints are equal or linked.

    The smallest set of a fingerprint stands for it: the others are paired with it, and it with those of linked ones.
    """
    heads = prints.groupBy("fp").agg(F.min("node").alias("head")).checkpoint()
    same = prints.join(heads, "fp").where("node <> head").select("node", "head")
    links = near_links(heads.select("fp"))
    linked = links.join(heads.toDF("a", "node"), "a").join(heads.toDF("b", "head"), "b").select("node", "head")
    every = same.unionByName(linked)
    return every.select(F.greatest("node", "head").alias("a"), F.least("node", "head").alias("b")).distinct()


def near_copies(texts: DataFrame, firsts: DataFrame, levels: np.ndarray) -> DataFrame:
    """``(node, root)`` for every text with a near copy: equal roots, joined by pairs of near copies.

    Every pair of ``texts(doc_id, text)`` that shares ``SIMILAR`` of its shingles is in one
    component, and every component is held together by such pairs. ``firsts(node, first, fp)``
    names a document and its fingerprint for each set of shingles.
    """
    links = _alike(print_pairs(firsts.select("node", "fp")).checkpoint(), texts, firsts).checkpoint()
    roots = components(links)
    rows = written(prefixes(texts, levels), "prefixes")
    buckets = written(meetings(rows), "meetings")
    turn, size = 0, buckets.count()
    apart = _apart(buckets, roots)
    left = _left(apart)
    while left > LEFT * size:  # only saves pairs: whatever the stars leave is compared below
        links = links.unionByName(_alike(_stars(apart, turn).checkpoint(), texts, firsts)).checkpoint()
        roots = components(links)
        apart = _apart(buckets, roots)
        before, left = left, _left(apart)
        turn += 1
        if left > before / 2:
            break
    if left:
        links = links.unionByName(_alike(_pairs(apart).checkpoint(), texts, firsts))
        roots = components(links)
    return roots


def _apart(buckets: DataFrame, roots: DataFrame) -> DataFrame:
    """``buckets`` with the component of each text, those that are not yet in one component."""
    named = buckets.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")).checkpoint()
    ends = named.groupBy("key", "band").agg(F.min("root").alias("low_root"), F.max("root").alias("high_root"), F.max("low").alias("any_low"))
    open_ones = ends.where("low_root < high_root AND any_low").select("key", "band")
    return named.join(open_ones, ["key", "band"], "left_semi").checkpoint()


def _left(buckets: DataFrame) -> int:
    """How many pairs of two components are in the buckets, each counted where it meets."""
    early = F.sum(F.col("low").cast("long"))
    of_root = buckets.groupBy("key", "band", "root").agg(F.count("*").alias("n"), early.alias("low"))
    of_key = of_root.groupBy("key", "band").agg(
        F.sum("n").alias("n"), F.sum("low").alias("low"), F.sum(F.col("n") * F.col("low")).alias("same"))
    return of_key.agg(F.sum(F.col("n") * F.col("low") - F.col("same"))).first()[0] or 0


def simhash_groups(
    docs: DataFrame, size: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, fingerprint, component_id)``, a row per row of ``docs``.

    ``component_id`` is the smallest ``doc_id`` reachable over links of at most 2 bits. A
    null or wordless text has the fingerprint zero and is linked like any other. Rows with
    equal ids stay separate rows; a null id never is the smallest (a component of null ids
    only has a null ``component_id``). An empty table gives an empty one; columns beside
    the two named ones are not read.
    """
    checkpoint_root(docs.sparkSession)
    prints = fingerprints(docs, size, id_col, text_col).checkpoint()
    firsts = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = components(near_links(firsts.select("fp")))
    linked = firsts.join(roots.select(F.col("node").alias("fp"), "root"), "fp").checkpoint()
    smallest = linked.groupBy("root").agg(F.min("first").alias("smallest"))
    reached = linked.join(smallest, "root").select("fp", "smallest")
    names = firsts.join(reached, "fp", "left").select("fp", F.coalesce("smallest", "first").alias("component_id"))
    names = names.checkpoint()  # so that the last join may split the fingerprint of many copies
    return prints.join(names, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of near copies: that of the smallest id.

    Texts are linked by their fingerprints and, where those differ too much, by early shingles; every
    link is verified. Groups are held together by pairs of texts that share ``SIMILAR`` of their distinct
    five-word shingles, and no such pair is in two groups; wordless texts are one group. All
    columns are kept as they are. Of rows with the smallest id of a group one stays; rows that
    share an id but not their text are told apart. Rows with a null id have nothing to be
    named by: they are in no group and all stay.
    """
    checkpoint_root(docs.sparkSession)
    text_hash = lambda column: F.xxhash64(column.cast("string"))
    named = docs.where(F.col(id_col).isNotNull())
    texts = id_and_text(named, id_col, text_col).select("doc_id", text_hash(F.col("text")).alias("hash"), "text")
    marked = written(shingled(texts), "shingled")
    nodes = marked.where("block IS NULL").select("doc_id", "hash", "node", "fp")
    firsts = nodes.groupBy("node").agg(F.min(F.struct("doc_id", "hash", "fp")).alias("row")).checkpoint()
    roots = near_copies(texts, firsts.select("node", F.col("row.doc_id").alias("first"), F.col("row.fp").alias("fp")), sketch(marked))
    best = firsts.join(roots, "node", "left").groupBy(F.coalesce("root", "node")).agg(F.min("row").alias("row"))
    rows = nodes.groupBy("doc_id", "hash").agg(F.count("*").alias("rows"))
    kept = best.select("row.doc_id", "row.hash", F.lit(True).alias("kept"))
    fate = rows.join(kept, ["doc_id", "hash"], "left").where("kept IS NULL OR rows > 1").checkpoint()
    counts = fate.agg(F.count("*").alias("n"), F.count("kept").alias("repeated")).first()
    marks = fate.select(F.col("doc_id").alias("_doc"), F.col("hash").alias("_hash"), F.col("kept").alias("_kept"))
    if counts.n <= BROADCAST:
        marks = F.broadcast(marks)
    same = lambda some: (docs[id_col].cast("long") == some["_doc"]) & (text_hash(docs[text_col]) == some["_hash"])
    single = docs.join(marks, same(marks), "left_anti")  # rows without an id match nothing and stay
    if not counts.repeated:
        return single
    repeated = marks.where("_kept")
    return single.unionByName(docs.join(repeated, same(repeated), "left_semi").dropDuplicates([id_col, text_col]))
