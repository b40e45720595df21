"""Conversations as a trie of shared beginnings, its subtree totals by time-forward processing.

A node is a distinct beginning of conversations. Its key is the exclusive or of a hash of every
turn with its place, so the key of every beginning is a running total, however long a
conversation is. A node is named by the smallest conversation that begins with it and its
depth; the conversation of that name holds all its ancestors.

Totals go up by time-forward processing. The nodes of a shard are sorted by reverse level
order (Spark's external sort), and each sends its total to its parent through a priority queue
that is ordered the same way and spills to disk, where the parent, later in that order, takes
what was sent to it. Shards are connected pieces of bounded size:

* nodes are classed by the logarithm of their conversations to the base ``FANOUT``. Classes only
  fall on the way down, so a piece of one class below one top has fewer than ``FANOUT`` nodes on
  a level, and what it gets from below comes from lower classes, summed per parent by Spark;
* pieces are cut every ``SPAN`` levels. A piece is first totalled by itself, the roots of the
  pieces are a smaller tree that is totalled in the same way (cut every ``SPAN`` squared
  levels, and so on), and then each piece is totalled with what its neighbours below sent.

So a shard has at most ``FANOUT * SPAN`` nodes whatever the tree is like: a turn that a third of
all conversations begin with, or a conversation of a third of all turns, is no single task.
"""

from __future__ import annotations

import hashlib
import heapq
import struct
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_root

#: A shard has fewer nodes of a level than the first and fewer levels than the second.
FANOUT, SPAN = 64, 4096
#: Messages that a queue holds in memory; beyond it they go to a file of the task.
HELD = 200_000
#: Characters of a piece of a list of conversations.
PIECE = 1 << 20
#: Conversations of a block share the first turns of its first one.
BLOCK = 20
WORD = r"[^\x20\x09-\x0D]+"

_MESSAGE = struct.Struct("<4q")


class SpillingQueue:
    """A priority queue of four-number messages, of bounded memory.

    When it holds ``held`` messages they are written in order to a file that only this task
    sees and that goes with it; the heads of the files compete with what is in memory.
    """

    def __init__(self, held: int = HELD) -> None:
        self.held, self.heap, self.runs, self.files = held, [], [], 0

    def push(self, message: tuple[int, int, int, int]) -> None:
        if len(self.heap) >= self.held:
            self._spill()
        heapq.heappush(self.heap, message)

    def _spill(self) -> None:
        file = tempfile.TemporaryFile()
        self.heap.sort()
        for start in range(0, len(self.heap), 4096):
            file.write(b"".join(_MESSAGE.pack(*m) for m in self.heap[start:start + 4096]))
        file.seek(0)
        self.heap = []
        run = self._read(file)
        self.files += 1
        heapq.heappush(self.runs, (next(run), self.files, run))

    @staticmethod
    def _read(file) -> Iterator[tuple[int, int, int, int]]:
        with file:
            while data := file.read(_MESSAGE.size * 4096):
                yield from _MESSAGE.iter_unpack(data)

    def head(self) -> tuple[int, int, int, int] | None:
        own = self.heap[0] if self.heap else None
        spilled = self.runs[0][0] if self.runs else None
        if own is None or spilled is None:
            return own or spilled
        return min(own, spilled)

    def pop(self) -> tuple[int, int, int, int]:
        if self.runs and (not self.heap or self.runs[0][0] < self.heap[0]):
            message, number, run = self.runs[0]
            following = next(run, None)
            if following is None:
                heapq.heappop(self.runs)
            else:
                heapq.heapreplace(self.runs, (following, number, run))
            return message
        return heapq.heappop(self.heap)


def running(df: DataFrame, group: str, order: list[str], values: dict[str, tuple[Callable[[str], Column], Column]]) -> DataFrame:
    """``df`` with running totals within each group: ``values`` maps a name to an aggregate and its input.

    Rows are dealt out by range of group and order, so a group of any size is many tasks; only
    the groups that a border cuts, at most two for each partition, carry totals over. ``order``
    must tell the rows of a group apart. The aggregates must combine with themselves.
    """
    checkpoint_root(df.sparkSession)
    rows = (
        df.select("*", *[column.alias(f"_in_{name}") for name, (_, column) in values.items()])
        .repartitionByRange(group, *order).withColumn("_part", F.spark_partition_id()).checkpoint()
    )
    totals = rows.groupBy(group, "_part").agg(*[f(f"_in_{name}").alias(f"_all_{name}") for name, (f, _) in values.items()])
    cut = totals.groupBy(group).agg(F.count("*").alias("_parts")).where("_parts > 1").select(group)
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.join(cut, group, "left_semi").select(
        group, "_part", *[f(f"_all_{name}").over(before).alias(f"_from_{name}") for name, (f, _) in values.items()])
    inside = Window.partitionBy("_part", group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    own = rows.select(*df.columns, "_part", *[f(f"_in_{name}").over(inside).alias(f"_own_{name}") for name, (f, _) in values.items()])
    joined = own.join(F.broadcast(carried), [group, "_part"], "left")  # two rows a partition at most

    def both(name: str, f: Callable[[str], Column]) -> Column:
        there, here = F.coalesce(F.col(f"_from_{name}"), F.lit(0)), F.col(f"_own_{name}")
        return there.bitwiseXOR(here) if f is F.bit_xor else there + here

    return joined.select(*df.columns, *[both(name, f).alias(name) for name, (f, _) in values.items()])


def rebuilt(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rebuilt turns ``(conv, depth, content, words)`` and conversations ``(conv, size)``.

    Of ``messages(conv, turn, role, text)`` without nulls but for ``turn``. Each conversation
    begins with the first h turns of its block's first one instead of its own first h.
    """
    text = F.col("text")
    content = F.md5(F.concat_ws(":", F.length("role"), "role", text))
    rows = messages.select(
        "conv", "turn", "role", content.alias("content"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
        F.monotonically_increasing_id().alias("row"))
    placed = running(rows, "conv", ["turn", "role", "content", "row"], {"at": (F.sum, F.lit(1).cast("long"))}).select(
        "conv", "at", "content", "words").checkpoint()
    own = placed.groupBy("conv").agg(F.max("at").alias("own"))
    heads = (F.crc32(F.col("conv").cast("string").cast("binary")) % 4).alias("h")
    members = own.select("conv", "own", heads, (F.col("conv") - F.col("conv") % BLOCK).alias("base"))
    there = own.select(F.col("conv").alias("base"), F.col("own").alias("of_base"))
    convs = members.join(there, "base", "left").select(
        "conv", "base", "h", F.least("h", F.coalesce("of_base", F.lit(0))).alias("lent"), F.greatest(F.lit(0), F.col("own") - F.col("h")).alias("rest"))
    convs = convs.checkpoint()
    lent = placed.where("at <= 3").withColumnRenamed("conv", "base").join(convs.select("conv", "base", "h"), "base").where("at <= h")
    rest = placed.join(convs.select("conv", "h", "lent"), "conv").where("at > h")
    turns = lent.select("conv", F.col("at").alias("depth"), "content", "words").unionByName(
        rest.select("conv", (F.col("at") - F.col("h") + F.col("lent")).alias("depth"), "content", "words"))
    return turns, convs.select("conv", (F.col("lent") + F.col("rest")).alias("size"))


def _class(count: str, fanout: int) -> Column:
    powers = [fanout**i for i in range(1, 64) if fanout**i < 1 << 62]
    return sum((F.when(F.col(count) > F.lit(p), 1).otherwise(0) for p in powers), F.lit(0))


def _forward(vertices: DataFrame, held: int) -> DataFrame:
    """Totals within each shard of ``vertices(c, d, pc, pd, rc, rd, a, b)``; ``(rc, rd)`` is its root."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, queue = None, SpillingQueue(held)
        for batch in batches:
            columns = [column.to_pylist() for column in batch.columns]
            sums: tuple[list[int], list[int]] = ([], [])
            for c, d, pc, pd, rc, rd, a, b in zip(*columns):
                if (rc, rd) != shard:
                    shard, queue = (rc, rd), SpillingQueue(held)
                while (first := queue.head()) and first[:2] == (-d, c):
                    _, _, more, gain = queue.pop()
                    a, b = a + more, b + gain
                if (c, d) != shard:
                    queue.push((-pd, pc, a, b))
                sums[0].append(a)
                sums[1].append(b)
            yield pa.RecordBatch.from_arrays([*batch.columns[:6], *(pa.array(s, pa.int64()) for s in sums)], batch.schema.names)

    schema = ", ".join(f"{name} long" for name in ("c", "d", "pc", "pd", "rc", "rd", "a", "b"))
    dealt = vertices.select("c", "d", "pc", "pd", "rc", "rd", "a", "b").repartition("rc", "rd")
    return dealt.sortWithinPartitions("rc", "rd", F.desc("d"), "c").mapInArrow(run, schema)


def _swept(vertices: DataFrame, held_by: DataFrame, deepest: int, span: int, reach: int, held: int) -> DataFrame:
    """``(c, d, pc, pd, a, b)``: the totals of pieces ``vertices(c, d, pc, pd, tc, td, a, b)`` below their tops."""
    if deepest < reach:
        return _forward(vertices.withColumns({"rc": F.col("tc"), "rd": F.col("td")}), held).select("c", "d", "pc", "pd", "a", "b")
    cut = F.greatest(F.col("td"), F.floor(F.col("d") / reach) * reach)
    # the top of a piece may be the root, that ``held_by`` does not name
    keyed = vertices.withColumn("rd", cut).join(held_by.toDF("c", "rd", "rc"), ["c", "rd"], "left").withColumn(
        "rc", F.when(F.col("rd") == F.col("td"), F.col("tc")).otherwise(F.col("rc"))).checkpoint()
    roots = _forward(keyed, held).where("c = rc AND d = rd").join(keyed.select("c", "d", "tc", "td"), ["c", "d"])
    above = keyed.select(F.col("c").alias("pc"), F.col("d").alias("pd"), F.col("rc").alias("qc"), F.col("rd").alias("qd"))
    named = roots.select("c", "d", "pc", "pd", "tc", "td", "a", "b").join(above, ["pc", "pd"], "left").checkpoint()
    smaller = named.select("c", "d", F.col("qc").alias("pc"), F.col("qd").alias("pd"), "tc", "td", "a", "b")
    whole = _swept(smaller, held_by, deepest, span, reach * span, held).select("c", "d", "a", "b")
    sent = named.select("c", "d", "pc", "pd").join(whole, ["c", "d"]).groupBy(F.col("pc").alias("c"), F.col("pd").alias("d")).agg(
        F.sum("a").alias("more"), F.sum("b").alias("gain"))
    return _forward(_with_sent(keyed, sent), held).select("c", "d", "pc", "pd", "a", "b")


def _with_sent(vertices: DataFrame, sent: DataFrame) -> DataFrame:
    zero = F.lit(0).cast("long")
    return vertices.join(sent, ["c", "d"], "left").withColumns(
        {"a": F.col("a") + F.coalesce("more", zero), "b": F.col("b") + F.coalesce("gain", zero)}).drop("more", "gain")


def subtree_totals(nodes: DataFrame, held_by: DataFrame, fanout: int = FANOUT, span: int = SPAN, held: int = HELD) -> DataFrame:
    """``(c, d, a, b)``: ``a`` and ``b`` of ``nodes(c, d, pc, n, a, b)`` summed over each node's subtree.

    ``pc`` names the parent, a level above, and is null for one node, the root; ``n`` never
    rises on the way down. ``held_by(c, d, rep, n)`` names the ancestor of every node at every
    depth below the root, with its ``n``.
    """
    top = nodes.where("pc IS NULL").select("c", "n", _class("n", fanout).alias("k")).first()
    deepest = nodes.agg(F.max("d")).first()[0]
    classed = nodes.withColumns({"k": _class("n", fanout), "pd": F.col("d") - 1}).checkpoint()
    # the highest depth at which a node's own conversation is of its class
    highest = held_by.groupBy("c", _class("n", fanout).alias("k")).agg(F.min("d").alias("td"))
    held_by = held_by.select("c", "d", "rep")
    tops = highest.join(held_by.toDF("c", "td", "tc"), ["c", "td"]).select("c", "k", "td", "tc")
    pieces = classed.join(tops, ["c", "k"], "left").withColumns({
        "td": F.when(F.col("k") == top.k, 0).otherwise(F.col("td")).cast("long"),
        "tc": F.when(F.col("k") == top.k, top.c).otherwise(F.col("tc")).cast("long")}).checkpoint()
    found, sent = [], None
    for k in range(top.k + 1):
        own = pieces.where(F.col("k") == k).select("c", "d", "pc", "pd", "tc", "td", "a", "b")
        if sent is not None:
            own = _with_sent(own, sent.groupBy("c", "d").agg(F.sum("more").alias("more"), F.sum("gain").alias("gain")))
        totals = _swept(own, held_by, deepest, span, span, held).join(own.select("c", "d", "tc", "td"), ["c", "d"]).checkpoint()
        found.append(totals.select("c", "d", "a", "b"))
        up = totals.where("c = tc AND d = td").select(F.col("pc").alias("c"), F.col("pd").alias("d"), F.col("a").alias("more"), F.col("b").alias("gain"))
        sent = up if sent is None else sent.unionByName(up)
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionByName(more)
    return whole


def member_digests(ends: DataFrame) -> DataFrame:
    """``(c, d, sha)``: SHA-256 of the ascending decimal conversations of each node, comma-joined.

    The list of a node is joined to pieces of bounded size by many tasks; one task runs the
    digest, which is sequential by nature, over the pieces of a node one by one.
    """
    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, first, parts, size = None, 0, [], 0
        out: list[tuple[int, int, int, str]] = []
        for batch in batches:
            for c, d, conv in zip(*(column.to_pylist() for column in batch.columns)):
                if (c, d) != node or size >= PIECE:
                    if parts:
                        out.append((*node, first, ",".join(parts)))
                    node, first, parts, size = (c, d), conv, [], 0
                parts.append(str(conv))
                size += len(parts[-1]) + 1
            if out:
                yield _rows(out, ["c", "d", "first"], "piece")
                out = []
        if parts:
            yield _rows([(*node, first, ",".join(parts))], ["c", "d", "first"], "piece")

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            out: list[tuple[int, int, str]] = []
            for i in range(batch.num_rows):
                c, d, piece = (batch.column(k)[i].as_py() for k in (0, 1, 3))
                if (c, d) == node:
                    state.update(b",")
                else:
                    if node is not None:
                        out.append((*node, state.hexdigest()))
                    node, state = (c, d), hashlib.sha256()
                state.update(piece.encode())
            if out:
                yield _rows(out, ["c", "d"], "sha")
        if node is not None:
            yield _rows([(*node, state.hexdigest())], ["c", "d"], "sha")

    pieces = ends.select("c", "d", "conv").repartitionByRange("c", "d", "conv").sortWithinPartitions("c", "d", "conv").mapInArrow(
        joined, "c long, d long, first long, piece string")
    return pieces.repartition("c", "d").sortWithinPartitions("c", "d", "first").mapInArrow(digested, "c long, d long, sha string")


def _rows(rows: list[tuple], numbers: list[str], text: str) -> pa.RecordBatch:
    columns = list(zip(*rows))
    return pa.RecordBatch.from_arrays(
        [*(pa.array(c, pa.int64()) for c in columns[:-1]), pa.array(columns[-1], pa.string())], [*numbers, text])


def conversation_tree(
    messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    fanout: int = FANOUT, span: int = SPAN, held: int = HELD,
) -> DataFrame:
    """A row per distinct beginning of rebuilt conversations, the root (depth 0) included.

    ``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)``,
    where a node is named by its smallest conversation. Turns go by ``turn``, null first;
    those that share it go by role and then by the MD5 of role and text, repeated ones one after
    the other. Null roles and texts are empty. Rows without a conversation belong to none and are
    left out; other columns are not read. No conversation: an empty result.
    """
    spark = messages.sparkSession
    checkpoint_root(spark)
    empty = F.lit("")
    known = messages.select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), empty).alias("role"), F.coalesce(F.col(text_col).cast("string"), empty).alias("text"),
    ).where("conv IS NOT NULL")
    turns, convs = rebuilt(known)
    convs = convs.checkpoint()
    all_of = convs.agg(F.min("conv").alias("c"), F.count("*").alias("n")).first()
    # the key of a beginning: every turn hashed with its place, combined
    tagged = turns.select("conv", "depth", "words", F.xxhash64("depth", "content").alias("x"), F.xxhash64("content", "depth", F.lit("second")).alias("y"))
    keyed = running(tagged.select("conv", "depth", "words", "x", "y"), "conv", ["depth"],
                    {"k1": (F.bit_xor, F.col("x")), "k2": (F.bit_xor, F.col("y"))}).select("conv", "depth", "words", "k1", "k2").checkpoint()
    groups = keyed.groupBy("depth", "k1", "k2").agg(
        F.min("conv").alias("rep"), F.count("*").alias("n"), F.min("words").alias("words")).checkpoint()
    held_by = keyed.select("conv", "depth", "k1", "k2").join(groups.drop("words"), ["depth", "k1", "k2"]).select(
        F.col("conv").alias("c"), F.col("depth").alias("d"), "rep", "n").checkpoint()
    inner = groups.select(F.col("rep").alias("c"), F.col("depth").alias("d"), "n", ((F.col("n") - 1) * F.col("words")).alias("b"))
    parents = held_by.select("c", (F.col("d") + 1).alias("d"), F.col("rep").alias("pc"))
    linked = inner.join(parents, ["c", "d"], "left").withColumn("pc", F.when(F.col("d") == 1, F.lit(all_of.c).cast("long")).otherwise(F.col("pc")))
    root = convs.groupBy().agg(F.min("conv").alias("c"), F.count("*").alias("n")).where("n > 0").select(
        "c", F.lit(0).cast("long").alias("d"), "n", F.lit(0).cast("long").alias("b"), F.lit(None).cast("long").alias("pc"))
    tree = linked.select("c", "d", "n", "b", "pc").unionByName(root).checkpoint()
    children = tree.where("pc IS NOT NULL").groupBy(F.col("pc").alias("c"), (F.col("d") - 1).alias("d")).agg(F.count("*").alias("children"))
    nodes = tree.join(children, ["c", "d"], "left").withColumn("children", F.coalesce("children", F.lit(0).cast("long"))).checkpoint()
    ends = held_by.join(convs.select(F.col("conv").alias("c"), F.col("size").alias("d")), ["c", "d"]).select(
        F.col("rep").alias("node"), "d", F.col("c").alias("conv")).toDF("c", "d", "conv")
    bare = convs.where("size = 0").select(F.lit(all_of.c).cast("long").alias("c"), F.lit(0).cast("long").alias("d"), "conv")
    digests = member_digests(ends.unionByName(bare))
    if all_of.n:
        leaf = F.when(F.col("children") == 0, 1).otherwise(0).cast("long")
        totals = subtree_totals(nodes.select("c", "d", "pc", "n", leaf.alias("a"), "b"), held_by, fanout, span, held)
    else:
        totals = nodes.select("c", "d", F.col("n").alias("a"), "b")
    nothing = hashlib.sha256(b"").hexdigest()
    return nodes.drop("b").join(totals, ["c", "d"]).join(digests, ["c", "d"], "left").select(
        F.col("c").alias("conv_id"), F.col("d").alias("depth"), F.col("pc").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"), F.col("a").alias("n_leaves"), F.col("b").alias("saved_tokens"),
        F.coalesce("sha", F.lit(nothing)).alias("ends_sha256"))
