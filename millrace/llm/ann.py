"""Nearest neighbours by a hierarchical k-means tree with best-bin-first traversal.

The upper tree is fitted on a bounded sample of the vectors (``SAMPLE``); where there are more
vectors, tasks split each of its leaves by a tree of their own, so that leaves grow in number
with the vectors until there are ``LEAVES``. Every vector is put into a leaf. A query walks the tree by
a priority queue of branches, nearest centre first, which puts the leaves in an order; it visits
the first so many of them. How many is calibrated: for a bounded set of vectors (``CALIBRATION``)
the true neighbours are found by comparing with all vectors, and visits are widened until the
wanted share of them lies in visited leaves.

Leaves are dealt out in bundles of bounded size (a large leaf is cut into blocks), and a query goes
once to each bundle that has a leaf it visits. There products of unit vectors only shut out what is
further from the k-th best than all rounding can be; who remains is ranked by the exact score and
the smaller id. Equal vectors are folded into one before, with their smallest ids.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_root

#: Bounds: vectors the tree is fitted on, vectors of a leaf aimed at, branches of a node.
SAMPLE, LEAF, BRANCHES = 20_000, 64, 8
#: Vectors whose true neighbours calibrate the visits, and the share of them to reach.
CALIBRATION, RECALL = 300, 0.98
#: Leaves at most, and vectors of a leaf that its own tree is fitted on.
LEAVES, WITHIN = 65_536, 20_000
#: Vectors of a block of a leaf, of a bundle of blocks, and queries compared with a bundle at once.
BLOCK, BUNDLE, QUERIES = 4096, 16_384, 1024
SEED = 7
_DRAWS = 1 << 30


@dataclass
class Tree:
    """Nodes with the rows of their children's centres; a child below zero is a leaf."""

    centres: list[np.ndarray]
    children: list[np.ndarray]
    leaves: int

    def leaf(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each row, by the nearest centre at every level."""
        at = np.zeros(len(vectors), dtype=np.int64)
        going = np.arange(len(vectors))
        while len(going):
            for node in np.unique(at[going]):
                rows = going[at[going] == node]
                at[rows] = self.children[node][_nearest(vectors[rows], self.centres[node])]
            going = going[at[going] >= 0]
        return -at - 1

    def order(self, query: np.ndarray, visits: int) -> list[int]:
        """The first leaves in the order of best-bin-first traversal."""
        waiting, found = [(0.0, 0)], []
        while waiting and len(found) < visits:
            far, node = heapq.heappop(waiting)
            while node >= 0:
                distances = ((self.centres[node] - query) ** 2).sum(axis=1)
                best = int(distances.argmin())
                for k, distance in enumerate(distances.tolist()):
                    if k != best:
                        heapq.heappush(waiting, (distance, int(self.children[node][k])))
                node = int(self.children[node][best])
            found.append(-node - 1)
        return found


def _nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(axis=1) - 2 * rows @ centres.T).argmin(axis=1)


def grow(vectors: np.ndarray, leaf: int = LEAF, branches: int = BRANCHES) -> Tree:
    """A tree over unit vectors: k-means at every node that holds more than a leaf should."""
    draw = np.random.default_rng(SEED)
    tree = Tree([], [], 0)

    def split(rows: np.ndarray) -> int:
        centres = rows[draw.permutation(len(rows))[:branches]]
        for _ in range(8):
            own = _nearest(rows, centres)
            sums = np.zeros_like(centres)
            np.add.at(sums, own, rows)
            counts = np.bincount(own, minlength=len(centres))
            centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
        own = _nearest(rows, centres)
        node = len(tree.centres)
        tree.centres.append(centres)
        tree.children.append(np.zeros(len(centres), dtype=np.int64))
        for k in range(len(centres)):
            part = rows[own == k]
            if leaf < len(part) < len(rows):
                tree.children[node][k] = split(part)
            else:
                tree.leaves += 1
                tree.children[node][k] = -tree.leaves
        return node

    split(vectors)
    return tree


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(vec_id, v)``: vectors as doubles that are not null, zero or with unfit components.

    Null ids take no part either. Of rows with equal ids each stands for itself.
    """
    v = F.col(vector_col).cast("array<double>")
    fit = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where("vec_id IS NOT NULL").where(fit)


def folded(rows: DataFrame, keep: int) -> DataFrame:
    """``(v, ids)``: each distinct vector with its ``keep`` smallest ids.

    More can't be among anyone's nearest. Ranks are cut before and after the shuffle, so a
    vector that a third of the rows hold sends ``keep`` rows a task.
    """
    by = Window.partitionBy("v").orderBy("vec_id")
    first = rows.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= keep)
    return first.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))


def _matrix(column: pa.Array) -> np.ndarray:
    if not len(column):
        return np.zeros((0, 0))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # else squares of large parts overflow
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def scaled(rows: np.ndarray) -> np.ndarray:
    """Each row by a power of two, so that its squares neither overflow nor vanish; cosines stay the same."""
    return np.ldexp(rows, -np.frexp(np.abs(rows).max(axis=1, keepdims=True))[1])


def cosines(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The cosine of a vector with each row in doubles, every sum from left to right."""
    def dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.add.accumulate(a * b, axis=-1)[..., -1]

    return dot(rows, query) / (np.sqrt(dot(query, query)) * np.sqrt(dot(rows, rows)))


def slack(size: int) -> float:
    """More than products of computed unit vectors and computed cosines of ``size`` parts can differ by rounding, twice over."""
    return 8 * (size + 8) * 2.0**-52


def nearest(query: np.ndarray, own: int, rows: np.ndarray, ids: list[list[int]], k: int) -> list[tuple[float, int]]:
    """The best ``(-score, id)`` of some rows, ties by the smaller id, without the id ``own``."""
    scores = cosines(query, rows)
    return sorted((-score, i) for score, some in zip(scores.tolist(), ids) for i in some if i != own)[:k]


def search(
    vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest rows found for each query.

    ``queries`` are rows of ``vectors``; a row is never its own neighbour. Nearness is the
    cosine of the original vectors, summed in doubles from left to right; ties go to the smaller id. Rows whose vector
    or id is unfit (see ``usable``) take no part; all vectors must have one length. With
    fewer candidates than ``k``, or leaves visited too few, all found are given. No usable
    vector: an empty result.
    """
    spark = vectors.sparkSession
    checkpoint_root(spark)
    rows = usable(vectors, id_col, vector_col)
    stored = folded(rows, k + 1).checkpoint()
    asked = usable(queries, id_col, vector_col).withColumnRenamed("vec_id", "query_id").checkpoint()
    count = stored.count()
    if not count:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    tree = _split(stored, grow(_drawn(stored, SAMPLE, count), LEAF), count)
    found = _search_leaves(stored, asked, tree, _visits(stored, count, tree, k), count, k)
    nearest_first = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(nearest_first)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _split(stored: DataFrame, tree: Tree, count: int) -> Tree:
    """``tree`` with each leaf split by a tree of its own, fitted by a task on a bounded sample of its vectors."""
    if count <= SAMPLE:
        return tree
    held = max(LEAF, count / LEAVES)  # vectors of a leaf aimed at
    share = min(1.0, 32 * LEAVES / count)
    least = max(8, int(held * share))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(tree.leaf(_unit(_matrix(batch.column(0))))), batch.column(0)], ["leaf", "v"])

    def grown(frame: pd.DataFrame) -> pd.DataFrame:
        below = grow(_unit(np.stack(frame["v"])), least)
        rows = [(int(frame["leaf"].iloc[0]), node, c.ravel().tolist(), below.children[node].tolist()) for node, c in enumerate(below.centres)]
        return pd.DataFrame(rows, columns=["leaf", "node", "centres", "children"])

    drawn = stored.select("v").where(F.pmod(F.xxhash64("v", F.lit(SEED + 1)), F.lit(_DRAWS)) < F.lit(int(share * _DRAWS) + 1))
    at = drawn.mapInArrow(placed, "leaf long, v array<double>")
    # a crowded leaf is drawn from once more, so that its tree is fitted on a bounded number
    sizes = at.groupBy("leaf").agg(F.count("*").alias("n")).where(F.col("n") > least)
    some = at.join(F.broadcast(sizes), "leaf").where(
        F.pmod(F.xxhash64("v", F.lit(SEED + 2)), F.lit(_DRAWS)) < F.least(F.lit(1.0), WITHIN / F.col("n")) * _DRAWS + 1)
    found = some.select("leaf", "v").groupBy("leaf").applyInPandas(grown, "leaf long, node long, centres array<double>, children array<long>")
    parts: dict[int, list] = {}
    for row in found.toLocalIterator():  # a few centres for each leaf, and leaves are bounded
        parts.setdefault(row.leaf, []).append((row.node, row.centres, row.children))
    size = tree.centres[0].shape[1]
    whole = Tree([*tree.centres], [c.copy() for c in tree.children], 0)
    fresh: dict[int, int] = {}
    for leaf, nodes in sorted(parts.items()):
        first = len(whole.centres)
        fresh[-leaf - 1] = first
        for _, centres, children in sorted(nodes, key=lambda n: n[0]):
            whole.centres.append(np.array(centres).reshape(-1, size))
            whole.children.append(np.array([c + first if c >= 0 else -(1 << 40) for c in children], dtype=np.int64))
    for node, children in enumerate(whole.children):
        for i, child in enumerate(children.tolist()):
            if child in fresh and node < len(tree.centres):
                children[i] = fresh[child]
            elif child < 0:
                whole.leaves += 1
                children[i] = -whole.leaves
    return whole


def _drawn(stored: DataFrame, most: int, count: int) -> np.ndarray:
    """Unit vectors of a sample of about ``most`` rows, drawn by a hash."""
    drawn = F.pmod(F.xxhash64("v", F.lit(SEED)), F.lit(_DRAWS)) < F.lit(int(min(1.0, most / count) * _DRAWS) + 1)
    some = stored.where(drawn).select("v").toArrow()
    if not some.num_rows:  # a few rows may all miss the draw
        some = stored.select("v").limit(1).toArrow()
    return _unit(_matrix(some.column(0).combine_chunks()))


def _search_leaves(stored: DataFrame, asked: DataFrame, tree: Tree, visits: int, count: int, k: int) -> DataFrame:
    """``(query_id, vec_id, score)``: of every bundle the best of the leaves that each query visits."""
    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaf = tree.leaf(_unit(_matrix(batch.column(0))))
                yield pa.RecordBatch.from_arrays([pa.array(leaf), batch.column(0), batch.column(1)], ["leaf", "v", "ids"])

    index = stored.select("v", "ids").mapInArrow(placed, "leaf long, v array<double>, ids array<long>").checkpoint()
    # leaves of more than a block; there are no more of them than leaves
    large = {r.leaf: -(-r.n // BLOCK) for r in index.groupBy("leaf").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK).collect()}
    bundles = -(-count // BUNDLE)
    blocks = F.element_at(F.create_map(*[F.lit(x) for pair in large.items() for x in pair]), F.col("leaf")) if large else F.lit(None)
    block = F.pmod(F.xxhash64("v"), F.coalesce(blocks.cast("long"), F.lit(1).cast("long")))
    held = index.withColumn("bundle", F.pmod(F.xxhash64("leaf", block), F.lit(bundles)).cast("int"))
    places = {}  # the bundles of each leaf of many blocks or one, by the same hash
    spark = stored.sparkSession
    every = spark.range(tree.leaves).withColumn("blocks", F.coalesce(F.element_at(
        F.create_map(*[F.lit(x) for pair in large.items() for x in pair]), F.col("id")) if large else F.lit(None).cast("long"), F.lit(1).cast("long")).cast("long"))
    units = every.select("id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    for row in units.groupBy("id").agg(F.collect_set(F.pmod(F.xxhash64("id", "block"), F.lit(bundles)).cast("int")).alias("b")).toLocalIterator():
        places[row.id] = row.b

    def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 100):
                part = batch.slice(start, 100)
                of, bundle, leaves = [], [], []
                for i, query in enumerate(_unit(_matrix(part.column(1)))):
                    to: dict[int, list[int]] = {}
                    for leaf in tree.order(query, visits):
                        for b in places[leaf]:
                            to.setdefault(b, []).append(leaf)
                    of += [i] * len(to)
                    bundle += to
                    leaves += to.values()
                rows = pa.array(of, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(rows), part.column(1).take(rows), pa.array(bundle, pa.int32()), pa.array(leaves, pa.list_(pa.int64()))],
                    ["query_id", "q", "bundle", "leaves"])

    walks = asked.select("query_id", F.col("v").alias("q")).mapInArrow(walked, "query_id long, q array<double>, bundle int, leaves array<long>")
    # queries come to a bundle in pieces of bounded size, each with the vectors of the bundle
    pieces = -(-asked.count() // QUERIES) or 1
    walks = walks.withColumn("piece", F.pmod(F.xxhash64("query_id"), F.lit(pieces)).cast("int"))
    held = held.withColumn("piece", F.explode(F.sequence(F.lit(0), F.lit(pieces - 1))))

    def compared(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, float]] = []
        if len(left) and len(right):
            left = left.sort_values("leaf", kind="stable")
            vectors = scaled(np.stack(left["v"]))
            units, ids = _unit(vectors), [list(i) for i in left["ids"]]
            leaf = left["leaf"].to_numpy()
            asks = scaled(np.stack(right["q"]))
            ask_units, names = _unit(asks), right["query_id"].to_numpy()
            visitors: dict[int, list[int]] = {}
            for i, leaves in enumerate(right["leaves"]):
                for x in leaves:
                    visitors.setdefault(int(x), []).append(i)
            near: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in names]
            bound = slack(vectors.shape[1])
            for x in np.unique(leaf):
                start, stop = np.searchsorted(leaf, [x, x + 1])
                who = visitors.get(int(x), [])
                if who:
                    products = ask_units[who] @ units[start:stop].T
                    least = np.partition(products, -min(k + 1, stop - start), axis=1)[:, -min(k + 1, stop - start)]
                    for i, row, at_least in zip(who, products, least):
                        there = np.flatnonzero(row >= at_least - bound)
                        near[i].append((row[there], there + start))
            for i, found in enumerate(near):
                if found:
                    products, rows = (np.concatenate(c) for c in zip(*found))
                    few = min(k + 1, len(rows))
                    rows = rows[products >= np.partition(products, -few)[-few] - bound]
                    best = nearest(asks[i], int(names[i]), vectors[rows], [ids[r] for r in rows], k)
                    out += [(int(names[i]), i_, -score) for score, i_ in best]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    return (
        held.groupBy("bundle", "piece").cogroup(walks.groupBy("bundle", "piece"))
        .applyInPandas(compared, "query_id long, vec_id long, score double")
    )


def _visits(stored: DataFrame, count: int, tree: Tree, k: int) -> int:
    """Leaves to visit so that ``RECALL`` of the calibration vectors' true neighbours are met."""
    queries = _drawn(stored, CALIBRATION, count)

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                rows = _unit(_matrix(batch.column(0).slice(start, BLOCK)))
                if not len(rows):
                    continue
                near = queries @ rows.T
                keep = min(k + 1, len(rows))
                top = np.argpartition(-near, keep - 1, axis=1)[:, :keep]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(np.arange(len(queries)), keep)), pa.array(tree.leaf(rows)[top.ravel()]),
                    pa.array(np.take_along_axis(near, top, axis=1).ravel()),
                ], ["query", "leaf", "near"])

    best = Window.partitionBy("query").orderBy(F.desc("near"))
    truth = (
        stored.select("v").mapInArrow(compared, "query long, leaf long, near double")
        # itself and k others: a row for each, so this is bounded by the calibration
        .withColumn("place", F.row_number().over(best)).where(F.col("place") <= k + 1).toPandas()
    )
    places = []
    for query, leaves in truth.groupby("query")["leaf"]:
        order = {leaf: i + 1 for i, leaf in enumerate(tree.order(queries[query], tree.leaves))}
        places += [order[leaf] for leaf in leaves]
    return int(np.quantile(places, RECALL, method="higher"))
