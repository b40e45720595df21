"""Connected components of a table of links, by repeated contraction.

Every round each node takes the smallest of itself and its neighbours as its parent, in an
order that is drawn anew each round (a hash), and the links are redrawn between parents.
Paths between nodes survive that, and a constant share of the nodes is expected to go in a
round, so a chain of n nodes takes about log n rounds and not n. Nothing is collected:
the driver only asks how many links are left. As soon as they are few, one task joins what is
left: the last rounds are most of all rounds, and each of them costs the driver as much as the first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_root

#: So many ends of links one task joins (some 20 MB there); more are contracted by shuffles until they are so few.
PARENTS = 200_000


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links(a, b)``, longs: the smallest node of its component.

    Links may repeat, run either way or from a node to itself; nulls link nothing. A node
    without a link to another one is not in the result. No links: an empty table.
    """
    checkpoint_root(links.sparkSession)
    links = _redrawn(links.select("a", "b")).checkpoint()
    label, turn = None, 0
    while 2 * (count := links.count()) > PARENTS:  # a link has two ends
        both = links.union(links.select("b", "a"))
        best = F.min(F.struct(F.xxhash64("b", F.lit(turn)).alias("h"), F.col("b").alias("p")))
        own = F.xxhash64("a", F.lit(turn))
        parent = (
            both.groupBy("a").agg(best.alias("m"))
            .select(F.col("a").alias("node"), F.when(F.col("m.h") < own, F.col("m.p")).otherwise(F.col("a")).alias("p"))
            .checkpoint()
        )
        left, right = parent.toDF("a", "pa"), parent.toDF("b", "pb")
        links = _redrawn(
            links.join(left, "a").join(right, "b").select(F.col("pa").alias("a"), F.col("pb").alias("b"))
        ).checkpoint()
        label = parent.toDF("node", "root") if label is None else _moved(label, parent).checkpoint()
        turn += 1
    if label is None:
        return _joined(links).checkpoint()
    if count:
        label = _moved(label, _joined(links)).checkpoint()
    least = label.groupBy("root").agg(F.min("node").alias("least"))
    return label.join(least, "root").select("node", F.col("least").alias("root")).checkpoint()


def _moved(label: DataFrame, parent: DataFrame) -> DataFrame:
    return label.join(parent.toDF("root", "p"), "root", "left").select("node", F.coalesce("p", "root").alias("root"))


def _joined(links: DataFrame) -> DataFrame:
    """``components`` of at most ``PARENTS / 2`` links, by union and find in one task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends = [[], []]
        for batch in batches:
            for own, column in zip(ends, batch.columns):
                own.append(column.to_numpy())
        nodes, places = np.unique(np.concatenate([np.zeros(0, np.int64), *ends[0], *ends[1]]), return_inverse=True)
        above = list(range(len(nodes)))

        def top(i: int) -> int:
            while above[i] != i:
                above[i] = above[above[i]]
                i = above[i]
            return i

        for a, b in places.reshape(2, -1).T.tolist():
            a, b = top(a), top(b)
            above[max(a, b)] = min(a, b)
        root = nodes[np.array([top(i) for i in range(len(nodes))], dtype=np.int64)]
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(root)], ["node", "root"])

    return links.coalesce(1).mapInArrow(run, "node long, root long")


def _redrawn(links: DataFrame) -> DataFrame:
    return (
        links.where(F.col("a") != F.col("b"))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )
