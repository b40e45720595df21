"""Top-n recommendations from fitted factors.

Scoring every user against every item is a matrix product. The other side is cut into
blocks of at most ``cells`` numbers (80 MB by default, counted first), each is broadcast,
and every task multiplies its users by it and keeps its top n. With one block that is one
pass without a shuffle; with more, the n best of each block meet and the n best stay.
Equal ratings go to the smaller id, however many blocks there are.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CELLS = 20_000_000
SCHEMA = "id int, rank int, other int, rating float"


def recommend_items(model: Any, n: int, users: DataFrame | None = None, cells: int = CELLS) -> DataFrame:
    """(id, rank, other, rating): the n best items of each user; ``users`` limits to the ids
    in its first column."""
    return _best(_some(model.userFactors, users), model.itemFactors, n, cells // model.rank)


def recommend_users(model: Any, n: int, items: DataFrame | None = None, cells: int = CELLS) -> DataFrame:
    """(id, rank, other, rating): the n best users of each item; ``items`` limits to the ids
    in its first column."""
    return _best(_some(model.itemFactors, items), model.userFactors, n, cells // model.rank)


def _some(factors: DataFrame, ids: DataFrame | None) -> DataFrame:
    if ids is None:
        return factors
    return factors.join(ids.select(ids[ids.columns[0]].alias("id")).distinct(), "id", "left_semi")


def _best(queries: DataFrame, targets: DataFrame, n: int, limit: int) -> DataFrame:
    count = max(1, -(-targets.count() // max(1, limit)))
    block = F.pmod(F.xxhash64("id"), F.lit(count))
    found = [_product(queries, targets.where(block == b), n) for b in range(count)]
    if count == 1:
        return found[0]
    best = Window.partitionBy("id").orderBy(F.desc("rating"), "other")
    met = reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(best))
    return met.where(F.col("rank") <= n).select("id", "rank", "other", "rating")


def _factors(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(len(column), -1)


def _product(queries: DataFrame, targets: DataFrame, n: int) -> DataFrame:
    rows = targets.orderBy("id").toArrow()
    ids = rows.column("id").to_numpy().astype(np.int32)
    matrix = _factors(rows.column("features").combine_chunks()).T if len(ids) else None
    shared = queries.sparkSession.sparkContext.broadcast((ids, matrix))

    def top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, right = shared.value
        k = min(n, len(names))
        if k == 0:
            return
        # users per product, so a block of scores stays near 64 MB
        step = max(1, 16_000_000 // len(names))
        for batch in batches:
            who = batch.column("id").to_numpy().astype(np.int32)
            left = _factors(batch.column("features"))
            for start in range(0, len(who), step):
                scores = left[start:start + step] @ right
                # best first, equal scores by smaller id (ids ascend)
                order = np.argsort(-scores, axis=1, kind="stable")[:, :k]
                count = len(order)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(who[start:start + step], k)),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), count)),
                        pa.array(names[order].ravel()),
                        pa.array(np.take_along_axis(scores, order, axis=1).ravel()),
                    ],
                    names=["id", "rank", "other", "rating"],
                )

    return queries.select("id", "features").mapInArrow(top, SCHEMA)
