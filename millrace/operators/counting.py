"""Word counts over a vocabulary that no driver has to hold.

Spark's counter collects its words, joins nothing and carries the whole list with the model. That is right
for a bounded vocabulary. One of all words (``min_df`` of 1) grows with the texts: beyond ``HELD`` words, counted
first, it stays a table of (word, idx) here, in Spark's order, and texts are joined with it.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import Model
from pyspark.ml import feature as ml
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path

#: Words that the driver holds at most, and the commonest ones that every task is told.
HELD, COMMON = 500_000, 100_000


class CountVectorizer(ml.CountVectorizer):
    """Spark's own up to ``HELD`` words, or where ``vocab_size`` or ``min_df`` bound them."""

    def _fit(self, dataset: DataFrame) -> Any:
        open_ended = self.getVocabSize() > HELD and self.getMinDF() <= 1.0 == self.getMinTF() and not self.isSet(self.maxDF)
        if not open_ended or dict(dataset.dtypes)[self.getInputCol()] != "array<string>":
            return super()._fit(dataset)
        spark, path = dataset.sparkSession, scratch_path(dataset.sparkSession, "words")
        words = dataset.select(F.explode(self.getInputCol()).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
        words.write.parquet(path)
        words = spark.read.parquet(path)
        size = words.count()
        if not HELD < size <= self.getVocabSize():
            return super()._fit(dataset)
        return TableVocabulary(_ranked(words), size, self.getInputCol(), self.getOutputCol(), self.getBinary())


class TableVocabulary(Model):
    """A fitted counter whose ``vocabulary`` is a frame (idx, word) in shared storage."""

    def __init__(self, vocabulary: DataFrame, size: int, words: str, output: str, binary: bool):
        super().__init__()
        self._vocabulary, self.size, self.words, self.output, self.binary = vocabulary, size, words, output, binary
        common = vocabulary.where(F.col("idx") < COMMON).toPandas()
        self._common = common.sort_values("idx")["word"].tolist()

    @property
    def vocabulary(self) -> DataFrame:
        return self._vocabulary

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.counted(dataset, dataset.columns)

    def counted(self, dataset: DataFrame, keep: list[str]) -> DataFrame:
        """``keep`` of the rows and their vectors, read from a table that is written once."""
        spark = dataset.sparkSession
        split, to = scratch_path(spark, "texts"), scratch_path(spark, "counted")
        fields = [dataset.schema[c] for c in keep]
        schema = T.StructType([
            T.StructField("_row", T.LongType()), *fields, T.StructField("_known", T.ArrayType(T.IntegerType())),
            T.StructField("_times", T.ArrayType(T.IntegerType())), T.StructField("_rare", T.ArrayType(T.StringType()))])
        # rows have no key of their own; what is numbered is written, so that a number stays with its row
        rows = dataset.select(F.monotonically_increasing_id().alias("_row"), *keep, F.col(self.words).alias("_words"))
        rows.mapInArrow(_known(self._common, self.binary), schema).write.parquet(split)
        rows = spark.read.schema(schema).parquet(split)
        rare = rows.select("_row", F.explode("_rare").alias("word")).groupBy("_row", "word").agg(F.count("*").alias("n"))
        found = rare.join(self._vocabulary, "word").groupBy("_row").agg(
            F.collect_list(F.struct("idx", (F.lit(1) if self.binary else F.col("n").cast("int")).alias("n"))).alias("_found"))
        known = F.zip_with("_known", "_times", lambda i, n: F.struct(i.alias("idx"), n.alias("n")))
        entries = F.array_sort(F.concat(known, F.coalesce("_found", F.array().cast("array<struct<idx:int,n:int>>"))))
        vector = F.struct(
            F.lit(0).cast("tinyint").alias("type"), F.lit(self.size).cast("int").alias("size"),
            F.col("_entries")["idx"].alias("indices"), F.transform("_entries", lambda e: e["n"].cast("double")).alias("values"))
        whole = rows.drop("_rare").join(found, "_row", "left").withColumn("_entries", entries)
        whole.select(*keep, vector.alias(self.output)).write.parquet(to)
        return spark.read.schema(T.StructType([*fields, T.StructField(self.output, VectorUDT())])).parquet(to)


def settled(model: Any, dataset: DataFrame, *columns: str) -> DataFrame:
    """``columns`` of the counted rows, cut off from the texts: what is read again is not counted again."""
    if isinstance(model, TableVocabulary):
        return model.counted(dataset, [c for c in columns if c != model.output]).select(*columns)
    return model.transform(dataset).select(*columns).checkpoint()


def _ranked(words: DataFrame) -> DataFrame:
    """(idx, word): frequent words first, equally frequent ones backwards."""
    spark, path = words.sparkSession, scratch_path(words.sparkSession, "vocabulary")
    order = [F.col("n").desc(), F.col("word").desc()]
    placed = words.repartitionByRange(*order).sortWithinPartitions(*order)
    placed.select("word", F.spark_partition_id().alias("part")).mapInArrow(_numbered, "word string, part int, place bigint").write.parquet(path)
    placed = spark.read.parquet(path)
    sizes = sorted(tuple(r) for r in placed.groupBy("part").agg(F.count("*")).collect())  # one row per range
    starts = np.cumsum([0] + [n for _, n in sizes]).tolist()
    offsets = F.create_map(*[F.lit(x) for (part, _), start in zip(sizes, starts) for x in (part, start)])
    return placed.select((F.col("place") + offsets[F.col("part")]).cast("int").alias("idx"), "word")


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    before = 0
    for batch in batches:
        places = pa.array(np.arange(before, before + batch.num_rows))
        before += batch.num_rows
        yield pa.RecordBatch.from_arrays([*batch.columns, places], ["word", "part", "place"])


def _known(common: list[str], binary: bool) -> Any:
    """Cuts each text's words into the numbers of common ones, with how often they stand, and the other words."""
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told, base = pa.array(common, pa.string()), max(1, len(common))
        for batch in (b.slice(start, 500) for b in batches for start in range(0, b.num_rows, 500)):
            *kept, words = batch.columns
            sizes = pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False)
            flat, owner = words.flatten().cast(pa.string()), np.repeat(np.arange(batch.num_rows), sizes)
            index, valid = pc.index_in(flat, value_set=told), pc.is_valid(flat).to_numpy(zero_copy_only=False)
            known = pc.is_valid(index).to_numpy(zero_copy_only=False) & valid
            numbers = index.filter(pa.array(known)).to_numpy(zero_copy_only=False).astype(np.int64)
            cells, times = np.unique(owner[known] * base + numbers, return_counts=True)
            starts, rest = _ends(cells // base, batch.num_rows), valid & ~known
            times = np.ones_like(times) if binary else times
            yield pa.RecordBatch.from_arrays([
                *kept, pa.ListArray.from_arrays(starts, pa.array((cells % base).astype(np.int32))),
                pa.ListArray.from_arrays(starts, pa.array(times.astype(np.int32))),
                pa.ListArray.from_arrays(_ends(owner[rest], batch.num_rows), flat.filter(pa.array(rest)))],
                [*batch.schema.names[:-1], "_known", "_times", "_rare"])

    return split


def _ends(owners: np.ndarray, rows: int) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum(np.bincount(owners, minlength=rows))]).astype(np.int32))
