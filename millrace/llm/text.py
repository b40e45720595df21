"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path

#: A-Z become a-z; 0-9, a-z and every byte of a non-ASCII character stay; all else parts words.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)

#: Texts go through a task in pieces of so many rows, whatever the size of Spark's batches.
SLICE = 250


def words(text: bytes) -> list[bytes]:
    """The lower-cased words of a UTF-8 text: runs of digits, letters and non-ASCII characters."""
    return text.translate(WORD_BYTES).split()


def bytes_of(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8 bytes, null as empty. Sliced by the caller, so memory stays bounded."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [value or b"" for value in column.cast(kind).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE):
            yield batch.slice(start, SLICE)


#: Rows and bytes of text that go to Python at once: texts may be long, and every task holds a batch or two.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": 1000, "spark.sql.execution.arrow.maxBytesPerBatch": 16 << 20}


def bounded(df: DataFrame) -> DataFrame:
    """``df``, its session set to send no more than ``BATCH`` to Python at once. Smaller settings stay."""
    conf = df.sparkSession.conf
    for key, most in BATCH.items():
        now = str(conf.get(key)).removesuffix("b")
        if not now.isdigit() or not 0 < int(now) <= most:
            conf.set(key, str(most))
    return df


#: How to give back what this worker keeps from task to task: one operator's state at a time.
_kept: list[Callable[[], None]] = []


def keeps(forget: Callable[[], None]) -> None:
    """Called as a task of ``in_batches`` starts whose state outlives it: ``forget`` gives that back
    as soon as the worker starts on another operator's task. Workers live on from query to query."""
    _kept.append(forget)


def _begun(function: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]]) -> Callable[[pa.RecordBatch], pa.RecordBatch]:
    before = _kept[:]
    _kept.clear()
    step = function()
    for forget in before:
        if forget not in _kept:
            forget()
    return step


def in_batches(
    df: DataFrame, schema: str, function: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]]
) -> DataFrame:
    """``mapInArrow`` with state made once a task: ``function()`` gives what maps a slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = _begun(function)
        for batch in slices(batches):
            yield step(batch)

    return bounded(df).mapInArrow(run, schema)


def id_and_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the two columns that are read, under names of our own: others never clash."""
    return bounded(df).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def written(df: DataFrame, what: str) -> DataFrame:
    """``df`` as a compressed table in the shared folder: for many rows smaller than a checkpoint."""
    path = scratch_path(df.sparkSession, what)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
