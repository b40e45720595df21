"""Scoring a stream: a fitted model is a row-wise transformer, so it takes one."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

from pyspark.ml.feature import VectorSizeHint
from pyspark.sql import DataFrame


def score_stream(model: Any, stream: DataFrame, vector_sizes: dict[str, int] | None = None) -> DataFrame:
    """Append the model's columns to a streaming frame.

    An assembler cannot look at rows of a stream for vector lengths, so give the sizes of
    the vector columns it takes; rows of another length stop the query.
    """
    if not stream.isStreaming:
        raise ValueError("not a streaming frame; use transform")
    for column, size in (vector_sizes or {}).items():
        stream = VectorSizeHint(inputCol=column, size=size, handleInvalid="error").transform(stream)
    return model.transform(stream)


def score_folder(
    model: Any, stream: DataFrame, to: str, state: str, keep: Sequence[str], vector_sizes: dict[str, int] | None = None,
    prepare: Callable[[DataFrame], DataFrame] | None = None, checked_seconds: float | None = None,
) -> DataFrame:
    """Score all that is there to read of a stream and stop; the scored table so far.

    ``stream`` is a streaming frame over a folder (bound the files of a step by its option
    ``maxFilesPerTrigger``). ``prepare`` makes the model's inputs out of its rows, columns ``keep`` of the result are
    appended to the Parquet table at ``to``. What has been read stands in ``state``, so a later call with
    the same two folders scores only what came since, and a call that was broken off goes on where it
    stopped without writing a row twice. Both belong in a folder all executors share.
    ``checked_seconds`` bounds the time waited; an unfinished run is stopped and raises.
    """
    rows = prepare(stream) if prepare else stream
    run = (
        score_stream(model, rows, vector_sizes).select(*keep)
        .writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
        .option("checkpointLocation", state).option("path", to).start()
    )
    if not run.awaitTermination(checked_seconds):
        if checked_seconds is not None and run.isActive:
            run.stop()
            raise TimeoutError(f"the stream was not scored within {checked_seconds} seconds; call again to go on")
    return stream.sparkSession.read.parquet(to)
