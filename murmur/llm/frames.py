"""Helpers that the operators share: reading, batches, conditions on columns."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from murmur.session import materialize

#: Rows of one Arrow batch; with long texts a batch stays far below a worker's memory.
BATCH_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(df: DataFrame, rows: int = BATCH_ROWS) -> DataFrame:
    """``df``, with Arrow batches of at most ``rows`` rows from now on in its session."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    return df


#: A row's place: its file and its number in it.
FILE, ROW = "_placed_file", "_placed_row"


def placed(df: DataFrame) -> DataFrame:
    """``df`` with the place of each row, which stays the same however often it is read.

    Where ``df`` is no plain read of files, it is written first.
    """
    place = ["_metadata.file_path AS " + FILE, "_metadata.row_index AS " + ROW]
    try:
        return df.selectExpr("*", *place)
    except AnalysisException:
        return materialize(df).selectExpr("*", *place)


def texts_of(column: pa.Array | pa.ChunkedArray) -> list[str]:
    """A string column as Python strings; null is empty."""
    return [t or "" for t in column.to_pylist()]


def by_size(sizes: list[int], most: int) -> Iterator[slice]:
    """Consecutive runs of items whose sizes add up to ``most`` at most, or single items."""
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > most:
            yield slice(start, i)
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield slice(start, len(sizes))


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of each range, one range after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)
