"""Whole-row operators: cleaning filter, first copies, dense IDs, fill, counts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window as W, functions as F

from murmur.functions import cleaning
from murmur.session import discard, materialize, materialize_measured


def spam_filter(df: DataFrame, text: str = "translated") -> DataFrame:
    """Keep rows that are not spam, with ``text`` scrubbed and ``spam`` = 0."""
    columns = [c for c in df.columns if c != "spam"]
    # inline() evaluates the screening once; a filter on a plain projection would be
    # pushed below it and repeat the work.
    screened = df.select(
        *columns,
        F.inline(F.array(cleaning.screen(F.col(text)))).alias("_text", "_spam"),
    )
    kept = [F.col("_text").alias(c) if c == text else F.col(c) for c in columns]
    return screened.filter(~F.col("_spam")).select(*kept, F.lit(0).alias("spam"))


def first_copies(df: DataFrame, column: str, order_by: str) -> DataFrame:
    """One row per value of ``column``: the one that is first by ``order_by``, which is
    different for every row; nulls are one value.

    Only a hash of the value and the order key are aggregated, folded in each task before
    they travel; then each row meets the winner of its hash, and its text travels once.
    A value that a third of all rows share is a skewed key of that join, which AQE splits.
    ``df`` is read twice, so what was costly to make should be written before.
    """
    signed = df.withColumn("_sign", F.coalesce(F.sha2(F.col(column), 256), F.lit("")))
    first = signed.groupBy("_sign").agg(F.min(order_by).alias("_first")).select(
        F.col("_sign").alias("_own"), "_first"
    )
    same = (F.col("_sign") == F.col("_own")) & (F.col(order_by) == F.col("_first"))
    return signed.join(first, same, "left_semi").select(*df.columns)


def dense_ids(df: DataFrame, order_by: str, name: str = "id") -> DataFrame:
    """Number rows 0, 1, 2, … by ``order_by``, without a single-task window.

    Rows are written once, as range partitioning looks at its input twice; then
    range-partitioned, sorted and written with their place in their partition, and
    shifted by the sizes of the partitions before.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    place = F.monotonically_increasing_id()
    stored = materialize(df)
    placed = materialize(
        stored.repartitionByRange(parts, order_by)
        .sortWithinPartitions(order_by)
        .withColumn("_part", F.shiftright(place, 33))
        .withColumn("_place", place.bitwiseAND(F.lit((1 << 33) - 1)))
    )
    discard(stored)
    # One row per partition: bounded by the partition count.
    sizes = placed.groupBy("_part").agg((F.max("_place") + 1).alias("_rows"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")
    )
    return (
        placed.join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + F.col("_place"))
        .drop("_part", "_place", "_start")
    )


def forward_fill(
    df: DataFrame, line: str, column: str, default: str = "Unknown", block: int = 1_000_000
) -> DataFrame:
    """Replace nulls in ``column`` by the last value above; ``default`` before any.

    ``line`` is a unique line number. Lines are filled block by block, and each
    block starts from the last value of the blocks before it.
    """
    blocks = df.withColumn("_block", F.floor(F.col(line) / block))
    last = blocks.groupBy("_block").agg(
        F.max_by(column, F.when(F.col(column).isNotNull(), F.col(line))).alias("_last")
    )
    # One row per block of lines.
    above = W.orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    carry = last.select("_block", F.last("_last", ignorenulls=True).over(above).alias("_carry"))
    inside = W.partitionBy("_block").orderBy(line)
    filled = F.coalesce(
        F.last(column, ignorenulls=True).over(inside), F.col("_carry"), F.lit(default)
    )
    return (
        blocks.join(carry, "_block", "left").withColumn(column, filled).select(*df.columns)
    )


def drop_empty_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.dropna("all", subset=columns)


def fill_listing(df: DataFrame, line: str, column: str, default: str = "Unknown", block: int = 1_000_000) -> DataFrame:
    """A listing whose ``column`` is written on the first line of several: empty lines
    dropped, ``column`` filled from above."""
    return forward_fill(drop_empty_rows(df, [c for c in df.columns if c != line]), line, column, default, block)


def observed_counts(
    df: DataFrame, stages: list[tuple[str, Callable[[DataFrame], DataFrame]]], first: str = "read"
) -> tuple[DataFrame, DataFrame]:
    """(result, counts): ``df`` after all stages, and (stage, rows) with the rows before
    the first and after each.

    Each stage is written once and counted while it is written, so none runs twice.
    """
    counts, result = [], df
    for name, stage in [(first, lambda rows: rows), *stages]:
        last = result
        result, seen = materialize_measured(stage(result), rows=F.count(F.lit(1)))
        discard(last)
        counts.append((name, seen["rows"]))
    return result, df.sparkSession.createDataFrame(counts, "stage string, rows long")
