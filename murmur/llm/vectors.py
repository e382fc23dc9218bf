"""What the two vector searches share: which rows take part, samples, blocks, merging."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from murmur.llm.frames import FILE, ROW, placed

#: Vectors of a shard, and queries of a block: what one group holds at most, or nearly.
SHARD, BLOCK = 8192, 4096


def taking_part(rows: DataFrame, key: str, vector: str, zero: bool) -> DataFrame:
    """(key, vector) of rows whose key and vector are not null and whose components are
    all finite; without ``zero`` also not all zero. Where lengths differ, the most
    frequent one (the longer of two) takes part."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = rows.select(key, F.col(vector).cast("array<double>").alias(vector)).filter(
        F.col(key).isNotNull() & F.col(vector).isNotNull() & (F.size(vector) > 0) & finite
    )
    if not zero:
        kept = kept.filter(F.exists(vector, lambda x: x != 0))
    # One row for each length; all that is fetched is the first.
    usual = kept.groupBy(F.size(vector).alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return kept.filter(F.size(vector) == (usual["n"] if usual else 0))


def matrix(column: pa.ChunkedArray | pa.Array, kind: type = np.float64) -> np.ndarray:
    """A column of equally long lists as rows."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.asarray(flat, kind).reshape(len(column), -1)


def sample_of(rows: DataFrame, key: str, vector: str, count: int, most: int, seed: int) -> pa.Table:
    """About ``most`` rows, chosen by a hash of key and vector, in the order of the key;
    equal rows count once, so a row that is there very often does not swell it."""
    span = 1 << 30
    share = min(span, span * most // max(count, 1))
    chosen = rows.select(key, vector).filter(F.pmod(F.xxhash64(key, vector, F.lit(seed)), F.lit(span)) < share)
    return chosen.distinct().orderBy(key, vector).toArrow()


def in_blocks(
    queries: DataFrame, rows: DataFrame, key: str, n_queries: int, n_rows: int,
    search: Callable[[pa.Table, pa.Table], pa.Table], schema: str,
) -> DataFrame:
    """``search(queries, rows)`` for every block of queries and every shard of rows.

    Queries are dealt by a hash of their key, which each has for itself, rows by their place,
    so blocks and shards are even and bounded, also where a third of all rows share a key.
    """
    blocks, shards = max(1, -(-n_queries // BLOCK)), max(1, -(-n_rows // SHARD))

    def number(n: int, seed: int, *by: str):
        return F.pmod(F.xxhash64(*by, F.lit(seed)), F.lit(n))

    def each(n: int):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    left = queries.select("*", number(blocks, 1, key).alias("_block"), each(shards).alias("_shard"))
    right = placed(rows).select(*rows.columns, number(shards, 2, FILE, ROW).alias("_shard"), each(blocks).alias("_block"))
    empty = [f.split() for f in schema.split(", ")]

    def run(q: pa.Table, x: pa.Table) -> pa.Table:
        if not q.num_rows or not x.num_rows:
            kinds = {"long": pa.int64(), "double": pa.float64()}
            return pa.table({n: pa.array([], kinds[k]) for n, k in empty})
        return search(q, x)

    return left.groupBy("_block", "_shard").cogroup(right.groupBy("_block", "_shard")).applyInArrow(run, schema)


def best(found: DataFrame, k: int, largest: bool) -> DataFrame:
    """The ``k`` best rows of each query with their rank; ties go to the smaller key.

    Each group has sent its own ``k`` best, and Spark limits ranks before it shuffles.
    """
    order = [F.desc("score") if largest else F.asc("score"), F.asc("vec_id")]
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(*order))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
