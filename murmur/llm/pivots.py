"""Operator 4: exact top-k by inner product, with a table of distances to pivots.

One component more makes an inner product a distance: with M the largest length of any
row, a row x gets sqrt(M² - |x|²) and a query 0, and then |q - x|² = |q|² + M² - 2 q·x.
Distances from every row and query to ``PIVOTS`` rows are worked out once. By the triangle
inequality a pivot gives a lower bound on a distance, hence an upper bound on a score; the
best of all pivots' bounds counts. In each shard rows are evaluated in the order of their
bounds until the next bound cannot reach the query's k-th score. That score starts from
the pivots themselves, which are rows like others, so no shard starts from nothing.

Scores are exact integers: doubles hold them where they cannot exceed 2 ** 53, else
Python's integers do. Scores beyond a long are cut to its ends.

Defined results: vectors that are null or hold null or non-finite components (also once
multiplied), or have
another length than most, take no part, nor do rows without a key; zero vectors do; rows
with a query's own key are left out; repeated rows count each; a repeated query is
searched once, with the first of its vectors; empty tables give none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from murmur.llm.vectors import best, in_blocks, matrix, sample_of, taking_part
from murmur.session import materialize

TOP = 5
SCALE = 256
PIVOTS = 32
#: Rows among which pivots are chosen, and rows evaluated at once.
POOL, STEP = 2048, 512
EXACT = float(1 << 53)
LONG = (1 << 63) - 1
SCHEMA = "query_id long, vec_id long, score long"


def choose(rows: np.ndarray, n: int = PIVOTS) -> np.ndarray:
    """Rows that are far from each other, by their number."""
    if not len(rows):
        return np.zeros(0, np.int64)
    picked = [int((rows**2).sum(1).argmax())]
    away = ((rows - rows[picked[0]]) ** 2).sum(1)
    while len(picked) < min(n, len(rows)) and away.max() > 0:
        picked.append(int(away.argmax()))
        away = np.minimum(away, ((rows - rows[picked[-1]]) ** 2).sum(1))
    return np.array(picked)


def raised(rows: np.ndarray, longest: float) -> np.ndarray:
    """``rows`` with the component that makes all of them equally long."""
    return np.hstack([rows, np.sqrt(np.maximum(longest - (rows**2).sum(1), 0))[:, None]])


def distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (rows**2).sum(1)[:, None] + (pivots**2).sum(1)[None] - 2 * rows @ pivots.T
    return np.sqrt(np.maximum(square, 0))


def scores(rows: np.ndarray, query: np.ndarray, exact: bool) -> np.ndarray:
    if exact:
        return (rows @ query).astype(np.int64)
    whole = [int(c) for c in query]
    found = [sum(int(a) * b for a, b in zip(row, whole)) for row in rows.tolist()]
    return np.array([max(-LONG - 1, min(LONG, s)) for s in found], np.int64)


def search(queries: pa.Table, rows: pa.Table, seeds: tuple[np.ndarray, np.ndarray], longest: float, exact: bool, k: int) -> pa.Table:
    ids, x, to = rows.column("vec_id").to_numpy(), matrix(rows.column("whole")), matrix(rows.column("away"))
    own, q, from_query = queries.column("vec_id").to_numpy(), matrix(queries.column("whole")), matrix(queries.column("away"))
    # Rounding of squares and roots, in units of scores.
    slack = 1 + 1e-9 * (longest + (q**2).sum(1))
    of, found, score = [], [], []
    for i in range(len(q)):
        least = np.abs(to - from_query[i]).max(1)
        bound = ((q[i] ** 2).sum() + longest - least**2) / 2 + slack[i]
        known = np.sort(scores(seeds[1], q[i], exact)[seeds[0] != own[i]])[::-1]
        floor = known[k - 1] if len(known) >= k else -LONG - 1
        going = np.flatnonzero((bound >= floor) & (ids != own[i]))
        going = going[np.argsort(-bound[going], kind="stable")]
        top_ids, top = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for at in range(0, len(going), STEP):
            if bound[going[at]] < floor:
                break
            block = going[at : at + STEP]
            top = np.append(top, scores(x[block], q[i], exact))
            top_ids = np.append(top_ids, ids[block])
            order = np.lexsort((top_ids, -top.astype(object) if not exact else -top))[:k]
            top, top_ids = top[order], top_ids[order]
            if len(top) == k:
                floor = max(floor, top[-1])
        of.append(np.full(len(top), own[i]))
        found.append(top_ids)
        score.append(top)
    return pa.table({"query_id": np.concatenate(of), "vec_id": np.concatenate(found), "score": np.concatenate(score)})


def largest_products(rows: DataFrame, is_query, k: int = TOP, scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row where ``is_query`` the ``k`` others of
    the largest integer inner product, of columns vec_id and embedding."""
    # A component beyond 2 ** 52 is a whole number already.
    whole = F.transform("embedding", lambda c: F.when(F.abs(c) < float(1 << 52), F.floor(c * scale).cast("double")).otherwise(c * scale))
    ready = taking_part(rows, "vec_id", "embedding", zero=True).select("vec_id", whole.alias("whole"))
    ready = taking_part(ready, "vec_id", "whole", zero=True)
    size = F.aggregate("whole", F.lit(0.0), lambda s, c: s + c * c)
    high = F.aggregate("whole", F.lit(0.0), lambda s, c: F.greatest(s, F.abs(c)))
    facts = ready.agg(F.count("*").alias("n"), F.max(size).alias("longest"), F.max(high).alias("high"), F.max(F.size("whole")).alias("width")).first()
    n, longest = facts["n"], facts["longest"] or 0.0
    if not n:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    exact = facts["high"] ** 2 * facts["width"] < EXACT
    pool = sample_of(ready, "vec_id", "whole", n, POOL, 13)
    if not pool.num_rows:
        pool = ready.limit(POOL).toArrow()
    x = matrix(pool.column("whole"))
    picked = choose(x)
    seeds = pool.column("vec_id").to_numpy()[picked], x[picked]
    pivots = raised(seeds[1], longest)

    def table(batches):
        for batch in batches:
            own = matrix(batch.column("whole"))
            away = distances(raised(own, longest), pivots)
            as_query = distances(np.hstack([own, np.zeros((len(own), 1))]), pivots)
            columns = [pa.FixedSizeListArray.from_arrays(pa.array(a.ravel()), len(pivots)).cast(pa.list_(pa.float64())) for a in (away, as_query)]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id").cast(pa.int64()), batch.column("whole"), *columns], ["vec_id", "whole", "away", "_as_query"])

    known = materialize(ready.mapInArrow(table, "vec_id long, whole array<double>, away array<double>, _as_query array<double>"))
    first = known.filter(is_query).groupBy("vec_id").agg(F.min(F.struct("whole", "_as_query")).alias("_row"))
    queries = first.select("vec_id", "_row.whole", F.col("_row._as_query").alias("away"))
    n_queries = queries.count()
    found = in_blocks(
        queries, known.drop("_as_query"), "vec_id", n_queries, n,
        lambda q, rows: search(q, rows, seeds, longest, exact, k), SCHEMA,
    )
    return best(found, k, largest=True)
