"""Operator 1: approximate nearest neighbours by multi-index hashing.

Vectors become binary codes: signs after rotations that are learned on a bounded sample
so that signs lose little (iterative quantization, several rotations for long codes).
A code is split into substrings and each substring is indexed, in every shard of rows.
By the pigeonhole principle a code within ``radius`` of a query is near it in some
substring, where the substrings' radii add up to ``radius`` less their number plus one;
so probing all values within them retrieves every code within the radius. Those are then
ranked by their exact distance on the original vectors.

The radius is the one that holds ``RECALL`` of true neighbours in the sample; in all
rows neighbours are nearer, so recall is higher. A query that finds fewer than it should
is searched again with the radius at its largest, which is every row.

Defined results: vectors that are null, zero, or hold null or non-finite components, or
have another length than most, take no part, nor do rows without a key; rows with a
query's own key are not its neighbours; repeated rows are neighbours of their own; a
repeated query is searched once, with the first of its vectors; empty tables find none.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from murmur.llm.frames import ranges
from murmur.llm.vectors import best, in_blocks, matrix, sample_of, taking_part
from murmur.session import materialize

TOP = 10
PARTS, WIDTH = 10, 13
BITS = PARTS * WIDTH
#: Rows on which codes are learned, queries among them for the radius, and share of neighbours.
FIT, TRIED, RECALL = 8192, 256, 0.95
TURNS = 30
SCHEMA = "query_id long, vec_id long, score double"


@dataclass
class Codes:
    mean: np.ndarray
    rotation: np.ndarray

    def parts(self, rows: np.ndarray) -> np.ndarray:
        """(rows, PARTS): the substrings of each code as numbers."""
        bits = ((rows - self.mean) @ self.rotation > 0).reshape(len(rows), PARTS, WIDTH)
        return (bits * (1 << np.arange(WIDTH))).sum(2).astype(np.int64)


def learn(rows: np.ndarray, seed: int = 0) -> Codes:
    """Rotations by iterative quantization."""
    rng = np.random.default_rng(seed)
    mean = rows.mean(0) if len(rows) else np.zeros(rows.shape[1])
    centred = rows - mean
    made: list[np.ndarray] = []
    while sum(r.shape[1] for r in made) < BITS:
        width = min(rows.shape[1], BITS - sum(r.shape[1] for r in made))
        # Principal directions, so that a short code takes those that matter most.
        _, _, axes = np.linalg.svd(centred.T @ centred)
        axes = axes[:width].T
        flat = centred @ axes
        turn = np.linalg.qr(rng.standard_normal((width, width)))[0]
        for _ in range(TURNS):
            left, _, right = np.linalg.svd(np.where(flat @ turn > 0, 1.0, -1.0).T @ flat)
            turn = right.T @ left.T
        made.append(axes @ turn)
    return Codes(mean, np.hstack(made))


def apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of codes given as substrings."""
    return np.bitwise_count(a ^ b).sum(-1, dtype=np.int64)


def usual_radius(codes: Codes, rows: np.ndarray, k: int = TOP) -> int:
    """The radius that holds ``RECALL`` of the ``k`` nearest among ``rows``."""
    if len(rows) < 2:
        return BITS
    parts, seen = codes.parts(rows), []
    for i in np.linspace(0, len(rows) - 1, min(TRIED, len(rows))).astype(int):
        distance = ((rows - rows[i]) ** 2).sum(1)
        distance[i] = np.inf
        near = np.argsort(distance, kind="stable")[: min(k, len(rows) - 1)]
        seen.append(apart(parts[near], parts[i]))
    return int(np.ceil(np.quantile(np.concatenate(seen), RECALL)))


@lru_cache(None)
def flips(radius: int) -> np.ndarray:
    """All substring values within ``radius`` of zero."""
    out = [0]
    for n in range(1, min(radius, WIDTH) + 1):
        out += [sum(1 << i for i in c) for c in combinations(range(WIDTH), n)]
    return np.array(out, np.int64)


def part_radii(radius: int) -> list[int]:
    """Radii of the substrings; -1 is none at all."""
    total = radius - PARTS + 1
    return [min(WIDTH, total // PARTS + (i < total % PARTS)) for i in range(PARTS)] if total >= 0 else [0] * (radius + 1) + [-1] * (PARTS - radius - 1)


class Index:
    """Substrings of one shard's codes: for each value the rows that have it."""

    def __init__(self, parts: np.ndarray):
        self.parts = parts
        self.order = [np.argsort(parts[:, p], kind="stable") for p in range(PARTS)]
        self.start = [np.searchsorted(parts[o, p], np.arange((1 << WIDTH) + 1)) for p, o in enumerate(self.order)]

    def within(self, query: np.ndarray, radius: int) -> np.ndarray:
        """Rows whose code is within ``radius`` of the query's."""
        seen = np.zeros(len(self.parts), bool)
        for p, own in enumerate(part_radii(radius)):
            if own < 0:
                continue
            values = flips(own) ^ query[p]
            start = self.start[p][values]
            seen[self.order[p][ranges(start, self.start[p][values + 1] - start)]] = True
        found = np.flatnonzero(seen)
        return found[apart(self.parts[found], query) <= radius]


def search(queries: pa.Table, rows: pa.Table, codes: Codes, radius: int, k: int) -> pa.Table:
    ids, x = rows.column("vec_id").to_numpy(), matrix(rows.column("embedding"))
    own, q = queries.column("vec_id").to_numpy(), matrix(queries.column("embedding"))
    index, probes = Index(codes.parts(x)), codes.parts(q)
    of, found, score = [], [], []
    for i in range(len(q)):
        near = index.within(probes[i], radius)
        near = near[ids[near] != own[i]]
        distance = np.sqrt(((x[near] - q[i]) ** 2).sum(1))
        top = np.lexsort((ids[near], distance))[:k]
        of.append(np.full(len(top), own[i]))
        found.append(ids[near[top]])
        score.append(distance[top])
    return pa.table({"query_id": np.concatenate(of), "vec_id": np.concatenate(found), "score": np.concatenate(score)})


def nearest(rows: DataFrame, is_query, k: int = TOP) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row where ``is_query`` its ``k`` nearest
    others found, of columns vec_id and embedding."""
    rows = materialize(taking_part(rows, "vec_id", "embedding", zero=False))
    queries = rows.filter(is_query).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    n, n_queries = rows.count(), queries.count()
    if not n_queries:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    fitted = matrix(sample_of(rows, "vec_id", "embedding", n, FIT, 11).column("embedding"))
    if not len(fitted):
        fitted = matrix(rows.limit(FIT).toArrow().column("embedding"))
    codes = learn(fitted)
    radius = usual_radius(codes, fitted, k)
    first = materialize(best(in_blocks(queries, rows, "vec_id", n_queries, n, lambda q, x: search(q, x, codes, radius, k), SCHEMA), k, largest=False))
    full = first.groupBy(F.col("query_id").alias("vec_id")).count().filter(F.col("count") >= k)
    short = materialize(queries.join(full, "vec_id", "left_anti"))
    n_short = short.count()
    if not n_short:
        return first
    wide = best(in_blocks(short, rows, "vec_id", n_short, n, lambda q, x: search(q, x, codes, BITS, k), SCHEMA), k, largest=False)
    return first.join(short.select(F.col("vec_id").alias("query_id")), "query_id", "left_anti").unionByName(wide)
