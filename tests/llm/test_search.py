"""Vector searches against brute force."""

import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from murmur.llm import mih, pivots

SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.fixture(scope="module")
def vectors(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


@pytest.fixture(scope="module")
def odd_vectors(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [float(x) for x in rng.standard_normal(5)], i) for i in range(40)]
    same = [0.5, -0.25, 0.0, 1.0, 2.0]
    rows += [(100 + i, same, None) for i in range(60)] + [(200, same, 1), (200, same, 1)]
    rows += [(300, None, 1), (301, [0.0] * 5, 1), (302, [1.0, None, 0.0, 0.0, 0.0], 1), (303, [1.0, math.nan, 0.0, 0.0, 0.0], 1)]
    rows += [(304, [math.inf] + [0.0] * 4, 1), (305, [], 1), (306, [1.0, 2.0], 1), (None, same, 1)]
    return spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit("x")).withColumn("_block", F.lit("x"))


def usable(rows, zero):
    out = []
    for r in rows:
        v = r.embedding
        if r.vec_id is not None and v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v):
            if zero or any(v):
                out.append((r.vec_id, v))
    width = max({len(v) for _, v in out}, key=lambda n: sum(len(v) == n for _, v in out))
    return [(i, np.array(v, float)) for i, v in out if len(v) == width]


def by_query(found):
    out = defaultdict(list)
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        out[r.query_id].append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_nearest_recall(vectors):
    own = usable(vectors.collect(), zero=False)
    found = by_query(mih.nearest(vectors, F.col("vec_id") % 5 == 0).collect())
    assert set(found) == {i for i, _ in own if i % 5 == 0}
    hit = 0
    ids, x = np.array([i for i, _ in own]), np.array([v for _, v in own])
    for i, near in found.items():
        distance = np.sqrt(((x - x[ids == i][0]) ** 2).sum(1))
        order = [k for k in np.lexsort((ids, distance)) if ids[k] != i][:10]
        hit += len({ids[k] for k in order} & {v for v, _ in near})
        assert len(near) == 10
        for (v, s), (w, t) in zip(near, near[1:]):
            assert (s, v) < (t, w)
        for v, s in near:
            assert s == pytest.approx(distance[ids == v][0], abs=1e-12)
    assert hit / (10 * len(found)) >= 0.9


def test_probing_finds_every_code_within_the_radius():
    rng = np.random.default_rng(1)
    parts = rng.integers(0, 1 << mih.WIDTH, (500, mih.PARTS))
    parts[:300] = parts[0] ^ (rng.random((300, mih.PARTS)) < 0.3) * (1 << rng.integers(0, mih.WIDTH, (300, mih.PARTS)))
    index = mih.Index(parts)
    for radius in (0, 1, 3, mih.PARTS - 1, mih.PARTS, 25, 60, mih.BITS):
        for q in (0, 7, 400):
            want = np.flatnonzero(mih.apart(parts, parts[q]) <= radius)
            assert index.within(parts[q], radius).tolist() == want.tolist()


def test_nearest_of_odd_vectors(odd_vectors):
    own = usable(odd_vectors.collect(), zero=False)
    found = by_query(mih.nearest(odd_vectors, F.col("vec_id") % 100 == 0).collect())
    assert set(found) == {0, 100, 200}
    # All copies of the query at distance 0, the smaller ids first.
    assert found[100] == [(101 + i, 0.0) for i in range(10)]
    assert [v for v, _ in found[200]] == list(range(100, 110))
    assert len(found[0]) == 10 and {v for v, _ in found[0]} <= {i for i, _ in own}


def test_fewer_than_wanted_are_all_found(spark):
    rows = [(i, [float(i), 1.0, -float(i * i)], 0) for i in range(6)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = by_query(mih.nearest(df, F.col("vec_id") % 2 == 0).collect())
    assert {k: len(v) for k, v in found.items()} == {0: 5, 2: 5, 4: 5}
    for fn in (mih.nearest, pivots.largest_products):
        assert fn(df.limit(0), F.col("vec_id") % 2 == 0).count() == 0
        assert fn(df.filter("vec_id = 2"), F.col("vec_id") % 2 == 0).count() == 0
        assert fn(df, F.col("vec_id") < 0).count() == 0


def plain_products(own, is_query, k=5):
    whole = [(i, [math.floor(256 * float(c)) for c in v]) for i, v in own]
    out = {}
    for i, q in {i: q for i, q in whole if is_query(i)}.items():
        scores = [(-sum(a * b for a, b in zip(q, x)), j) for j, x in whole if j != i]
        out[i] = [(j, -s) for s, j in sorted(scores)[:k]]
    return out


def test_products_are_exact(vectors, odd_vectors, monkeypatch):
    monkeypatch.setattr(pivots, "STEP", 32)
    for df, step in ((vectors, 10), (odd_vectors, 50)):
        found = by_query(pivots.largest_products(df, F.col("vec_id") % step == 0).collect())
        assert dict(found) == plain_products(usable(df.collect(), zero=True), lambda i: i % step == 0)


def test_products_of_large_and_clustered_numbers(spark):
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((5, 8)) * 1000
    rows = [(i, [float(c) for c in np.float32(centres[i % 5] + rng.standard_normal(8))], 0) for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert dict(by_query(pivots.largest_products(df, F.col("vec_id") % 50 == 0).collect())) == plain_products(usable(df.collect(), True), lambda i: i % 50 == 0)
    rows = [(i, [float(np.float32(x)) for x in rng.standard_normal(4) * 1e6], 0) for i in range(60)]
    df = spark.createDataFrame(rows, SCHEMA)
    want = plain_products(usable(df.collect(), True), lambda i: i % 20 == 0)
    assert dict(by_query(pivots.largest_products(df, F.col("vec_id") % 20 == 0).collect())) == want


def test_blocks_and_shards_change_nothing(vectors, monkeypatch):
    from murmur.llm import vectors as v

    is_query = F.col("vec_id") % 50 == 0
    one = [pivots.largest_products(vectors, is_query).collect(), mih.nearest(vectors, is_query).collect()]
    monkeypatch.setattr(v, "SHARD", 60)
    monkeypatch.setattr(v, "BLOCK", 3)
    many = [pivots.largest_products(vectors, is_query).collect(), mih.nearest(vectors, is_query).collect()]
    for a, b in zip(one, many):
        assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_one_id_on_a_third_of_all_rows(spark, monkeypatch):
    """Repeated ids are rows of their own, equal or not, and no shard holds them all."""
    from murmur.llm import vectors as v

    rng = np.random.default_rng(5)
    vector = lambda: [float(np.float32(x)) for x in rng.standard_normal(8)]
    same = vector()
    rows = [(i, vector(), 0) for i in range(400)] + [(7, vector(), 0) for _ in range(120)] + [(7, same, 0)] * 120
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    monkeypatch.setattr(v, "SHARD", 64)
    found = by_query(pivots.largest_products(df, F.col("vec_id") % 100 == 0).collect())
    assert dict(found) == plain_products(usable(df.collect(), True), lambda i: i % 100 == 0)
    near = mih.nearest(df, F.col("vec_id") % 100 == 0).collect()
    assert len(near) == 40 and all(r.vec_id != r.query_id for r in near)
    queries = df.filter("vec_id = 0")
    sizes = v.in_blocks(queries, df.select("vec_id", "embedding"), "vec_id", 1, len(rows), lambda q, x: pa.table({"n": [x.num_rows]}), "n long").collect()
    assert sum(r.n for r in sizes) == len(rows) and max(r.n for r in sizes) < 3 * 64
    sample = v.sample_of(df, "vec_id", "embedding", 10, 1000, 1)
    assert sample.num_rows == 521
