"""Neighbours against brute force."""

import numpy as np
from pyspark.sql import functions as F

from tillmart.llm import permutation_index


def brute(ids, vectors, k=20):
    found = {}
    for n, query in enumerate(ids):
        if query % 20 == 0:
            score = (vectors * vectors[n]).sum(axis=1)
            order = [m for m in np.lexsort((ids, -score)) if m != n][:k]
            found[int(query)] = [int(ids[m]) for m in order]
    return found


def test_recall(spark):
    frame = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = frame.collect()
    wanted = brute(np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], np.float64))
    found = permutation_index.nearest(spark, frame, frame.where("vec_id % 20 = 0")).collect()
    got = {}
    vectors = {r.vec_id: np.array(r.embedding, np.float64) for r in rows}
    for row in sorted(found, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(row.query_id, []).append(row.vec_id)
        assert abs(row.score - float(vectors[row.query_id] @ vectors[row.vec_id])) < 1e-12
    assert got.keys() == wanted.keys() and all(len(set(v)) == 20 for v in got.values())
    assert np.mean([len(set(got[q]) & set(wanted[q])) / 20 for q in wanted]) >= 0.9


def test_ties_and_unusable_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(n, [1.0, 0.0]) for n in range(600)] + [(n, [0.5, float(n)]) for n in range(600, 620)]
    rows += [(1000, None), (1020, []), (1040, [0.0, 0.0]), (1060, [1.0, None]), (1080, [nan, 1.0]), (1100, [inf, 1.0]), (None, [1.0, 1.0])]
    rows += [(1120, [1.0, 1.0, 1.0]), (0, [1.0, 0.0]), (0, [1.0, 0.0])]
    frame = spark.createDataFrame([(i, v, 1.0) for i, v in rows], "vec_id bigint, embedding array<float>, score double")
    found = permutation_index.nearest(spark, frame, frame.where("vec_id % 20 = 0")).collect()
    by_query = {}
    for row in sorted(found, key=lambda r: (r.query_id, r.rank)):
        by_query.setdefault(row.query_id, []).append((row.rank, row.vec_id, row.score))
    assert set(by_query) == set(range(0, 620, 20))
    for query in range(0, 600, 20):
        ids = [n for n in range(600) if n != query][:20]
        assert by_query[query] == [(n + 1, i, 1.0) for n, i in enumerate(ids)]


def test_small_and_empty_tables(spark):
    frame = spark.createDataFrame([(0, [1.0]), (20, [2.0]), (3, [-1.0])], "vec_id bigint, embedding array<double>")
    found = sorted(tuple(r) for r in permutation_index.nearest(spark, frame, frame.where("vec_id % 20 = 0")).collect())
    assert found == [(0, 1, 20, 2.0), (0, 2, 3, -1.0), (20, 1, 0, 2.0), (20, 2, 3, -2.0)]
    empty = frame.limit(0)
    assert permutation_index.nearest(spark, empty, empty).collect() == []
    assert permutation_index.nearest(spark, frame, empty).collect() == []


def test_repeated_ids(spark):
    """Copies of one vec_id neither fill the sample nor hold it empty, and of different vectors the smallest counts."""
    draw = np.random.default_rng(4)
    vectors = draw.normal(size=(1500, 16)).astype(np.float32)
    low = spark.range(1500).orderBy(F.xxhash64("id")).first()[0]  # the id that a sample has first
    rows = [(n, v.tolist()) for n, v in enumerate(vectors)] + [(low, vectors[low].tolist())] * 6000
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    wanted = brute(np.arange(1500), vectors.astype(np.float64))
    got = {}
    for row in permutation_index.nearest(spark, frame, frame.where("vec_id % 20 = 0"), sample=1000).collect():
        got.setdefault(row.query_id, set()).add(row.vec_id)
    assert got.keys() == wanted.keys() and np.mean([len(got[q] & set(wanted[q])) / 20 for q in wanted]) >= 0.75

    few = spark.createDataFrame([(0, [1.0, 2.0]), (1, [2.0, 1.0]), (1, [1.0, 5.0])] * 4000, "vec_id bigint, embedding array<double>")
    found = permutation_index.nearest(spark, few, few.where("vec_id = 0"), sample=50).collect()
    assert [(r.vec_id, r.score) for r in found] == [(1, 11.0)]


def recall(spark, frame, wanted, **settings):
    got = {}
    for row in permutation_index.nearest(spark, frame, frame.where("vec_id % 20 = 0"), **settings).collect():
        got.setdefault(row.query_id, []).append(row.vec_id)
    assert got.keys() == wanted.keys() and all(len(set(v)) == len(v) == 20 for v in got.values())
    return np.mean([len(set(got[q]) & set(wanted[q])) / 20 for q in wanted])


def test_many_blocks(spark):
    """The best of several blocks are merged; all vectors reranked give the brute-force result."""
    frame = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = frame.collect()
    wanted = brute(np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], np.float64))
    assert recall(spark, frame, wanted, block=150, reranked=len(rows)) == 1.0
    found = recall(spark, frame, wanted, block=150)
    print(f"recall over 14 blocks: {found:.3f}")
    assert found >= 0.9


def test_ten_times_the_rows(spark):
    """A query's reranked vectors grow at most fourfold, and the recall holds without any structure in the vectors."""

    def reranked(size):
        blocks = -(-size // permutation_index.block_for(size))
        share = permutation_index.reranked_for(size) / blocks
        return blocks * (share + share**0.5 if blocks > 1 else share)

    assert reranked(20_000) <= 4 * reranked(2_000) and reranked(20_000_000) <= 4 * reranked(2_000_000)
    draw = np.random.default_rng(8).normal(size=(20_000, 64)).astype(np.float32)
    draw /= np.linalg.norm(draw, axis=1)[:, None]
    frame = spark.createDataFrame([(n, v.tolist()) for n, v in enumerate(draw)], "vec_id bigint, embedding array<float>").where("true")
    asked = list(range(0, 20_000, 200))
    exact = draw.astype(np.float64)
    wanted = {}
    for query in asked:
        score = exact @ exact[query]
        score[query] = -np.inf
        wanted[query] = np.argsort(-score, kind="stable")[:20].tolist()
    got = {}
    for row in permutation_index.nearest(spark, frame, frame.where("vec_id % 200 = 0")).collect():
        got.setdefault(row.query_id, set()).add(row.vec_id)
    found = np.mean([len(got[q] & set(wanted[q])) / 20 for q in asked])
    print(f"recall over 20,000 vectors, {reranked(20_000):.0f} reranked: {found:.3f}")
    assert found >= 0.9


def test_each_vector_goes_to_one_block(spark):
    """Only queries are copied."""
    frame = spark.createDataFrame([(n, [1.0, float(n)]) for n in range(3000)], "vec_id bigint, embedding array<double>")
    plan = permutation_index.nearest(spark, frame, frame.where("vec_id % 20 = 0"), block=300)._jdf.queryExecution().toString()
    assert plan.count("explode(sequence") >= 1 and "CoGroup" not in plan and "Join" not in plan


def test_footrule():
    """Distances from the postings differ from sums over all pivots by one number for all rows."""
    draw = np.random.default_rng(3)
    pivots = permutation_index.Pivots(draw.normal(size=(100, 5)))
    vectors, query = draw.normal(size=(300, 5)), draw.normal(size=(1, 5))
    index = permutation_index.BlockIndex(np.arange(300), vectors, pivots, 300, 300)

    def places(order):
        found = np.full(100, len(order))
        found[order] = np.arange(len(order))
        return found

    order = pivots.orders(query)[0]
    wanted = [int(np.abs(places(own) - places(order)).sum()) for own in pivots.orders(vectors)]
    assert len(set((index.footrule(order) - wanted).tolist())) == 1 and len(set(wanted)) > 100
