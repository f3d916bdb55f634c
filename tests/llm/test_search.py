"""Exact and approximate search against brute force."""

import numpy as np
import pytest

from searchtide.llm import graph, kdtree
from tests.helpers import bag, tuples

ASKED = "vec_id % 10 = 0"


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(1)
    points = rng.normal(size=(600, 12)).astype(np.float32)
    points[200:320] = points[200]  # one vector many times
    rows = [(i, [float(x) for x in p]) for i, p in enumerate(points)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").cache()


def points_of(vectors):
    rows = sorted(tuples(vectors, "vec_id", "embedding"))
    return np.array([r[0] for r in rows]), np.array([r[1] for r in rows], dtype=np.float64)


def test_top_k(vectors):
    ids, points = points_of(vectors)
    whole = np.floor(points * 1024)
    wanted = []
    for i in range(0, 600, 10):
        scores = whole @ whole[i]
        order = [j for j in np.lexsort((ids, -scores)) if j != i][:10]
        wanted += [(i, rank, int(ids[j]), int(scores[j])) for rank, j in enumerate(order, 1)]
    found = kdtree.top_k(vectors, ASKED, shard_rows=128, leaf_size=8)
    assert bag(found, "query_id", "rank", "vec_id", "score") == sorted(wanted, key=repr)


def test_tree_boxes_are_tight_and_halves_even():
    rng = np.random.default_rng(2)
    points = rng.integers(-50, 50, (257, 5)).astype(float)
    tree = kdtree.build(points, np.arange(257), 16)
    for node, (start, stop) in enumerate(tree.spans):
        inside = tree.points[start:stop]
        assert (tree.low[node] == inside.min(axis=0)).all() and (tree.high[node] == inside.max(axis=0)).all()
        if tree.children[node]:
            sizes = [tree.spans[c][1] - tree.spans[c][0] for c in tree.children[node]]
            assert abs(sizes[0] - sizes[1]) <= 1
    query = rng.integers(-50, 50, (1, 5)).astype(float)
    reach = kdtree.bounds(tree, query)[0]
    for node, (start, stop) in enumerate(tree.spans):
        assert (tree.points[start:stop] @ query[0]).max() <= reach[node]


def test_numbers_beyond_floats_stay_exact():
    big = np.array([[2.0**40, 1.0], [2.0**40, 2.0]])
    whole = kdtree.as_integers(big)
    assert (whole @ whole[0])[1] - (whole @ whole[0])[0] == 1024 * 1024


def brute_scores(points, ids, asked, k=10):
    """Scores in integers of any size."""
    whole = [[int(np.floor(x * 1024.0)) for x in p] for p in points]
    wanted = []
    for i in asked:
        scores = [(-sum(a * b for a, b in zip(whole[i], w, strict=True)), j) for j, w in zip(ids, whole, strict=True)]
        best = sorted(s for s in scores if s[1] != ids[i])[:k]
        wanted += [(ids[i], rank, j, -minus) for rank, (minus, j) in enumerate(best, 1)]
    return sorted(wanted, key=repr)


def test_large_queries_and_large_points_are_exact(spark):
    """A query beyond what doubles hold exactly, among shards that are small, and the other way round."""
    rng = np.random.default_rng(4)
    points = rng.normal(size=(90, 6))
    points[[0, 10, 33]] *= 2.0**18
    points[20] *= 1e-3
    rows = [(i, [float(x) for x in p]) for i, p in enumerate(points)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = kdtree.top_k(table, ASKED, shard_rows=16, leaf_size=4)
    assert bag(found, "query_id", "rank", "vec_id", "score") == brute_scores(points, range(90), range(0, 90, 10))


def test_queries_stream_past_a_shard_in_batches(spark, vectors):
    """Small batches split vectors and queries of a shard anywhere; the results stay the same."""
    exact = bag(kdtree.top_k(vectors, ASKED, shard_rows=128, leaf_size=8))
    near = bag(graph.nearest(vectors, ASKED, shard_rows=128))
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "7")
    try:
        assert bag(kdtree.top_k(vectors, ASKED, shard_rows=128, leaf_size=8)) == exact
        assert bag(graph.nearest(vectors, ASKED, shard_rows=128)) == near
    finally:
        spark.conf.set(name, before)


def test_other_columns_and_lengths(spark):
    """Clashing names are left aside; vectors of another length are searched among their own."""
    rng = np.random.default_rng(5)
    points = [[float(x) for x in rng.normal(size=3 if i % 2 else 4)] for i in range(60)]
    rows = [(i, p, "a", 1, 2.0, False) for i, p in enumerate(points)]
    wide = "vec_id long, embedding array<double>, shard string, dim int, floor double, asks boolean"
    table = spark.createDataFrame(rows, wide)
    plain = table.select("vec_id", "embedding")
    for search in (kdtree.top_k, graph.nearest):
        found = search(table, ASKED, shard_rows=16)
        assert bag(found) == bag(search(plain, ASKED, shard_rows=16))
        assert {(q % 2, v % 2) for q, v in tuples(found, "query_id", "vec_id")} == {(0, 0)}


def test_recall_and_distances(vectors):
    ids, points = points_of(vectors)
    found = graph.nearest(vectors, ASKED, shard_rows=256)
    rows = tuples(found, "query_id", "rank", "vec_id", "score")
    hits = 0
    for i in range(0, 600, 10):
        away = np.sqrt(((points - points[i]) ** 2).sum(axis=1))
        best = [int(ids[j]) for j in np.lexsort((ids, away)) if j != i][:10]
        own = sorted(r[1:] for r in rows if r[0] == i)
        assert [r[0] for r in own] == list(range(1, 11))
        assert [r[2] for r in own] == sorted(r[2] for r in own)
        for _, j, score in own:
            assert score == pytest.approx(away[j], rel=1e-12, abs=1e-300)
        hits += len({r[1] for r in own} & set(best))
    assert hits / 600 >= 0.9


def test_every_row_is_in_a_graph():
    rng = np.random.default_rng(3)
    points = rng.normal(size=(700, 16))
    made = graph.Graph(points, degree=16, beam=32, alpha=1.2)
    near, _ = made.beam_search(points.astype(np.float32), 32)
    assert (near[:, 0] == np.arange(700)).mean() > 0.99
    assert ((made.edges >= 0).sum(axis=1) > 0).all() and (made.edges != np.arange(700)[:, None]).all()
