"""Operator 10: exact scores and ranks against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pomelo.llm import mtree as M
from pomelo.llm.common import prepare, table

SF = "/root/testdata/sf0.01"


def plain(rows, k=10, every=100):
    """rows of (id, list of numbers or None) -> (query_id, rank, vec_id, score)."""
    least = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        v = [int(np.floor(1024 * float(x))) for x in v]
        if i not in least or v < least[i]:
            least[i] = v
    out = []
    for q, a in least.items():
        if q % every:
            continue
        scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in least.items() if i != q)
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def test_query_on_the_test_table(spark):
    from pomelo.llm.queries import QUERIES
    got = sorted(map(tuple, QUERIES["op10_mtree_top_k"](spark, SF).collect()))
    rows = [(r.vec_id, r.embedding) for r in table(spark, SF, "embeddings").collect()]
    assert got == plain(rows)


@pytest.mark.parametrize("tree_rows, seed", [(40, 0), (100, 1), (4096, 2)])
def test_crowds_ties_odd_rows(spark, tree_rows, seed):
    prepare(spark)
    rng = np.random.default_rng(seed)
    one = rng.normal(size=6).round(2).tolist()
    rows = [(i, (rng.normal(size=6) * rng.choice([0.1, 1, 30])).tolist()) for i in range(400)]
    rows += [(i, one) for i in range(400, 700)]                       # a crowd of equal vectors
    rows += [(700, None), (800, [None] * 6), (900, [float("nan")] * 6), (901, [float("inf")] + one[1:]), (None, one),
             (1000, one[:3]), (1100, []), (1200, [0.0] * 6), rows[0], rows[0], (3, one), (500, [9.0] * 6)]
    df = spark.createDataFrame([(i, v, "c", 1) for i, v in rows], "vec_id long, embedding array<double>, cell string, rank int")
    got = sorted(map(tuple, M.top_k(df, F.col("id") % 100 == 0, tree_rows=tree_rows).collect()))
    assert got == plain(rows)


def test_triangle_bounds_skip_distances():
    rng = np.random.default_rng(5)
    centers = rng.integers(-1000, 1000, (30, 8))
    v = centers[rng.integers(0, 30, 3000)] + rng.integers(-5, 6, (3000, 8))
    norm = int((v * v).sum(1).max())
    tree = M.Tree.unpack(M.Tree.build(np.arange(3000), v, np.sqrt(norm - (v * v).sum(1))).pack())
    assert np.diff(tree.first).max() <= M.PAGE

    class Counted(np.ndarray):
        read = 0

        def __getitem__(self, key):
            Counted.read += len(key)
            return np.asarray(self)[key]

    tree.vectors = tree.vectors.view(Counted)
    for q in v[:40]:
        want = sorted((-int(s), i) for i, s in enumerate(v @ q))[:10]
        assert M.search([tree], -1, q, norm, 10, None) == [(-s, i) for s, i in want]
    assert Counted.read < 0.5 * 40 * 3000


def test_few_candidates_and_empty(spark):
    prepare(spark)
    df = spark.createDataFrame([(0, [1.0]), (7, [0.5]), (100, [-1.0])], "vec_id long, embedding array<float>")
    assert sorted(map(tuple, M.top_k(df, F.col("id") % 100 == 0).collect())) == plain([(0, [1.0]), (7, [0.5]), (100, [-1.0])])
    assert M.top_k(df.where("vec_id = 0"), F.col("id") % 100 == 0).count() == 0
    assert M.top_k(df.where("vec_id = 7"), F.col("id") % 100 == 0).count() == 0
    assert M.top_k(df.limit(0), F.col("id") % 100 == 0).count() == 0


def test_queries_go_only_to_trees_within_reach(spark, monkeypatch):
    prepare(spark)
    rng = np.random.default_rng(11)
    centers = rng.normal(size=(40, 8))
    centers /= np.linalg.norm(centers, axis=1)[:, None]
    v = centers[np.arange(4000) % 40] + rng.normal(size=(4000, 8)) * 0.003
    v /= np.linalg.norm(v, axis=1)[:, None]
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    routes, route = [], M._route

    def seen(roots, queries, n_trees, norm):
        out = route(roots, queries, n_trees, norm)
        routes.append((n_trees, queries.count(), out.selectExpr("sum(size(numbers))").first()[0]))
        return out

    monkeypatch.setattr(M, "_route", seen)
    monkeypatch.setattr(M, "GROUP_ROOTS", 16)
    monkeypatch.setattr(M, "GROUP_QUERIES", 8)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(map(tuple, M.top_k(df, F.col("id") % 20 == 0, tree_rows=50).collect()))
    assert got == plain(rows, every=20)
    [(n_trees, n_queries, visits)] = routes
    assert n_trees >= 80 and n_queries == 200
    assert visits < 0.2 * n_trees * n_queries


def test_blocks_of_queries():
    got = M._query_blocks({0: 3, 1: 2, 2: 9, 4: 1, 5: 4}, [1, 0, 2, 3, 4, 5], 4)
    assert got == [(1, 0, 1), (0, 1, 1), (2, 2, 3), (4, 5, 1), (5, 6, 1)]
    assert M._chain(np.array([[0.0], [5.0], [1.0], [3.0]])) == [0, 2, 3, 1]
