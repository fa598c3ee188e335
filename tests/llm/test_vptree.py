import numpy as np
from cases import given

from tripkpi.llm import vptree


def brute(ids, vectors, every, k):
    found = {}
    for i, x in zip(ids, vectors, strict=True):
        if i % every == 0:
            far = vptree.distances(x[None], vectors)[0]
            order = sorted((f, j) for f, j in zip(far, ids, strict=True) if j != i)
            found[i] = [(j, f) for f, j in order[:k]]
    return found


def brute_rows(rows, every, k):
    """As brute, but each row is a candidate of its own: lists of distances by query id, sorted."""
    found = {}
    for i, (id_, x) in enumerate(rows):
        if id_ % every == 0:
            far = vptree.distances(np.array([x], float), np.array([v for _, v in rows], float))[0]
            order = sorted((f, rows[j][0]) for j, f in enumerate(far) if j != i)
            found.setdefault(id_, []).append([(j, f) for f, j in order[:k]])
    return {q: sorted(lists) for q, lists in found.items()}


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank string, score string")


def by_query(result):
    found = {}
    for r in result.orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return found


def test_factor_one_is_exact_with_ties_and_one_frequent_vector(spark):
    random = np.random.default_rng(1)
    vectors = random.normal(size=(400, 8)).astype(np.float32)
    vectors[::3] = vectors[0]
    rows = [(i, v.tolist(), "x", "x") for i, v in enumerate(vectors)]
    got = by_query(vptree.nearest(table(spark, rows), every=10, shard_rows=90, block_queries=7))
    assert got == brute(range(400), vectors.astype(float), 10, 10)


def test_recall_falls_with_the_factor(spark):
    vectors = given(spark, "embeddings", "sf0.01")
    exact = by_query(vptree.nearest(vectors, every=10))

    def recall(relax):
        loose = by_query(vptree.nearest(vectors, every=10, relax=relax, shard_rows=10_000))
        hits = sum(len({i for i, _ in loose[q]} & {i for i, _ in exact[q]}) for q in exact)
        return hits / sum(map(len, exact.values()))

    assert recall(1.0) == 1.0
    assert recall(1.5) >= 0.9
    assert recall(50.0) < 1.0


def test_rows_of_all_kinds(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], "x", "x"), (100, [0.0, 1.0], "x", "x"), (3, [1.0, 1.0], "x", "x"),
        (3, [1.0, 0.5], "x", "x"), (4, None, "x", "x"), (5, [0.0, 0.0], "x", "x"),
        (6, [nan, 1.0], "x", "x"), (7, [inf, 1.0], "x", "x"), (8, [None, 1.0], "x", "x"),
        (None, [1.0, 2.0], "x", "x"), (200, [1.0, 2.0, 3.0], "x", "x"), (9, [], "x", "x"),
    ]
    got = by_query(vptree.nearest(table(spark, rows)))
    assert {q: [i for i, _ in v] for q, v in got.items()} == {0: [3, 3, 100], 100: [3, 3, 0]}
    assert vptree.nearest(table(spark, rows).limit(0)).count() == 0


def test_rows_that_share_an_id_are_candidates_and_queries_each(spark):
    random = np.random.default_rng(5)
    base = random.normal(size=(60, 4)).astype(np.float32).tolist()
    rows = [(i % 25, v) for i, v in enumerate(base)] + [(0, base[0])] * 14 + [(7, base[3])] * 2
    given_rows = [(i, v, "x", "x") for i, v in rows]
    result = vptree.nearest(table(spark, given_rows), every=5, shard_rows=11, block_queries=3)
    got = {}
    for r in result.collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    expected = brute_rows(rows, 5, 10)
    for q, lists in expected.items():
        assert sorted(got.pop(q)) == sorted((n, j, f) for each in lists for n, (j, f) in enumerate(each, 1))
    assert not got


def test_far_cells_are_not_visited_and_nothing_is_lost(spark):
    random = np.random.default_rng(6)
    middles = random.normal(size=(12, 6)) * 50
    rows = [(i, (middles[i % 12] + random.normal(size=6)).astype(np.float32).tolist()) for i in range(600)]
    rows += [(1000 + i, rows[0][1]) for i in range(200)]  # one frequent vector: a cell of several shards
    given_rows = [(i, v, "x", "x") for i, v in rows]
    got = by_query(vptree.nearest(table(spark, given_rows), every=10, shard_rows=25, block_queries=16))
    ids, vectors = [i for i, _ in rows], np.array([v for _, v in rows], float)
    assert got == brute(ids, vectors, 10, 10)
    cells = vptree.Cells([rows[i][1] for i in range(12)])
    cell, reach = cells.place(vectors)
    cells.spans = {(6, c): (reach[cell == c].min(), reach[cell == c].max()) for c in set(cell.tolist())}
    visited = cells.visited(vectors, np.full(len(vectors), 5.0), 1.0)
    assert np.mean([len(v) for v in visited]) < 2
    assert all(c in v for c, v in zip(cell, visited, strict=True))
