"""Pivot-cell top-k: equal to scoring every pair, skips most of them on grouped data."""
import numpy as np
import pytest

from lakelens.operators import vectors


def brute(items, queries, k):
    ok = lambda v: v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
    good = [(i, np.array(v, float)) for i, v in items if ok(v)]
    x, ids = np.vstack([v for _, v in good]), np.array([i for i, _ in good])
    out = []
    for qid, v in queries:
        if ok(v):
            near, score = vectors.best_of(x, ids, np.array(v, float), k)
            out += [(qid, int(ids[i]), r + 1) for r, i in enumerate(near)]
    return sorted(out, key=str)


def frames(spark, items, queries):
    return (spark.createDataFrame(items, "vec_id long, embedding array<double>").repartition(3),
            spark.createDataFrame(queries, "query_id long, query_vec array<double>"))


def clustered(n, seed, groups=20, dim=16):
    rng = np.random.default_rng(seed)
    centre = np.random.default_rng(9).normal(size=(groups, dim))
    return [(int(i), (centre[i % groups] + rng.normal(size=dim) * 0.05).tolist()) for i in range(n)]


@pytest.mark.parametrize("cell_rows, query_rows", [(20_000, 2_000), (30, 7)])
def test_equals_every_pair(spark, cell_rows, query_rows):
    rng = np.random.default_rng(1)
    items = clustered(400, 1) + [(1000 + i, rng.normal(size=16).tolist()) for i in range(200)]
    items += [(2000 + i, items[3][1]) for i in range(40)]                   # ties
    items += [(3000, None), (3001, []), (3002, [0.0] * 16), (3003, [None] + [1.0] * 15), (3004, [float("nan")] * 16)]
    queries = [(i, v) for i, v in clustered(30, 2)] + [(50, items[3][1]), (51, None), (52, [0.0] * 16)]
    it, qu = frames(spark, items, queries)
    got = vectors.pivot_top_k(it, qu, 7, cell_rows=cell_rows, query_rows=query_rows)
    rows = sorted(((r["query_id"], r["vec_id"], r["rank"]) for r in got.collect()), key=str)
    assert rows == brute(items, queries, 7)


def test_most_pairs_are_never_scored(spark, monkeypatch):
    import lakelens.session as session
    real, seen = session.stage_table, []
    monkeypatch.setattr(session, "stage_table", lambda df, name: seen.append((name, real(df, name))) or seen[-1][1])
    items, queries = clustered(3000, 3), clustered(100, 4)
    it, qu = frames(spark, items, queries)
    got = vectors.pivot_top_k(it, qu, 5, pivots=60)
    assert sorted(((r["query_id"], r["vec_id"], r["rank"]) for r in got.collect()), key=str) == brute(items, queries, 5)
    count = {r["__cell"]: r["count"] for n, d in seen if n == "vector-cells" for r in d.groupBy("__cell").count().collect()}
    scored = sum(count[r["__cell"]] for n, d in seen if n == "vector-pairs" for r in d.collect())
    assert scored < 3000 * 100 / 5


def test_fewer_items_than_k_and_empty_tables(spark):
    it, qu = frames(spark, [(1, [1.0, 0.0]), (2, [0.0, 2.0])], [(7, [1.0, 1.0]), (7, [1.0, 0.0])])
    got = sorted((r["query_id"], r["vec_id"], r["rank"]) for r in vectors.pivot_top_k(it, qu, 5).collect())
    assert got == [(7, 1, 1), (7, 1, 1), (7, 2, 2), (7, 2, 2)]
    none, noq = frames(spark, [], [])
    assert vectors.pivot_top_k(none, qu, 5).count() == 0
    assert vectors.pivot_top_k(it, noq, 5).count() == 0
