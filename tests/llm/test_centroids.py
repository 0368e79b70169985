"""Centroid clustering: equal to plain Lloyd rounds in DuckDB, valid bounds, edge rows."""
import duckdb
import numpy as np
import pytest

from lakelens.llm import centroids

SCHEMA = "vec_id long, embedding array<float>, label int, _id string, _v string, _c int, _scanned string"


def sql(rows, **kw):
    con = duckdb.connect()
    con.execute("create table embeddings (vec_id bigint, embedding float[])")
    con.executemany("insert into embeddings values (?, ?)", rows)
    return sorted(con.execute(centroids.oracle_sql(**kw)).fetchall(), key=str)


def ours(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, 0, "x", "y", 1, "z") for i, v in rows], SCHEMA)
    return centroids.cluster(df, **kw)


def test_equals_plain_rounds_on_edge_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=64).round(2).tolist()) for i in range(300)]
    rows += [(5, rows[7][1]), (5, rows[7][1])] + [(1000 + i, rows[9][1]) for i in range(200)]     # repeats, ties
    rows += [(None, rows[11][1]), (2000, None), (2001, []), (2002, [0.5] * 63), (2003, [0.5] * 65),
             (2004, [None] + [0.5] * 63), (2005, [float("nan")] * 64), (2006, [float("inf")] + [0.0] * 63),
             (2007, [0.0] * 64)]
    got = sorted((tuple(r) for r in ours(spark, rows).drop("scans").collect()), key=str)
    assert got == sql(rows)
    assert len(got) == 300 + 2 + 200 + 1 + 1


def test_few_or_no_vectors(spark):
    assert ours(spark, []).count() == 0
    assert ours(spark, [(1, None), (2, [1.0])]).count() == 0
    rows = [(1, [0.5] * 64), (2, [0.25] * 64), (3, [0.5] * 64)]
    assert sorted((tuple(r) for r in ours(spark, rows).drop("scans").collect()), key=str) == sql(rows)


def test_wide_components_stay_exact(spark):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.normal(size=64) * 300_000).tolist()) for i in range(60)]
    got = sorted((tuple(r) for r in ours(spark, rows).drop("scans").collect()), key=str)
    v = [np.floor(np.array(x, dtype=np.float32).astype(float) * 64).astype(np.int64).astype(object) for _, x in rows]
    from hashlib import sha256
    c = [v[i] for i in sorted(range(60), key=lambda i: sha256(f"1:{i}".encode()).hexdigest())[:16]]
    for t in range(4):
        d = [[int(((x - m) ** 2).sum()) for m in c] for x in v]
        a = [min(range(16), key=lambda j: (e[j], j)) for e in d]
        if t < 3:
            c = [sum(x for x, b in zip(v, a) if b == j) // a.count(j) if j in a else c[j] for j in range(16)]
    assert [(r[0], r[1], r[2]) for r in sorted(got)] == [(i, a[i], d[i][a[i]]) for i in range(60)]
    with pytest.raises(Exception, match="scaled component"):
        ours(spark, [(1, [3e7] * 64)]).collect()


def test_separated_groups_need_one_scan(spark):
    rng = np.random.default_rng(5)
    centre = rng.normal(size=(4, 64)) * 10
    rows = [(i, (centre[i % 4] + rng.normal(size=64) * 0.01).tolist()) for i in range(400)]
    out = ours(spark, rows, k=4).groupBy("scans").count().collect()
    assert sum(r["count"] for r in out if r["scans"] < 4) > 200


def test_drift_bounds_hold_and_are_tighter():
    rng = np.random.default_rng(6)
    k, dim = 5, 8
    for _ in range(40):
        old = rng.normal(size=(k, dim)) * 10
        new = old + rng.normal(size=(k, dim)) * rng.choice([0.1, 1, 5])
        radius = rng.uniform(0, 12, size=k)
        bound = centroids.drift_bounds(old, new, radius)
        full = np.linalg.norm(new - old, axis=1)
        assert (bound <= full[None, :] * (1 + 1e-6) + 1e-6).all()
        for a in range(k):
            x = rng.normal(size=(2000, dim))
            x *= (radius[a] * rng.uniform(size=(2000, 1)) ** (1 / dim)) / np.linalg.norm(x, axis=1, keepdims=True)
            x += old[a]
            near = np.linalg.norm(x[:, None] - old[None], axis=2) - np.linalg.norm(x[:, None] - new[None], axis=2)
            assert (near.max(0) <= bound[a] + 1e-9).all()
    far = centroids.drift_bounds(np.array([[0.0, 0], [100, 0]]), np.array([[0.0, 0], [100, 5]]), np.array([1.0, 1]))
    assert far[0, 1] < 0.5          # sideways move seen from afar: a tenth of its length
