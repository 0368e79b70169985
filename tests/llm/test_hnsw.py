"""Embedding near-dedup: equal to all pairs, recall, audits, edge rows."""
import numpy as np
import pytest

from lakelens.llm import hnsw

SCHEMA = "vec_id long, embedding array<float>, label int, _row string, _x string, _shard string, _node string"


def ours(spark, rows, **kw):
    return hnsw.near_duplicates(spark.createDataFrame([(i, v, 0, "a", "b", "c", "d") for i, v in rows], SCHEMA), **kw)


def brute(rows, cos=0.9):
    vec = []
    for _, v in rows:
        ok = v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
        x = np.array(v, dtype=np.float32).astype(np.float64) if ok else None
        vec.append(x / np.linalg.norm(x) if ok else None)
    n = len(rows)
    link = [[j for j in range(n) if j != i and vec[i] is not None and vec[j] is not None
             and len(vec[i]) == len(vec[j]) and vec[i] @ vec[j] >= cos] for i in range(n)]
    out, seen = [None] * n, set()
    for i in range(n):
        if i in seen:
            continue
        group, todo = {i}, [i]
        while todo:
            new = set(link[todo.pop()]) - group
            group |= new
            todo += new
        seen |= group
        least = min((rows[j][0] for j in group if rows[j][0] is not None), default=None)
        for j in group:
            out[j] = (rows[j][0], len(link[j]), least, rows[j][0] == least)
    return sorted(out, key=str)


def test_equals_all_pairs(spark):
    rng = np.random.default_rng(1)
    unit = lambda x: x / np.linalg.norm(x)
    rows = [(i, unit(rng.normal(size=16)).tolist()) for i in range(300)]
    for g in range(12):     # chains and clouds around the limit, with copies
        v = unit(rng.normal(size=16))
        for k in range(25):
            rows.append((400 + 25 * g + k, (v * rng.choice([1, 3, 1e-3])).tolist()))
            v = unit(v + rng.normal(size=16) * rng.choice([0.0, 0.03, 0.1]))
    rows += [(3, rows[3][1])] * 2 + [(None, rows[8][1]), (None, [9.0] + [0.0] * 15), (2000, None), (2001, []),
             (2002, [0.0] * 16), (2003, [None] + [1.0] * 15), (2004, [float("nan")] * 16),
             (2005, [float("inf")] + [0.0] * 15), (2006, [1.0, 2.0]), (2007, [2.0, 4.0]), (2008, [1e30, 2e30]),
             (2009, rows[8][1][:15])]
    assert sorted((tuple(r) for r in ours(spark, rows, min_shards=3).collect()), key=str) == brute(rows)


def test_empty_and_unusable(spark):
    assert ours(spark, []).count() == 0
    got = [tuple(r) for r in ours(spark, [(1, None), (2, [0.0]), (None, [])]).collect()]
    assert sorted(got, key=str) == [(1, 0, 1, True), (2, 0, 2, True), (None, 0, None, True)]


def test_recall_on_the_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id", "embedding").limit(300).collect()
    rng = np.random.default_rng(2)
    table = [(r[0], list(r[1])) for r in rows]
    near = [(10_000 + i, (np.array(v) + rng.normal(size=64) * 0.03).tolist()) for i, v in table]
    got = {r["vec_id"]: r for r in ours(spark, table + near).collect()}
    want = {r[0]: r for r in brute(table + near)}
    links = sum(w[1] for w in want.values())
    assert links > 300 and sum(got[i]["n_links"] for i in want) >= 0.99 * links
    assert sum(got[i]["component_id"] == want[i][2] for i in want) >= 0.99 * len(want)


def test_one_large_group_is_counted_not_paired():
    """A ball of copies is one graph node, and a query gives it one edge."""
    rng = np.random.default_rng(3)
    x = hnsw.unit_rows((np.ones((2000, 32)) + rng.normal(size=(2000, 32)) * 0.02).ravel(), 32)
    s = hnsw.Shard(x, np.arange(2000), 0.9)
    assert s.graph.size == 1
    n, i, to = s.query(x[:100], np.arange(100))
    assert (n == 2000).all() and len(i) == len(to) == 100


@pytest.mark.parametrize("beam", [1, 4])
def test_audit_widens_the_beam(beam):
    rng = np.random.default_rng(4)
    x = hnsw.unit_rows(rng.normal(size=(3000, 24)).ravel(), 24)
    s = hnsw.Shard(x, np.arange(3000), 0.9)
    s.beam = beam
    s.audit()
    assert s.beam > beam and s.recall >= hnsw.RECALL


def test_stored_shard_answers_alike():
    import pyarrow as pa
    rng = np.random.default_rng(5)
    x = rng.normal(size=(900, 12))
    import pandas as pd
    out = hnsw._build(0.9, 12)(pd.DataFrame({"_row": np.arange(900) * 7, "_shard": 2, "_x": list(x)}))
    back = hnsw._load(pa.Table.from_pandas(out.sample(frac=1, random_state=1)), 0.9, 12)
    u = hnsw.unit_rows(x.ravel(), 12)
    first = hnsw.Shard(u, np.arange(900) * 7, 0.9)
    first.audit()
    a, b = first.query(u, np.arange(900) * 7), back.query(u, np.arange(900) * 7)
    assert all((p == q).all() for p, q in zip(a, b))
    assert (a[0] == (u @ u.T >= 0.9).sum(1)).mean() > 0.99


def test_a_search_compares_few_pairs_at_once():
    """Vectors gathered for the comparisons fit a cache, whatever the block."""
    import tracemalloc
    rng = np.random.default_rng(3)
    x = rng.standard_normal((1000, 256))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    s = hnsw.Shard(x[:400], np.arange(400), 0.9)
    tracemalloc.start()
    ids, sims = s.graph.search(x[400:912], 32)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16 << 20          # 512 x 32 pairs of 256 doubles on two sides: 64 MB
    want = np.sort(x[400:912] @ s.graph.x.T, axis=1)[:, ::-1][:, :32]
    assert (np.diff(sims, axis=1) <= 0).all() and (sims[:, 0] <= want[:, 0] + 1e-12).all()
    assert np.allclose(sims, np.einsum("ij,ikj->ik", x[400:912], s.graph.x[ids]))
