"""Centroid clustering (Lloyd rounds) with geometrically tightened drift bounds.

Every vector keeps its cluster, the exact squared distance to its own centroid
and one lower bound on the distance to every other centroid.  When centroids
move, the bound of a vector in cluster a is loosened by what centroid j can
really come nearer to any point of a's sphere (centre: a's old centroid, radius:
its farthest member), not by the whole length of j's move.

For a move from p to q of length s with midpoint m, and a point x whose
component along the move (measured from m) is u,

    |x-p| - |x-q| = 2 s u / (|x-p| + |x-q|),   |x-p| + |x-q| >= 2 |x-m|,

so the approach is at most s * cos(angle between x-m and the move).  Seen from
m, in the plane of the move and the sphere's centre, the sphere fills a cone of
half angle asin(r / D); the smallest angle in it gives the bound.  If the whole
cone points backwards the bound is negative: the lower bound rises.

A vector is kept without a scan only if its distance lies strictly below its
lower bound; every other vector is ambiguous and scanned against all centroids
in exact integers (ties: smaller number).  Results equal plain Lloyd rounds.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_type, staged

DIM = 64
SCALE = 64
K = 16
ROUNDS = 3
LIMIT = 1 << 27         # scaled components stay below it, so squared distances fit 64 bits
EXACT = 1 << 22         # below it squared distances are exact in doubles, and BLAS does them
SLACK = 1e-9            # relative, far above the rounding of the bounds' doubles


def scaled_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                   dim: int = DIM, scale: int = SCALE) -> DataFrame:
    """(_id, _v array<int>) of the vectors with ``dim`` finite components."""
    v = F.col("_x")
    good = (F.size(v) == dim) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(v, lambda x: F.when(F.abs(x * scale) < LIMIT, F.floor(x * scale).cast("int")).otherwise(
        F.raise_error(F.lit(f"a scaled component reaches {LIMIT}")).cast("int")))
    return (vectors.select(F.col(id_col).alias("_id"), F.col(vec_col).cast("array<double>").alias("_x"))
            .filter(good).select("_id", whole.alias("_v")))


def first_centroids(rows: DataFrame, k: int = K, seed: int = 1) -> np.ndarray:
    """The k vectors with the smallest sha256 of ``seed:id`` (NULL ids last, equal
    ids by their components), in that order; fewer rows give fewer centroids."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("_id").cast("string")), 256)
    top = rows.select(h.alias("_h"), "_v").orderBy(F.col("_h").asc_nulls_last(), "_v").limit(k).collect()
    return np.array([r["_v"] for r in top], dtype=np.int64)


def squared_distances(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact int64 squared distances, rows x centroids."""
    if max(np.abs(v).max(initial=0), np.abs(c).max(initial=0)) < EXACT:
        a, b = v.astype(np.float64), c.astype(np.float64)
        d = (a * a).sum(1)[:, None] - 2.0 * (a @ b.T) + (b * b).sum(1)[None, :]
        return d.astype(np.int64)
    out = np.empty((len(v), len(c)), dtype=np.int64)
    for j in range(len(c)):
        e = v.astype(np.int64) - c[j]
        out[:, j] = (e * e).sum(1)
    return out


def drift_bounds(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """[a, j]: the most that centroid j comes nearer to any point within
    ``radius[a]`` of ``old[a]`` by moving from ``old[j]`` to ``new[j]``."""
    k = len(old)
    out = np.zeros((k, k))
    for j in range(k):
        p, q = old[j].astype(np.float64), new[j].astype(np.float64)
        s = float(np.linalg.norm(q - p))
        if s == 0:
            continue
        mid, axis = (p + q) / 2, (q - p) / s
        for a in range(k):
            w, r = old[a] - mid, float(radius[a]) * (1 + SLACK)
            far = float(np.linalg.norm(w))
            if far <= r:
                out[a, j] = s
                continue
            u = float(w @ axis)
            angle = np.arctan2(np.sqrt(max(far * far - u * u, 0.0)), u) - np.arcsin(r / far)
            cos = np.cos(max(angle, 0.0))
            if cos < 0:
                near = far - r
                cos *= near / np.sqrt(near * near + s * s / 4)
            out[a, j] = s * cos + SLACK * (s + far)
    return out


def _scan(v, c):
    """(cluster, squared distance, lower bound to the others) by full scan."""
    d = squared_distances(v, c)
    best = d.argmin(1)                      # first of equal values: smaller number
    at = np.arange(len(v))
    own = d[at, best]
    if len(c) == 1:
        return best, own, np.full(len(v), np.inf)
    d[at, best] = np.iinfo(np.int64).max
    return best, own, np.sqrt(d.min(1).astype(np.float64))


def _assign(c: np.ndarray, loosen: np.ndarray | None):
    """mapInArrow function of one assignment; ``loosen``: per cluster, None at first."""
    def run(batches):
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            v = b.column(1).flatten().to_numpy().reshape(n, -1)
            if loosen is None:
                best, own, low = _scan(v, c)
            else:
                best = b.column(2).to_numpy().astype(np.int64)
                low = b.column(4).to_numpy() - loosen[best]
                e = v.astype(np.int64) - c[best]
                own = (e * e).sum(1)
                up = np.sqrt(own.astype(np.float64))
                open_ = np.flatnonzero(~(up * (1 + SLACK) + SLACK < low * (1 - SLACK)))
                if len(open_):
                    best[open_], own[open_], new_low = _scan(v[open_], c)
                    low = low.copy()
                    low[open_] = new_low
            mark = np.full(n, loosen is None, dtype=np.int8)
            if loosen is not None:
                mark[open_] = 1
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(best.astype(np.int32)), pa.array(own),
                 pa.array(low), pa.array(mark)], ["_id", "_v", "_c", "_d", "_low", "_scanned"])
    return run


def _sums(k: int, dim: int):
    """Per task and cluster: rows, component sums, largest and summed distance."""
    def run(batches):
        s = np.zeros((k, dim), dtype=np.int64)
        n = np.zeros(k, dtype=np.int64)
        far = np.zeros(k, dtype=np.int64)
        total = [0] * k
        for b in batches:
            if not b.num_rows:
                continue
            v = b.column(0).flatten().to_numpy().reshape(b.num_rows, -1).astype(np.int64)
            c, d = b.column(1).to_numpy(), b.column(2).to_numpy()
            for a in np.unique(c):
                own = c == a
                n[a] += own.sum()
                s[a] += v[own].sum(0)
                far[a] = max(far[a], d[own].max())
                total[a] += sum(d[own].tolist())
        has = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(has.astype(np.int32)), pa.array(n[has]), pa.array(s[has].tolist(), pa.list_(pa.int64())),
             pa.array(far[has]), pa.array([str(total[a]) for a in has], pa.string())],
            ["_c", "_n", "_s", "_far", "_total"])
    return run


def _totals(state: DataFrame, k: int, dim: int) -> list:
    """At most k rows: cluster, count, component sums, largest and summed distance."""
    part = state.select("_v", "_c", "_d").mapInArrow(
        _sums(k, dim), "_c int, _n long, _s array<long>, _far long, _total string")
    return part.groupBy("_c").agg(
        F.sum("_n").alias("n"), F.max("_far").alias("far"),
        F.sum(F.col("_total").cast("decimal(38,0)")).alias("total"),
        F.array(*[F.sum(F.col("_s")[i]) for i in range(dim)]).alias("s")).collect()


def cluster(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K,
            rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE, seed: int = 1) -> DataFrame:
    """One row per kept vector: id, cluster, distance (squared), cluster_inertia,
    inertia, centroid_sha256, and scans (exact full scans it needed, of rounds + 1).

    A vector that is NULL, of another length, or holds a NULL or non-finite
    component is left out.  A NULL id is kept and never seeds a centroid while
    others can.  Rows that repeat an id or a vector are rows of their own.  An
    empty table, or one without such vectors, gives an empty result.  Scaled
    components from 2**27 on raise an error, since distances would pass 64 bits.
    """
    rows = staged(scaled_vectors(vectors, id_col, vec_col, dim, scale), "centroid-vectors")
    c = first_centroids(rows, k, seed)
    ids = id_type(vectors, id_col)
    schema = f"_id {ids}, _v array<int>, _c int, _d long, _low double, _scanned byte"
    if not len(c):
        return rows.select(F.col("_id").alias(id_col), F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"),
                           F.lit(0).cast("long").alias("cluster_inertia"), F.lit(0).cast("long").alias("inertia"),
                           F.lit("").alias("centroid_sha256"), F.lit(0).alias("scans")).limit(0)
    state = staged(rows.mapInArrow(_assign(c, None), schema).withColumn("_scans", F.lit(1)), "centroid-state")
    for _ in range(rounds):
        got = {r["_c"]: r for r in _totals(state, len(c), dim)}
        new = c.copy()
        radius = np.zeros(len(c))
        for a, r in got.items():
            new[a] = [x // r["n"] for x in r["s"]]
            radius[a] = np.sqrt(float(r["far"]))
        move = drift_bounds(c, new, radius)
        np.fill_diagonal(move, -np.inf)
        loosen = move.max(1) if len(c) > 1 else np.zeros(1)
        c = new
        before = state.select("_id", "_v", "_c", "_d", "_low", "_scans")

        def step(batches, run=_assign(c, loosen)):
            for b in batches:
                for out in run(iter([b])):
                    scans = pa.array(b.column(5).to_numpy() + out.column(5).to_numpy().astype(np.int32))
                    yield pa.RecordBatch.from_arrays([*out.columns, scans], [*out.schema.names, "_scans"])
        state = staged(before.mapInArrow(step, schema + ", _scans int"), "centroid-state")
    got = {r["_c"]: r for r in _totals(state, len(c), dim)}
    lit = lambda f: F.array(*[F.lit(f(a)) for a in range(len(c))])
    inertia = [int(got[a]["total"]) if a in got else 0 for a in range(len(c))]
    sha = [hashlib.sha256(",".join(map(str, row.tolist())).encode()).hexdigest() for row in c]
    return state.select(
        F.col("_id").alias(id_col), F.col("_c").alias("cluster"), F.col("_d").alias("distance"),
        lit(lambda a: inertia[a])[F.col("_c")].cast("long").alias("cluster_inertia"),
        F.lit(sum(inertia)).cast("long").alias("inertia"),
        lit(lambda a: sha[a])[F.col("_c")].alias("centroid_sha256"),
        F.col("_scans").alias("scans"))


def oracle_sql(k: int = K, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE, seed: int = 1) -> str:
    """Plain Lloyd rounds in DuckDB (every vector against every centroid)."""
    ctes = [f"""kept AS (SELECT row_number() OVER () AS rid, vec_id,
        [floor({scale} * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
        WHERE len(embedding) = {dim} AND list_count(embedding) = {dim}
          AND list_bool_and([isfinite(x) FOR x IN embedding])),
    n2 AS (SELECT rid, vec_id, v, list_inner_product(v, v) AS vv FROM kept),
    c0 AS (SELECT (row_number() OVER (ORDER BY sha256('{seed}:' || vec_id::VARCHAR) NULLS LAST, v) - 1)::INT AS c, v AS m
        FROM kept QUALIFY c < {k})"""]
    for t in range(rounds + 1):
        ctes.append(f"""a{t} AS (SELECT rid, arg_min(c, (d, c)) AS c, min(d)::BIGINT AS d FROM (
        SELECT rid, c, vv - 2 * list_inner_product(v, m) + list_inner_product(m, m) AS d FROM n2, c{t}) GROUP BY rid)""")
        if t < rounds:
            ctes.append(f"""p{t} AS (SELECT c, i, floor(sum(x) / count(*)) AS x FROM (
        SELECT c, generate_subscripts(v, 1) AS i, unnest(v) AS x FROM a{t} JOIN n2 USING (rid)) GROUP BY c, i),
    c{t + 1} AS (SELECT c{t}.c, coalesce(q.m, c{t}.m) AS m FROM c{t}
        LEFT JOIN (SELECT c, list(x ORDER BY i) AS m FROM p{t} GROUP BY c) q ON q.c = c{t}.c)""")
    return "WITH " + ",\n    ".join(ctes) + f"""
    SELECT vec_id, a.c::INT AS cluster, d AS distance, (sum(d) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia,
      (sum(d) OVER ())::BIGINT AS inertia,
      sha256(array_to_string([x::BIGINT FOR x IN m], ',')) AS centroid_sha256
    FROM a{rounds} a JOIN n2 USING (rid) JOIN c{rounds} f ON f.c = a.c"""
