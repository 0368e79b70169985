"""Exact vector top-k over pivot cells.

Items are dealt to the cell of their nearest pivot (angles are a metric, so the
triangle inequality holds).  A cell keeps its count and the range of its angles
to the pivot.  A query first scores the cells nearest to it until they hold k
items; its k-th angle then rules out every cell whose items are all farther
away, and only the rest is scored.  Queries are rows: (query, cell) pairs meet
the cell's items in an equi-join whose groups are bounded on both sides (large
cells are salted, large query sets are cut into blocks).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_PIVOTS = 256
CELL_ROWS = 20_000          # items of a cell in one group
QUERY_ROWS = 2_000          # queries in one group
SLACK = 1e-7                # angles closer than this to a bound are scored


def _usable(v: Column) -> Column:
    return (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf)) \
        & F.exists(v, lambda x: x != 0)


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _angles(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(_unit(x) @ pivots.T, -1.0, 1.0))


def _assign(pivots: np.ndarray):
    """mapInArrow function: (id, vector) plus cell and angle to its pivot."""
    def run(batches):
        for b in batches:
            if b.num_rows:
                a = _angles(b.column(1).flatten().to_numpy().reshape(b.num_rows, -1), pivots)
                cell = a.argmin(1)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array(cell.astype(np.int32)), pa.array(a[np.arange(len(a)), cell])],
                    ["__id", "__x", "__cell", "__angle"])
    return run


def first_cells(angle: np.ndarray, count: np.ndarray, k: int) -> np.ndarray:
    """Nearest cells, by angle to the pivot, that together hold k items."""
    order = np.argsort(angle, kind="stable")
    order = order[count[order] > 0]
    return order[:np.searchsorted(np.cumsum(count[order]), k) + 1]


def open_cells(angle: np.ndarray, low: np.ndarray, high: np.ndarray, count: np.ndarray, kth: float) -> np.ndarray:
    """Cells that may hold an item within ``kth`` (an angle) of the query."""
    nearest = np.maximum(0.0, np.maximum(angle - high, low - angle))
    return np.flatnonzero((count > 0) & (nearest <= kth + SLACK))


def _pairs(pivots, count, low, high, k: int):
    """mapInArrow function: (query row, vector[, k-th score]) to (query, cell)
    pairs: the first cells, or with a k-th score the other open ones."""
    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            rows, cells = [], []
            angle = _angles(b.column(1).flatten().to_numpy().reshape(b.num_rows, -1), pivots)
            kth = b.column(2).to_numpy() if b.num_columns > 2 else None
            for i, a in enumerate(angle):
                c = first_cells(a, count, k)
                if kth is not None:
                    c = np.setdiff1d(open_cells(a, low, high, count, math.acos(max(-1.0, min(1.0, kth[i])))), c)
                rows.append(np.full(len(c), i))
                cells.append(c)
            at = np.concatenate(rows).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(at)), b.column(1).take(pa.array(at)),
                 pa.array(np.concatenate(cells).astype(np.int32))], ["__q", "__v", "__cell"])
    return run


def best_of(x: np.ndarray, ids: np.ndarray, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and cosines of the k best rows of ``x`` (ties: smaller id).
    Every pair is summed in the same order, so equal vectors score alike."""
    dot = np.einsum("ij,j->i", x, q)
    score = dot / (np.sqrt(np.einsum("ij,ij->i", x, x)) * math.sqrt(float(np.einsum("i,i->", q, q))))
    near = np.arange(len(x))
    if len(x) > k:
        near = np.flatnonzero(score >= np.partition(score, len(x) - k)[len(x) - k])
    near = near[np.lexsort((ids[near], -score[near]))][:k]
    return near, score[near]


def _score(k: int):
    def run(pairs: pd.DataFrame, items: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(pairs) and len(items):
            x, ids = np.vstack(items["__x"].to_numpy()), items["__id"].to_numpy()
            for q, v in zip(pairs["__q"], pairs["__v"]):
                near, score = best_of(x, ids, np.asarray(v), k)
                out += [(q, ids[i], x[i], s) for i, s in zip(near, score)]
        return pd.DataFrame(out, columns=["__q", "__id", "__x", "score"])
    return run


def pivot_top_k(items: DataFrame, queries: DataFrame, k: int, item_id: str = "vec_id", vec: str = "embedding",
                query_id: str = "query_id", qvec: str = "query_vec", keep_query_vec: bool = False,
                pivots: int | None = None, cell_rows: int = CELL_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """The k items with the largest cosine per query row (ties: smaller id):
    item id, vector, query id, (query vector,) score, rank.

    Vectors that are NULL, empty, zero, or hold a NULL or non-finite component,
    and items or queries of another length than the pivots, take no part.
    Query rows that repeat an id are rows of their own.
    """
    from ..session import stage_table
    types = dict(items.dtypes) | {query_id: dict(queries.dtypes)[query_id]}
    x = items.select(F.col(item_id).alias("__id"), F.col(vec).cast("array<double>").alias("__x")).where(_usable(F.col("__x")))
    q = queries.select(F.col(query_id).alias("__qid"), F.col(qvec).cast("array<double>").alias("__v")) \
        .where(_usable(F.col("__v"))).withColumn("__q", F.monotonically_increasing_id())
    q = stage_table(q, "vector-queries")
    n = pivots or min(MAX_PIVOTS, max(1, math.isqrt(x.count()) // 2))
    lead = x.orderBy(F.xxhash64("__id"), "__id").limit(n).collect()         # at most MAX_PIVOTS vectors
    dim = len(lead[0]["__x"]) if lead else 0
    piv = _unit(np.array([r["__x"] for r in lead if len(r["__x"]) == dim])) if lead else np.zeros((0, 0))
    x, q = x.where(F.size("__x") == dim), q.where(F.size("__v") == dim)
    cells = stage_table(x.mapInArrow(_assign(piv), f"__id {types[item_id]}, __x array<double>, __cell int, __angle double"),
                        "vector-cells")
    count, low, high = np.zeros(len(piv), np.int64), np.zeros(len(piv)), np.zeros(len(piv))
    for r in cells.groupBy("__cell").agg(F.count("*").alias("n"), F.min("__angle").alias("lo"),
                                         F.max("__angle").alias("hi")).collect():
        count[r["__cell"]], low[r["__cell"]], high[r["__cell"]] = r["n"], r["lo"], r["hi"]
    salts = np.maximum(1, -(-count // cell_rows))
    blocks = max(1, -(-q.count() // query_rows))
    n_salts = F.get(F.array(*[F.lit(int(s)) for s in salts] or [F.lit(1)]), F.col("__cell"))
    dealt = cells.select("__id", "__x", "__cell", F.pmod(F.xxhash64("__id"), n_salts).cast("int").alias("__salt"),
                         *([F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("__block")] if blocks > 1
                           else [F.lit(0).alias("__block")]))
    group = ["__cell", "__salt", "__block"]
    best = Window.partitionBy("__q").orderBy(F.desc("score"), "__id")

    def scored(asked: DataFrame) -> DataFrame:
        pairs = stage_table(asked.mapInArrow(_pairs(piv, count, low, high, k), "__q long, __v array<double>, __cell int"),
                            "vector-pairs")
        each = pairs.select("*", F.explode(F.sequence(F.lit(0), n_salts - 1)).alias("__salt"),
                            F.pmod(F.xxhash64("__q"), F.lit(blocks)).cast("int").alias("__block"))
        hit = each.groupBy(*group).cogroup(dealt.groupBy(*group)).applyInPandas(
            _score(k), f"__q long, __id {types[item_id]}, __x array<double>, score double")
        return hit.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    first = stage_table(scored(q.select("__q", "__v")), "vector-first")
    kth = first.where(F.col("rank") == k).select("__q", F.col("score").alias("__kth"))
    rest = scored(q.join(kth, "__q").select("__q", "__v", "__kth"))
    out = first.drop("rank").unionByName(rest.drop("rank")).withColumn("rank", F.row_number().over(best)) \
        .where(F.col("rank") <= k).join(q, "__q")
    return out.select(F.col("__id").alias(item_id), F.col("__x").cast(types[vec]).alias(vec),
                      F.col("__qid").alias(query_id), *([F.col("__v").alias(qvec)] if keep_query_vec else []),
                      "score", "rank")
