"""Correlations of a wide table in one scan: blocked co-moment matrices.

Each task turns its batches into matrix products (values x values, values x
presence masks), kept as centred co-moments per pair of columns over the rows
where both are present.  Pairs are cut into square blocks of columns, one row
per block and task, and merged in two levels (a tree) with the pairwise update
of means and co-moments, so nothing cancels and no row grows with the table.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIDE = 64       # columns of a block side
FAN = 64        # partial blocks merged in one group of the first level
PART = "bi int, bj int, n array<double>, a array<double>, b array<double>, va array<double>, vb array<double>, c array<double>"
STATS = ["n", "a", "b", "va", "vb", "c"]


def co_moments(x: np.ndarray) -> dict[str, np.ndarray]:
    """Per pair (i, j) over rows where both are present (NaN: missing): count,
    mean of i (``a``) and of j (``b``), sums of squares ``va``, ``vb`` and
    products ``c`` around the means."""
    here = ~np.isnan(x)
    first = np.where(here.any(0), x[here.argmax(0), np.arange(x.shape[1])], 0.0)    # exact for constants
    m = here.astype(np.float64)
    y = np.where(here, x - first, 0.0)
    n, s, q, p = m.T @ m, y.T @ m, (y * y).T @ m, y.T @ y
    k = np.where(n > 0, n, 1.0)
    return {"n": n, "a": first[:, None] + s / k, "b": first[None, :] + s.T / k,
            "va": q - s * s / k, "vb": q.T - s.T * s.T / k, "c": p - s * s.T / k}


def merge(one: dict, two: dict) -> dict:
    """Co-moments of two sets of rows together."""
    n = one["n"] + two["n"]
    k = np.where(n > 0, n, 1.0)
    # a side without rows has no mean: it takes the other's
    da = np.where((one["n"] > 0) & (two["n"] > 0), two["a"] - one["a"], 0.0)
    db = np.where((one["n"] > 0) & (two["n"] > 0), two["b"] - one["b"], 0.0)
    w = one["n"] * two["n"] / k
    mean = lambda f, d: np.where(one["n"] > 0, one[f], two[f]) + d * np.where(one["n"] > 0, two["n"], 0) / k
    return {"n": n, "a": mean("a", da), "b": mean("b", db), "va": one["va"] + two["va"] + da * da * w,
            "vb": one["vb"] + two["vb"] + db * db * w, "c": one["c"] + two["c"] + da * db * w}


def _blocks(k: int):
    n = math.ceil(k / SIDE)
    return [(i, j, slice(i * SIDE, min(k, (i + 1) * SIDE)), slice(j * SIDE, min(k, (j + 1) * SIDE)))
            for i in range(n) for j in range(i, n)]


def _partial(k: int):
    """mapInArrow function: one row per block, all batches of the task merged."""
    def run(batches):
        total = None
        for b in batches:
            if b.num_rows:
                x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.float64) for c in b.columns])
                got = co_moments(x)
                total = got if total is None else merge(total, got)
        if total is not None:
            at = _blocks(k)
            cols = [pa.array([i for i, *_ in at], pa.int32()), pa.array([j for _, j, *_ in at], pa.int32())]
            cols += [pa.array([total[f][r, s].ravel() for _, _, r, s in at], pa.list_(pa.float64())) for f in STATS]
            yield pa.RecordBatch.from_arrays(cols, ["bi", "bj", *STATS])
    return run


def _merged(pdf: pd.DataFrame) -> dict:
    total = None
    for row in zip(*[pdf[f] for f in STATS]):
        one = dict(zip(STATS, map(np.asarray, row)))
        total = one if total is None else merge(total, one)
    return total


def _join(pdf: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame([{"bi": pdf["bi"].iloc[0], "bj": pdf["bj"].iloc[0], **_merged(pdf)}])


def _pairs(k: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        t = _merged(pdf)
        bi, bj = int(pdf["bi"].iloc[0]), int(pdf["bj"].iloc[0])
        rows, cols = min(SIDE, k - bi * SIDE), min(SIDE, k - bj * SIDE)
        i, j = np.divmod(np.arange(rows * cols), cols)
        i, j = i + bi * SIDE, j + bj * SIDE
        scale = np.sqrt(t["va"]) * np.sqrt(t["vb"])
        r = np.where(scale > 0, t["c"] / np.where(scale > 0, scale, 1.0), np.nan)
        out = pd.DataFrame({"i": i, "j": j, "r": r})
        return out if bi < bj else out[out["i"] <= out["j"]]
    return run


def corr_wide(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson r for all pairs of ``cols`` (col_a, col_b, i, j, r), mirrored, with
    diagonal, over the rows where both are present; NULL for a constant side.
    NaN counts as missing.  One scan, whatever the number of columns."""
    k = len(cols)
    d = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    part = d.mapInArrow(_partial(k), PART).withColumn("fan", F.pmod(F.xxhash64("n", "c"), F.lit(FAN)).cast("int"))
    once = part.groupBy("bi", "bj", "fan").applyInPandas(_join, PART)
    pairs = once.groupBy("bi", "bj").applyInPandas(_pairs(k), "i int, j int, r double")
    both = F.when(F.col("i") == F.col("j"), F.array(F.struct("i", "j"))).otherwise(
        F.array(F.struct("i", "j"), F.struct(F.col("j").alias("i"), F.col("i").alias("j"))))
    full = pairs.select(F.explode(both).alias("p"), F.nanvl("r", F.lit(None).cast("double")).alias("r")) \
        .select("p.i", "p.j", "r")
    names = F.array(*[F.lit(c) for c in cols])
    return full.select(F.get(names, F.col("i")).alias("col_a"), F.get(names, F.col("j")).alias("col_b"),
                       F.col("i").cast("long").alias("i"), F.col("j").cast("long").alias("j"), "r")
