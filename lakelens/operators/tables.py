"""§2.6 plot-data tables: cross-tabs, histograms, box statistics, densities, scatter.

Nothing is drawn; each figure's data comes back as a long frame.  Per-group
statistics are small frames joined back (broadcast when bounded by the number
of groups), so the big side is never collected.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.common import join_null_safe, join_stats, safe_div
from ..functions.keys import exact_quantiles
from ..session import stage_table


# ---------------------------------------------------------------- cross-tabs
def group_size(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))


def crosstab(df: DataFrame, row: str, col: str, values: list, fill: bool = True) -> DataFrame:
    """Counts of row x col with one column per listed value (absent -> 0 or NULL)."""
    out = df.groupBy(row).pivot(col, values).agg(F.count(F.lit(1)))
    return out.fillna(0, subset=[str(v) for v in values]) if fill else out


def crosstab_row_share(df: DataFrame, row: str, col: str, values: list) -> DataFrame:
    ct = crosstab(df, row, col, values, fill=True)
    names = [str(v) for v in values]
    total = None
    for n in names:
        total = F.col(n) if total is None else total + F.col(n)
    return ct.withColumns({n: safe_div(F.col(n), total) for n in names})


# ---------------------------------------------------------------- histograms
def _edge(lo: Column, width: Column, i: Column) -> Column:
    return lo + i.cast("double") * width


def histogram(df: DataFrame, x: str, bins: int, group_cols: list[str] | tuple = ()) -> DataFrame:
    """Equal-width bins over each group's own [min, max] (numpy rules).

    The last bin is closed; lo == hi widens the range by 0.5 on each side; the
    bin index is corrected against the exact edges as numpy does.  Empty bins
    are reported with count 0 (the bin list is generated per group: bounded
    by groups x bins).  Output: groups, bin, edge_lo, edge_hi, count.
    """
    group_cols = list(group_cols)
    v = F.nanvl(F.col(x).cast("double"), F.lit(None).cast("double"))
    d = df.select(*group_cols, v.alias("__x")).where(F.col("__x").isNotNull())
    st = d.groupBy(*group_cols).agg(F.min("__x").alias("__mn"), F.max("__x").alias("__mx"))
    st = st.select(*group_cols,
                   F.when(F.col("__mn") == F.col("__mx"), F.col("__mn") - 0.5).otherwise(F.col("__mn")).alias("__lo"),
                   F.when(F.col("__mn") == F.col("__mx"), F.col("__mx") + 0.5).otherwise(F.col("__mx")).alias("__hi"))
    st = st.withColumn("__w", (F.col("__hi") - F.col("__lo")) / F.lit(float(bins)))
    st = stage_table(st, "histogram-edges") if group_cols else st
    j = join_stats(d, st, group_cols)
    norm = F.lit(float(bins)) / (F.col("__hi") - F.col("__lo"))
    i0 = F.least(F.floor((F.col("__x") - F.col("__lo")) * norm), F.lit(bins - 1))
    j = j.withColumn("__i", i0)
    j = j.withColumn("__i", F.when(F.col("__x") < _edge(F.col("__lo"), F.col("__w"), F.col("__i")), F.col("__i") - 1)
                     .otherwise(F.col("__i")))
    j = j.withColumn("__i", F.when((F.col("__x") >= _edge(F.col("__lo"), F.col("__w"), F.col("__i") + 1))
                                   & (F.col("__i") != bins - 1), F.col("__i") + 1).otherwise(F.col("__i")))
    counts = j.groupBy(*group_cols, F.col("__i").cast("long").alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    grid = st.select(*group_cols, "__lo", "__hi", "__w",
                     F.explode(F.sequence(F.lit(0).cast("long"), F.lit(bins - 1).cast("long"))).alias("bin"))
    out = join_null_safe(grid, counts, group_cols + ["bin"], how="left")
    return out.select(*group_cols, "bin",
                      _edge(F.col("__lo"), F.col("__w"), F.col("bin")).alias("edge_lo"),
                      F.when(F.col("bin") == bins - 1, F.col("__hi"))
                       .otherwise(_edge(F.col("__lo"), F.col("__w"), F.col("bin") + 1)).alias("edge_hi"),
                      F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count"))


# ---------------------------------------------------------------- box plots
def box_stats(df: DataFrame, x: str, group_cols: list[str] | tuple = (), whis: float = 1.5) -> DataFrame:
    """q1, median, q3, IQR, whiskers (furthest points inside the fences), outlier count.

    Pass 1: exact quartiles per group (distributed); pass 2: join the small
    per-group frame back and take filtered min/max.
    """
    group_cols = list(group_cols)
    d = df.select(*group_cols, F.nanvl(F.col(x).cast("double"), F.lit(None).cast("double")).alias("__x")) \
          .where(F.col("__x").isNotNull())
    q = exact_quantiles(d, "__x", [0.25, 0.5, 0.75], group_cols, names=["q1", "median", "q3"])
    q = q.withColumn("iqr", F.col("q3") - F.col("q1")) \
         .withColumn("__flo", F.col("q1") - F.lit(whis) * F.col("iqr")) \
         .withColumn("__fhi", F.col("q3") + F.lit(whis) * F.col("iqr"))
    j = join_stats(d, q, group_cols)
    inside = (F.col("__x") >= F.col("__flo")) & (F.col("__x") <= F.col("__fhi"))
    agg = j.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("n"),
        F.first("q1").alias("q1"), F.first("median").alias("median"), F.first("q3").alias("q3"),
        F.first("iqr").alias("iqr"),
        F.min(F.when(inside, F.col("__x"))).alias("whisker_lo"),
        F.max(F.when(inside, F.col("__x"))).alias("whisker_hi"),
        F.sum((~inside).cast("long")).alias("n_outliers"))
    return agg


def box_outliers(df: DataFrame, x: str, group_cols: list[str] | tuple = (), whis: float = 1.5,
                 keep: list[str] | tuple = ()) -> DataFrame:
    group_cols = list(group_cols)
    d = df.select(*group_cols, *keep, F.nanvl(F.col(x).cast("double"), F.lit(None).cast("double")).alias("__x")) \
          .where(F.col("__x").isNotNull())
    q = exact_quantiles(d, "__x", [0.25, 0.75], group_cols, names=["q1", "q3"])
    q = q.select(*group_cols, (F.col("q1") - F.lit(whis) * (F.col("q3") - F.col("q1"))).alias("__flo"),
                 (F.col("q3") + F.lit(whis) * (F.col("q3") - F.col("q1"))).alias("__fhi"))
    j = join_stats(d, q, group_cols)
    return j.where((F.col("__x") < F.col("__flo")) | (F.col("__x") > F.col("__fhi"))) \
            .select(*group_cols, *keep, F.col("__x").alias(x))


# ---------------------------------------------------------------- densities
# Beyond REACH bandwidths a kernel is below 1e-16 of its peak; values are binned
# at 1 / BINS of a bandwidth, which moves a density by less than 1e-7 of its peak.
REACH = 8.6
BINS = 1024


def kde(df: DataFrame, x: str, group_cols: list[str] | tuple = (), points: int = 1000) -> DataFrame:
    """Gaussian density per group on an even grid, Scott bandwidth (scipy/pandas).

    h = std_samp * n^(-1/5); grid = [min - range/2, max + range/2].  Values are
    counted in bins of a small fraction of the bandwidth, each standing at its
    values' mean, and a bin meets only the grid points its kernel reaches, so
    the work is bins x neighbouring points.  A group of one value, or of equal
    values, has no bandwidth and gives NULL densities.
    """
    group_cols = list(group_cols)
    d = df.select(*group_cols, F.nanvl(F.col(x).cast("double"), F.lit(None).cast("double")).alias("__x")) \
          .where(F.col("__x").isNotNull())
    st = d.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("__n"), F.stddev_samp("__x").alias("__sd"),
                                    F.min("__x").alias("__mn"), F.max("__x").alias("__mx"))
    rng = F.col("__mx") - F.col("__mn")
    h = F.col("__sd") * F.pow(F.col("__n").cast("double"), F.lit(-0.2))
    st = st.select(*group_cols, "__n", F.when(h > 0, h).alias("__h"), (F.col("__mn") - rng / 2).alias("__g0"),
                   (rng * 2 / F.lit(float(points - 1))).alias("__gs"))
    if group_cols:
        st = stage_table(st, "kde-stats")
    j = join_stats(d, st, group_cols).where(F.col("__h").isNotNull())
    j = j.withColumn("__bin", F.floor((F.col("__x") - F.col("__g0")) / F.col("__h") * BINS))
    bins = j.groupBy(*group_cols, "__bin").agg(
        F.count(F.lit(1)).cast("double").alias("__c"), F.avg("__x").alias("__x"), F.first("__h").alias("__h"),
        F.first("__g0").alias("__g0"), F.first("__gs").alias("__gs"))
    reach = F.lit(REACH) * F.col("__h")
    low = F.greatest(F.ceil((F.col("__x") - reach - F.col("__g0")) / F.col("__gs")), F.lit(0)).cast("int")
    high = F.least(F.floor((F.col("__x") + reach - F.col("__g0")) / F.col("__gs")), F.lit(points - 1)).cast("int")
    near = bins.where(high >= low).select("*", F.explode(F.sequence(low, high)).alias("point"))
    z = (F.col("__g0") + F.col("point").cast("double") * F.col("__gs") - F.col("__x")) / F.col("__h")
    mass = near.groupBy(*group_cols, "point").agg(F.sum(F.col("__c") * F.exp(-0.5 * z * z)).alias("__mass"))
    grid = st.select(*group_cols, "__n", "__h", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"),
                     "__g0", "__gs")
    out = join_null_safe(grid, mass, [*group_cols, "point"], how="left")
    scale = F.col("__n").cast("double") * F.col("__h") * F.lit(math.sqrt(2 * math.pi))
    return out.select(*group_cols, "point", (F.col("__g0") + F.col("point").cast("double") * F.col("__gs")).alias("grid_x"),
                      (F.coalesce("__mass", F.lit(0.0)) / scale).alias("density"))


# ---------------------------------------------------------------- scatter etc.
def scatter_pairs(df: DataFrame, pairs: list[tuple[str, str]], cls: str | None = None,
                  key_cols: list[str] | None = None) -> DataFrame:
    """(pair, x, y, class) in long form, every row of each pair."""
    parts = F.array(*[F.struct(F.lit(f"{a}~{b}").alias("pair"), F.col(a).cast("double").alias("x"),
                               F.col(b).cast("double").alias("y")) for a, b in pairs])
    extra = [F.col(cls).alias("class")] if cls else []
    keys = [F.col(k) for k in (key_cols or [])]
    out = df.select(*keys, *extra, F.explode(parts).alias("p")).select(*[k for k in (key_cols or [])], *(["class"] if cls else []), "p.*")
    return out


def group_mean(df: DataFrame, group: str, cols: list[str]) -> DataFrame:
    return df.groupBy(group).agg(*[F.avg(F.col(c).cast("double")).alias(f"mean_{c}") for c in cols])


def argmax_group(df: DataFrame, name: str, metric: str, position: str | None = None,
                 group_cols: list[str] | tuple = ()) -> DataFrame:
    """Best name by metric; ties go to the first position (then the smallest name)."""
    pos = F.col(position) if position else F.lit(0)
    key = F.struct(F.col(metric).isNull(), -F.col(metric), pos, F.col(name))
    return df.groupBy(*group_cols).agg(F.min_by(F.col(name), key).alias(f"best_{name}"),
                                       F.max(F.col(metric)).alias(f"best_{metric}"))


def min_max_range(df: DataFrame, x: str) -> DataFrame:
    return df.agg(F.min(x).alias("min"), F.max(x).alias("max"), (F.max(x) - F.min(x)).alias("range"))
