"""§2.2 table profiling: shape, head, info, describe, nulls, counts, correlations.

Every profile is one (or a few) aggregates over the whole table, unpivoted to a
long frame afterwards, so a wide table is still read once.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.common import FLOAT_TYPES, is_missing, numeric_columns, safe_div, string_columns
from ..functions.keys import exact_quantiles, sketch_aggs
from ..session import stage_table

AGG_CHUNK = 200   # pairs of columns in one aggregate


def profile_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)).cast("long"))


def profile_head(df: DataFrame, order: list[str], n: int = 5) -> DataFrame:
    """First ``n`` rows by an explicit order (TakeOrdered: one pass, top-n per task)."""
    return df.orderBy(*order).limit(n)


def text_head(df: DataFrame, text: str, order: list[str], n: int = 3, width: int = 80) -> DataFrame:
    return profile_head(df, order, n).withColumn(
        text, F.concat(F.substring(F.col(text), 1, width), F.lit("…")))


def _long(df: DataFrame, per_col: dict[str, list], stat_names: list[str]) -> DataFrame:
    """One aggregate row -> one row per column (stack)."""
    exprs = []
    for c, es in per_col.items():
        exprs.append(F.struct(F.lit(c).alias("column"), *[e.alias(s) for e, s in zip(es, stat_names)]))
    return df.agg(F.array(*exprs).alias("__a")).select(F.explode("__a").alias("__r")).select("__r.*")


def profile_info(df: DataFrame) -> DataFrame:
    """Per column: type name, non-null count (NaN counts as missing, as in pandas)."""
    per = {}
    for f in df.schema.fields:
        per[f.name] = [F.lit(f.dataType.simpleString()),
                       F.sum(F.when(~is_missing(f.name, f.dataType), 1).otherwise(0)).cast("long")]
    return _long(df, per, ["dtype", "non_null"])


def null_counts(df: DataFrame, only_positive: bool = True) -> DataFrame:
    per = {f.name: [F.sum(is_missing(f.name, f.dataType).cast("long")).cast("long")]
           for f in df.schema.fields}
    out = _long(df, per, ["nulls"])
    return out.where(F.col("nulls") > 0) if only_positive else out


def profile_describe(df: DataFrame, cols: list[str] | None = None, digits: int | None = None,
                     approx: bool = False) -> DataFrame:
    """count, mean, std (sample), min, 25/50/75 %, max per numeric column.

    Moments in one aggregate; quartiles exact by default (distributed order
    statistics, see ``exact_quantiles``), or ``percentile_approx`` if asked.
    """
    cols = cols or numeric_columns(df)
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"),
                 F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias("x"))
        for c in cols])).alias("__r")).select("__r.*")
    probs = [0.25, 0.5, 0.75]
    moments = [F.count("x").alias("count"), F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"),
               F.min("x").alias("min"), F.max("x").alias("max")]
    if approx:
        mom = long.groupBy("column").agg(*moments)
        q = long.groupBy("column").agg(
            F.percentile_approx("x", [0.25, 0.5, 0.75], 100000).alias("__q")).select(
            "column", F.col("__q")[0].alias("q25"), F.col("__q")[1].alias("q50"), F.col("__q")[2].alias("q75"))
    else:
        # one row per column; the first pass of the quartiles rides along
        mom = stage_table(long.groupBy("column").agg(*moments, *sketch_aggs(F.col("x"), probs)), "describe")
        q = exact_quantiles(long, "x", probs, ["column"], names=["q25", "q50", "q75"],
                            sketch=mom.select("column", "__n", "__at"))
    out = mom.join(q, "column", "left").select(
        "column", F.col("count").cast("long").alias("count"), "mean", "std", "min", "q25", "q50", "q75", "max")
    if digits is not None:
        out = out.withColumns({c: F.bround(c, digits) for c in ["mean", "std", "min", "q25", "q50", "q75", "max"]})
    return out


def value_counts(df: DataFrame, col: str, sort_by_value: bool = False) -> DataFrame:
    """Rows per value, most frequent first (ties by value); NULL left out."""
    out = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")) \
            .agg(F.count(F.lit(1)).alias("count"))
    return out.orderBy("value") if sort_by_value else out.orderBy(F.desc("count"), "value")


def value_shares(df: DataFrame, col: str) -> DataFrame:
    """Counts normalised by the total.  The total is a scalar subquery (one
    partial aggregate), not a window over all values, so a high-cardinality
    column never lands in one task."""
    vc = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("count"))
    total = df.where(F.col(col).isNotNull()).select(F.count(F.lit(1))).scalar()
    return vc.withColumn("share", F.col("count") / total)


def flag_rate(df: DataFrame, cond, group_cols: list[str] | tuple = ()) -> DataFrame:
    return df.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("n"),
                                       F.avg(cond.cast("double")).alias("rate"))


def distinct_count(df: DataFrame, cols: list[str], approx: bool = False) -> DataFrame:
    f = (lambda c: F.approx_count_distinct(c)) if approx else (lambda c: F.count_distinct(c))
    return df.agg(*[f(c).alias(f"distinct_{c}") for c in cols])


def duplicate_count(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Rows that repeat an earlier row (NULLs equal).

    Rows are grouped by md5 of their JSON form: 16 bytes per row cross the
    shuffle instead of whole texts.
    """
    cols = cols or df.columns
    key = F.md5(F.to_json(F.struct(*[F.col(c) for c in cols])))
    g = df.groupBy(key.alias("__k")).agg(F.count(F.lit(1)).alias("__n"))
    return g.agg(F.sum("__n").cast("long").alias("n_rows"), F.count(F.lit(1)).alias("n_distinct")) \
            .withColumn("n_duplicates", F.col("n_rows") - F.col("n_distinct"))


def columns_by_type(df: DataFrame) -> dict[str, list[str]]:
    """Schema inspection only, no job."""
    return {"numeric": numeric_columns(df), "string": string_columns(df)}


def _pair_corr(a: str, b: str):
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    x = F.when(both, F.col(a).cast("double"))
    y = F.when(both, F.col(b).cast("double"))
    # covariance / (std * std) over rows where both are present; constant -> NULL
    return safe_div(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def corr_matrix(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Pearson r for all pairs, long form (col_a, col_b, i, j, r), mirrored, with
    diagonal.  Few columns: one aggregate; more pairs than one aggregate takes: ``corr_wide``."""
    cols = cols or numeric_columns(df)
    if len(cols) * (len(cols) + 1) // 2 > AGG_CHUNK:
        from .gram import corr_wide
        return corr_wide(df, cols)
    d = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in cols])
    pairs = [(i, j) for i, j in combinations(range(len(cols)), 2)] + [(i, i) for i in range(len(cols))]
    row = d.agg(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"),
                                   _pair_corr(cols[i], cols[j]).alias("r")) for i, j in pairs]).alias("a"))
    out = row.select(F.explode("a").alias("p")).select("p.*")
    mirrored = out.where(F.col("i") != F.col("j")).select(F.col("j").alias("i"), F.col("i").alias("j"), "r")
    full = out.unionByName(mirrored)
    names = F.array(*[F.lit(c) for c in cols])
    return full.select(F.get(names, F.col("i")).alias("col_a"), F.get(names, F.col("j")).alias("col_b"),
                       F.col("i").cast("long").alias("i"), F.col("j").cast("long").alias("j"), "r")


def corr_lower_triangle(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Upper triangle and diagonal masked: keep i > j."""
    return corr_matrix(df, cols).where(F.col("i") > F.col("j"))


def corr_with_target(df: DataFrame, target: str, cols: list[str] | None = None) -> DataFrame:
    cols = [c for c in (cols or numeric_columns(df)) if c != target]
    row = df.agg(F.array(*[F.struct(F.lit(c).alias("feature"), _pair_corr(c, target).alias("r"))
                           for c in cols]).alias("a"))
    return row.select(F.explode("a").alias("p")).select("p.*")
