"""§2.3 projection / scalar operators and §2.4 cleaning and imputation."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegralType

from ..functions.common import FLOAT_TYPES, numeric_columns, string_columns
from ..functions.keys import exact_quantiles, md5_key, rank_by_key

# The shape of a number that pandas.to_numeric accepts.
NUMBER_PATTERN = r"^[+-]?(([0-9]+[.]?[0-9]*)|([.][0-9]+))([eE][+-]?[0-9]+)?$"
SPECIAL_PATTERN = r"^[+-]?([iI][nN][fF]([iI][nN][iI][tT][yY])?|[nN][aA][nN])$"


# ---------------------------------------------------------------- projection
def rename_positional(df: DataFrame, names: list[str]) -> DataFrame:
    if len(names) != len(df.columns):
        raise ValueError(f"{len(names)} names for {len(df.columns)} columns")
    return df.toDF(*names)


def drop_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.drop(*[c for c in cols if c in df.columns])


def select_except(df: DataFrame, exclude: list[str]) -> DataFrame:
    return df.select(*[c for c in df.columns if c not in set(exclude)])


def filter_by_class(df: DataFrame, col: str, value) -> DataFrame:
    return df.where(F.col(col) == F.lit(value))


def binarize(cond: Column) -> Column:
    """Condition -> 0/1; a NULL condition gives 0, as pandas' comparison does."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def code_to_label(df: DataFrame, code_col: str, labels: dict, out: str = "label") -> DataFrame:
    """Integer code -> class name through a literal map (bounded by construction)."""
    m = F.create_map(*[x for k, v in labels.items() for x in (F.lit(k), F.lit(v))])
    return df.withColumn(out, m[F.col(code_col)])


def coerce_numeric(c: str | Column) -> Column:
    """String -> double as ``pandas.to_numeric(errors='coerce')``; bad text -> NULL.

    Spark alone would read '12d' as 12.0 and raise on bad text under ANSI; a
    pattern guard plus ``try_cast`` gives pandas' answer.  NaN becomes NULL.
    """
    x = F.trim(F.col(c) if isinstance(c, str) else c)
    ok = x.rlike(NUMBER_PATTERN) | x.rlike(SPECIAL_PATTERN)
    v = F.when(ok, x.try_cast("double"))
    return F.nanvl(v, F.lit(None).cast("double"))


def coerce_all(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    cols = cols if cols is not None else string_columns(df)
    return df.withColumns({c: coerce_numeric(c) for c in cols})


def clip(c: str | Column, lo: float, hi: float) -> Column:
    x = F.col(c) if isinstance(c, str) else c
    return F.greatest(F.lit(lo), F.least(F.lit(hi), x))


def min_max_scale(df: DataFrame, cols: list[str], eps: float = 1e-9) -> DataFrame:
    """(x - min) / (max - min + eps): statistics in one aggregate, joined as one row."""
    row = df.agg(*[x for c in cols for x in (F.min(c).alias(f"mn_{c}"), F.max(c).alias(f"mx_{c}"))]).first()
    # fitted statistics (two numbers per column) become literals, as a fitted scaler
    return df.withColumns({c: (F.col(c) - F.lit(row[f"mn_{c}"])) /
                           (F.lit(row[f"mx_{c}"]) - F.lit(row[f"mn_{c}"]) + F.lit(eps)) for c in cols})


def log_target(c: str) -> Column:
    return F.log1p(F.col(c))


def exp_target(c: str) -> Column:
    return F.expm1(F.col(c))


def format_id(rank: Column, prefix: str, width: int, suffix: str = "") -> Column:
    return F.format_string(f"{prefix}%0{width}d{suffix}", rank)


def number_rows(df: DataFrame, order_col: str, seed: int = 42, out: str = "rank") -> DataFrame:
    """Dense 1..n numbering by a (distinct) order column, without a one-task window."""
    from ..functions.keys import rank_by_value
    k = "__tb"
    return rank_by_value(df.withColumn(k, md5_key(order_col, seed=seed)), order_col, k, out).drop(k)


def inject_nulls(df: DataFrame, col: str, k: int, key_cols: list[str], seed: int = 42) -> DataFrame:
    """Exactly ``k`` rows (first k by seeded md5 key) get NULL in ``col``."""
    r = rank_by_key(df.withColumn("__k", md5_key(*key_cols, seed=seed)), "__k", rank_col="__r")
    return r.withColumn(col, F.when(F.col("__r") <= k, F.lit(None).cast(df.schema[col].dataType))
                        .otherwise(F.col(col))).drop("__k", "__r")


# ---------------------------------------------------------------- cleaning
@dataclass
class FittedImputer:
    """Statistics learned on one frame (train), applied to any frame."""
    values: dict = field(default_factory=dict)

    def transform(self, df: DataFrame) -> DataFrame:
        vals = {c: v for c, v in self.values.items() if v is not None and c in df.columns}
        fl = {f.name for f in df.schema.fields if isinstance(f.dataType, FLOAT_TYPES)}
        exprs = {}
        for c, v in vals.items():
            x = F.nanvl(F.col(c), F.lit(None).cast("double")) if c in fl else F.col(c)
            kind = df.schema[c].dataType
            if isinstance(kind, IntegralType) and isinstance(v, float) and not v.is_integer():
                kind = DoubleType()         # a half median widens an integer column
            exprs[c] = F.coalesce(x.cast(kind), F.lit(v).cast(kind))
        return df.withColumns(exprs)


def median_stats(df: DataFrame, cols: list[str]) -> DataFrame:
    """Exact median and null count per column (long form: column, median, missing)."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias("x"))
        for c in cols])).alias("r")).select("r.*")
    med = exact_quantiles(long, "x", [0.5], ["column"], names=["median"])
    miss = long.groupBy("column").agg((F.count(F.lit(1)) - F.count("x")).alias("missing"))
    return miss.join(med, "column", "left")


def impute_median_fit(df: DataFrame, cols: list[str] | None = None) -> FittedImputer:
    cols = cols or numeric_columns(df)
    rows = median_stats(df, cols).collect()      # one row per column: fitted statistics
    return FittedImputer({r["column"]: r["median"] for r in rows})


def fill_median(df: DataFrame, cols: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Numeric NULLs -> column median; returns (filled frame, report of filled counts)."""
    cols = cols or numeric_columns(df)
    stats = median_stats(df, cols)
    rows = stats.collect()
    imp = FittedImputer({r["column"]: r["median"] for r in rows if r["missing"] > 0})
    report = stats.where(F.col("missing") > 0).select("column", F.col("missing").alias("filled"), "median")
    return imp.transform(df), report


def most_frequent(df: DataFrame, cols: list[str]) -> DataFrame:
    """Most frequent non-null value per column, ties -> smallest.  All aggregates
    (partial map-side), no per-column window: (column, value)."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])).alias("r")) \
        .select("r.*").where(F.col("value").isNotNull())
    cnt = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    top = cnt.groupBy("column").agg(F.max("n").alias("n"))
    return cnt.join(top, ["column", "n"]).groupBy("column").agg(F.min("value").alias("value"))


def impute_most_frequent_fit(df: DataFrame, cols: list[str]) -> FittedImputer:
    rows = most_frequent(df, cols).collect()     # one row per column
    vals = {r["column"]: r["value"] for r in rows}
    return FittedImputer({c: vals.get(c) for c in cols})


def drop_duplicates(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def drop_nulls(df: DataFrame) -> DataFrame:
    return df.dropna("any")


def clean_table(df: DataFrame, coerce_first: bool = False) -> tuple[DataFrame, dict]:
    """fill medians -> drop duplicates -> coerce strings to numbers -> drop NULL rows.

    Returns the clean frame and the lazy frames of each step (for a rows
    in/out report: ``{step: DataFrame}``).  ``coerce_first`` moves the
    coercion before the fill, so '?'-like cells are filled instead of dropped.
    """
    steps = {"input": df}
    cur = df
    if coerce_first:
        cur = coerce_all(cur)
        steps["coerce"] = cur
    cur, _ = fill_median(cur)
    steps["fill_median"] = cur
    cur = drop_duplicates(cur)
    steps["drop_duplicates"] = cur
    if not coerce_first:
        cur = coerce_all(cur)
        steps["coerce"] = cur
    cur = drop_nulls(cur)
    steps["drop_nulls"] = cur
    return cur, steps


def step_report(steps: dict) -> DataFrame:
    parts = [d.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(i).alias("pos"), F.lit(name).alias("step"), "rows")
             for i, (name, d) in enumerate(steps.items())]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
