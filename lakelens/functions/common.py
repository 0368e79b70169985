"""Small column helpers used across operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType,
                 T.FloatType, T.DoubleType, T.DecimalType)
FLOAT_TYPES = (T.FloatType, T.DoubleType)


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def nan_to_null(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """NaN is the missing marker in pandas; in Spark it becomes NULL."""
    fl = {f.name for f in df.schema.fields if isinstance(f.dataType, FLOAT_TYPES)}
    targets = [c for c in (cols or df.columns) if c in fl]
    if not targets:
        return df
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast(df.schema[c].dataType))
                           for c in targets})


def is_missing(c: str, dtype: T.DataType) -> Column:
    if isinstance(dtype, FLOAT_TYPES):
        return F.col(c).isNull() | F.isnan(F.col(c))
    return F.col(c).isNull()


def safe_div(num: Column, den: Column) -> Column:
    """Division that gives NULL (not an ANSI error) on a zero denominator."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def round6(c: Column) -> Column:
    return F.round(c.cast("double"), 6)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (for stable comparison across engines)."""
    return df.withColumns({f.name: F.round(F.col(f.name), digits)
                           for f in df.schema.fields if isinstance(f.dataType, FLOAT_TYPES)})


def join_null_safe(left: DataFrame, right: DataFrame, cols: list[str], how: str = "inner",
                   hint_broadcast: bool = False, one_row: bool = False) -> DataFrame:
    """Equi-join on ``cols`` treating NULL = NULL as a match; keeps left's key columns.

    With no keys, ``right`` is either a one-row statistics frame (``one_row``:
    its columns become scalar subqueries, which Catalyst merges into one
    aggregate job, so no join is planned) or a small frame bounded by
    construction (a KDE grid), attached by a broadcast on a constant key."""
    if not cols and one_row and how in ("inner", "left"):
        return left.select("*", *[right.select(c).scalar().alias(c) for c in right.columns])
    if not cols:
        r = right.withColumn("__one", F.lit(1))
        return left.withColumn("__one", F.lit(1)).join(F.broadcast(r), "__one", how).drop("__one")
    ren = {c: f"__r_{c}" for c in cols}
    r = right.withColumnsRenamed(ren)
    if hint_broadcast:
        r = F.broadcast(r)
    cond = None
    for c in cols:
        e = F.col(c).eqNullSafe(F.col(ren[c]))
        cond = e if cond is None else cond & e
    return left.join(r, cond, how).drop(*ren.values())


# Rows of a per-group statistics frame that are broadcast; beyond, the join shuffles.
BROADCAST_GROUPS = 50_000


def join_stats(rows: DataFrame, stats: DataFrame, cols: list[str], name: str = "group-stats") -> DataFrame:
    """Attach per-group statistics to the group's rows.  The statistics are
    written once; if they are few (counted), they are broadcast, so that rows of
    a hot group are not gathered on its key."""
    if not cols:
        return join_null_safe(rows, stats, cols, one_row=True)
    from ..session import stage_table
    stats = stage_table(stats, name)
    return join_null_safe(rows, stats, cols, hint_broadcast=stats.count() <= BROADCAST_GROUPS)
