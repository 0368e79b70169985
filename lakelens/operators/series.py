"""Time-series features per entity: bars, lead target, rolling means, returns, splits.

Order is never implied: every operator takes an entity key and an explicit
order column.  Windows are partitioned by entity; ``daily_bars`` first reduces
raw events to one row per entity and day, so a window partition holds at most
one row per calendar day even when one entity owns a large share of events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.common import safe_div

FEATURES = ["open", "high", "low", "close", "volume",
            "price_change", "high_low_range", "ma_5", "ma_10", "daily_return"]


def daily_bars(events: DataFrame, entity: str = "user_id", ts: str = "ts",
               value: str = "value") -> DataFrame:
    """open/high/low/close/volume per entity and UTC day (partial aggregation map-side)."""
    return (events
            .groupBy(F.col(entity).alias("entity"), F.to_date(F.col(ts)).alias("day"))
            .agg(F.min_by(value, ts).alias("open"),
                 F.max(value).alias("high"),
                 F.min(value).alias("low"),
                 F.max_by(value, ts).alias("close"),
                 F.count(F.lit(1)).alias("volume")))


def _w(entity: str, order: str) -> Window:
    return Window.partitionBy(entity).orderBy(order)


def lead_target(df: DataFrame, entity: str = "entity", order: str = "day",
                value: str = "close", out: str = "target") -> DataFrame:
    return df.withColumn(out, F.lead(value, 1).over(_w(entity, order)))


def rolling_mean(df: DataFrame, w: int, entity: str = "entity", order: str = "day",
                 value: str = "close", out: str | None = None) -> DataFrame:
    """Mean of the last ``w`` rows; NULL until ``w`` non-null values are present."""
    frame = _w(entity, order).rowsBetween(-(w - 1), 0)
    return df.withColumn(out or f"ma_{w}",
                         F.when(F.count(value).over(frame) == w, F.avg(value).over(frame)))


def pct_change(df: DataFrame, entity: str = "entity", order: str = "day",
               value: str = "close", out: str = "daily_return") -> DataFrame:
    """x / previous x - 1; first row NULL; a zero previous value gives NULL, not an error."""
    prev = F.lag(value, 1).over(_w(entity, order))
    return df.withColumn(out, safe_div(F.col(value), prev) - F.lit(1.0))


def ohlc_features(bars: DataFrame, entity: str = "entity", order: str = "day") -> DataFrame:
    """Ten features plus next-row target; rows with any NULL dropped.

    All windows share one (entity, order) spec, so Spark sorts once.
    """
    w = _w(entity, order)
    f5 = w.rowsBetween(-4, 0)
    f10 = w.rowsBetween(-9, 0)
    out = bars.select(
        entity, order, "open", "high", "low", "close", "volume",
        (F.col("close") - F.col("open")).alias("price_change"),
        (F.col("high") - F.col("low")).alias("high_low_range"),
        F.when(F.count("close").over(f5) == 5, F.avg("close").over(f5)).alias("ma_5"),
        F.when(F.count("close").over(f10) == 10, F.avg("close").over(f10)).alias("ma_10"),
        (safe_div(F.col("close"), F.lag("close", 1).over(w)) - F.lit(1.0)).alias("daily_return"),
        F.lead("close", 1).over(w).alias("target"),
    )
    return out.dropna("any")


def chrono_split(df: DataFrame, test_ratio: float = 0.2, entity: str = "entity",
                 order: str = "day", out: str = "part") -> DataFrame:
    """First ``int(n * (1 - test_ratio))`` rows of each entity are train, the rest test."""
    w = _w(entity, order)
    n = F.count(F.lit(1)).over(Window.partitionBy(entity))
    cut = F.floor(n.cast("double") * F.lit(1.0 - test_ratio))
    return df.withColumn(out, F.when(F.row_number().over(w) <= cut, F.lit("train"))
                         .otherwise(F.lit("test")))


def latest_row(df: DataFrame, entity: str = "entity", order: str = "day") -> DataFrame:
    """Last row per entity (features for the next-step forecast), one pass, no sort."""
    others = [c for c in df.columns if c != entity]
    return (df.groupBy(entity)
            .agg(F.max_by(F.struct(*others), F.col(order)).alias("__last"))
            .select(entity, "__last.*"))
