"""§2.7 time-series queries on ``events`` daily bars (the price-bar stand-in)."""

from pyspark.sql import functions as F

from ..operators import metrics, series
from .registry import register, table

BARS_SQL = """
  SELECT user_id AS entity, CAST(ts AS DATE) AS day,
         arg_min(value, ts) AS open, max(value) AS high, min(value) AS low,
         arg_max(value, ts) AS close, CAST(count(*) AS BIGINT) AS volume
  FROM events GROUP BY 1, 2
"""

FEATURES_SQL = f"""
  WITH bars AS ({BARS_SQL}),
  f AS (
    SELECT entity, day, open, high, low, close, volume,
           close - open AS price_change, high - low AS high_low_range,
           CASE WHEN count(close) OVER w5 = 5 THEN avg(close) OVER w5 END AS ma_5,
           CASE WHEN count(close) OVER w10 = 10 THEN avg(close) OVER w10 END AS ma_10,
           CASE WHEN lag(close) OVER w = 0 THEN NULL
                ELSE close / lag(close) OVER w - 1 END AS daily_return,
           lead(close) OVER w AS target
    FROM bars
    WINDOW w AS (PARTITION BY entity ORDER BY day),
           w5 AS (PARTITION BY entity ORDER BY day ROWS BETWEEN 4 PRECEDING AND CURRENT ROW),
           w10 AS (PARTITION BY entity ORDER BY day ROWS BETWEEN 9 PRECEDING AND CURRENT ROW))
  SELECT * FROM f
  WHERE ma_5 IS NOT NULL AND ma_10 IS NOT NULL AND daily_return IS NOT NULL
    AND target IS NOT NULL
"""


def _features(spark, sf):
    return series.ohlc_features(series.daily_bars(table(spark, sf, "events")))


@register("daily_bars", f"""
  SELECT entity, day, ROUND(open, 6) AS open, ROUND(high, 6) AS high, ROUND(low, 6) AS low,
         ROUND(close, 6) AS close, volume FROM ({BARS_SQL})
""")
def q_daily_bars(spark, sf):
    return series.daily_bars(table(spark, sf, "events"))


@register("lead_target", f"""
  SELECT entity, day, ROUND(close, 6) AS close,
         ROUND(lead(close) OVER (PARTITION BY entity ORDER BY day), 6) AS target
  FROM ({BARS_SQL})
""")
def q_lead_target(spark, sf):
    b = series.daily_bars(table(spark, sf, "events"))
    return series.lead_target(b).select("entity", "day", "close", "target")


@register("rolling_mean", f"""
  SELECT entity, day,
    ROUND(CASE WHEN count(close) OVER w5 = 5 THEN avg(close) OVER w5 END, 6) AS ma_5,
    ROUND(CASE WHEN count(close) OVER w10 = 10 THEN avg(close) OVER w10 END, 6) AS ma_10
  FROM ({BARS_SQL})
  WINDOW w5 AS (PARTITION BY entity ORDER BY day ROWS BETWEEN 4 PRECEDING AND CURRENT ROW),
         w10 AS (PARTITION BY entity ORDER BY day ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)
""")
def q_rolling_mean(spark, sf):
    b = series.daily_bars(table(spark, sf, "events"))
    b = series.rolling_mean(series.rolling_mean(b, 5), 10)
    return b.select("entity", "day", "ma_5", "ma_10")


@register("pct_change", f"""
  SELECT entity, day,
    ROUND(CASE WHEN lag(close) OVER w = 0 THEN NULL
               ELSE close / lag(close) OVER w - 1 END, 6) AS daily_return
  FROM ({BARS_SQL}) WINDOW w AS (PARTITION BY entity ORDER BY day)
""")
def q_pct_change(spark, sf):
    b = series.pct_change(series.daily_bars(table(spark, sf, "events")))
    return b.select("entity", "day", "daily_return")


_ROUND_FEATURES = ", ".join(
    f"ROUND({c}, 6) AS {c}" for c in
    ["open", "high", "low", "close", "price_change", "high_low_range", "ma_5", "ma_10",
     "daily_return", "target"])


@register("ohlc_features", f"""
  SELECT entity, day, volume, {_ROUND_FEATURES} FROM ({FEATURES_SQL})
""")
def q_ohlc_features(spark, sf):
    return _features(spark, sf)


@register("chrono_split", f"""
  SELECT entity, day,
    CASE WHEN row_number() OVER (PARTITION BY entity ORDER BY day)
              <= floor(count(*) OVER (PARTITION BY entity) * 0.8) THEN 'train' ELSE 'test' END AS part
  FROM ({FEATURES_SQL})
""")
def q_chrono_split(spark, sf):
    return series.chrono_split(_features(spark, sf)).select("entity", "day", "part")


@register("latest_row", f"""
  SELECT entity, day, volume, {_ROUND_FEATURES} FROM (
    SELECT *, row_number() OVER (PARTITION BY entity ORDER BY day DESC) AS rn
    FROM ({FEATURES_SQL})) WHERE rn = 1
""")
def q_latest_row(spark, sf):
    return series.latest_row(_features(spark, sf))


NAIVE_SQL = f"""
  WITH s AS (
    SELECT *, CASE WHEN row_number() OVER (PARTITION BY entity ORDER BY day)
              <= floor(count(*) OVER (PARTITION BY entity) * 0.8) THEN 'train' ELSE 'test' END AS part
    FROM ({FEATURES_SQL}))
  SELECT CAST(count(*) AS BIGINT) AS n,
         ROUND(avg(abs(close - target)), 6) AS mae,
         ROUND(sqrt(avg((close - target) * (close - target))), 6) AS rmse,
         ROUND(CASE WHEN var_pop(target) * count(*) = 0
                    THEN CASE WHEN sum((close - target) * (close - target)) = 0 THEN 1.0 ELSE 0.0 END
                    ELSE 1 - sum((close - target) * (close - target)) / (var_pop(target) * count(*)) END,
               6) AS r2
  FROM s WHERE part = 'test'
"""


def naive_forecast_metrics(spark, sf):
    """Minimum slice: bars -> features -> chrono split -> metrics of 'tomorrow = today'."""
    f = series.chrono_split(_features(spark, sf))
    test = f.where(F.col("part") == "test")
    return metrics.regression_metrics(test, y="target", pred="close")


register("forecast_naive_metrics", NAIVE_SQL)(naive_forecast_metrics)


@register("linear_score", """
  SELECT l_orderkey, l_linenumber,
         ROUND(0.5 * l_quantity + 0.001 * l_extendedprice - 10.0 * l_discount + 3.0 * l_tax + 1.5, 6)
           AS score
  FROM lineitem
""")
def q_linear_score(spark, sf):
    """Serving given coefficients as a query: sum(coef_i * x_i) + intercept."""
    from ..operators.models import linear_score
    li = table(spark, sf, "lineitem")
    coefs = {"l_quantity": 0.5, "l_extendedprice": 0.001, "l_discount": -10.0, "l_tax": 3.0}
    return linear_score(li, coefs, intercept=1.5).select("l_orderkey", "l_linenumber", "score")
