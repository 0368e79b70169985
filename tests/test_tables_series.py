import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakelens.operators import series, tables


def test_histogram_numpy_rules(spark):
    vals = [0.0, 0.1, 0.5, 0.99, 1.0, 2.5, 3.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r["count"] for r in tables.histogram(df, "x", 5).orderBy("bin").collect()]
    assert got == list(np.histogram(vals, bins=5)[0])


def test_histogram_lo_equals_hi_and_single_row_class(spark):
    df = spark.createDataFrame([("a", 2.0), ("a", 2.0), ("b", 7.0)], "g string, x double")
    h = tables.histogram(df, "x", 4, ["g"]).where("count > 0").collect()
    exp_a = np.histogram([2.0, 2.0], bins=4, range=(1.5, 2.5))[0]
    got_a = {r["bin"]: r["count"] for r in h if r["g"] == "a"}
    assert got_a == {i: int(c) for i, c in enumerate(exp_a) if c}
    assert sum(r["count"] for r in h if r["g"] == "b") == 1


def test_box_stats_small_groups_and_outlier(spark):
    rows = [("one", 1.0), ("two", 1.0), ("two", 2.0), ("out", 1.0), ("out", 2.0), ("out", 3.0),
            ("out", 2.0), ("out", 100.0)]
    df = spark.createDataFrame(rows, "g string, x double")
    b = {r["g"]: r for r in tables.box_stats(df, "x", ["g"]).collect()}
    assert b["one"]["median"] == 1.0 and b["one"]["n_outliers"] == 0
    assert b["two"]["q1"] == 1.25
    assert b["out"]["whisker_hi"] == 3.0 and b["out"]["n_outliers"] == 1
    outl = tables.box_outliers(df, "x", ["g"]).collect()
    assert [(r["g"], r["x"]) for r in outl] == [("out", 100.0)]


def test_kde_integrates_to_one(spark):
    rng = np.random.default_rng(0)
    df = spark.createDataFrame([(float(v),) for v in rng.normal(size=300)], "x double")
    k = tables.kde(df, "x", points=400).orderBy("point").collect()
    xs = np.array([r["grid_x"] for r in k])
    ys = np.array([r["density"] for r in k])
    assert np.trapezoid(ys, xs) == pytest.approx(1.0, abs=0.03)


def _bars(spark, closes):
    d0 = dt.date(2024, 1, 1)
    rows = [(1, d0 + dt.timedelta(days=2 * i), c, c, c, c, 1) for i, c in enumerate(closes)]
    return spark.createDataFrame(rows, "entity long, day date, open double, high double, low double, close double, volume long")


def test_rolling_needs_full_window_and_zero_previous(spark):
    b = _bars(spark, [0.0, 1.0, 2.0, 3.0])
    r = series.pct_change(series.rolling_mean(b, 5)).orderBy("day").collect()
    assert all(x["ma_5"] is None for x in r)
    assert r[0]["daily_return"] is None and r[1]["daily_return"] is None   # previous close 0 -> NULL
    assert r[2]["daily_return"] == 1.0


def test_ohlc_features_and_split(spark):
    b = _bars(spark, [float(i + 1) for i in range(30)])
    f = series.ohlc_features(b)
    assert f.count() == 30 - 9 - 1            # 10-row warm-up, last row has no target
    s = series.chrono_split(f).groupBy("part").count().collect()
    assert {r["part"]: r["count"] for r in s} == {"train": 16, "test": 4}
    last = series.latest_row(f).first()
    assert last["day"] == max(r["day"] for r in f.collect())
