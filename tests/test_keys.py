import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakelens.functions.keys import (exact_quantiles, grouped_prefix_sums, md5_key, prefix_sums,
                                     rank_by_key, rank_by_value)


def test_rank_by_key_matches_row_number_with_many_buckets(spark):
    df = spark.range(500).withColumn("g", (F.col("id") % 3).cast("int")).withColumn("k", md5_key("id"))
    got = rank_by_key(df, "k", ["g"], prefix_len=1).select("id", "rank")
    exp = df.select("id", F.row_number().over(Window.partitionBy("g").orderBy("k")).alias("rank"))
    assert sorted(got.collect()) == sorted(exp.collect())


def test_rank_by_value_with_hot_value_and_buckets(spark):
    # a third of the rows share one value: it must be split, order kept
    df = spark.range(600).withColumn("x", F.when(F.col("id") % 3 == 0, F.lit(5.0))
                                     .otherwise((F.col("id") % 97).cast("double")))
    df = df.withColumn("k", md5_key("id"))
    got = rank_by_value(df, "x", "k", "rank", n_buckets=9).select("id", "rank")
    exp = df.select("id", F.row_number().over(Window.orderBy("x", "k")).alias("rank"))
    assert sorted(got.collect()) == sorted(exp.collect())


def test_prefix_sums_buckets(spark):
    df = spark.range(1, 301).select(F.col("id").cast("double").alias("s"), (F.col("id") % 7).alias("v"))
    got = prefix_sums(df, "s", ["v"], ascending=True, inclusive=False, n_buckets=6).select("s", "cum_v").collect()
    vals = {r["s"]: r["cum_v"] for r in got}
    run = 0
    for i in range(1, 301):
        assert vals[float(i)] == run
        run += i % 7


def test_grouped_prefix_sums(spark):
    df = spark.range(200).select((F.col("id") % 4).alias("g"), F.col("id").cast("double").alias("o"),
                                 F.lit(1).alias("one"))
    got = grouped_prefix_sums(df, "o", ["one"], ["g"], n_buckets=5).select("g", "o", "cum_one")
    exp = df.select("g", "o", F.row_number().over(Window.partitionBy("g").orderBy("o")).alias("cum_one"))
    assert sorted(got.collect()) == sorted([(r[0], r[1], r[2]) for r in exp.collect()])


@pytest.mark.parametrize("nb", [1, 4])
def test_exact_quantiles_against_numpy(spark, nb):
    vals = [1.0, 2.0, 4.0, 8.0] + [3.0] * 7 + list(range(20))
    df = spark.createDataFrame([(float(v),) for v in vals] + [(None,)], "x double")
    r = exact_quantiles(df, "x", [0.25, 0.5, 0.75], n_buckets=nb).first()
    for p, name in [(25, "q25"), (50, "q50"), (75, "q75")]:
        assert r[name] == pytest.approx(np.percentile(vals, p))


def test_same_result_for_any_shuffle_partitions(spark):
    df = spark.range(300).withColumn("k", md5_key("id"))
    res = []
    for n in (1, 4, 17):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        res.append(sorted(rank_by_key(df, "k").select("id", "rank").collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert res[0] == res[1] == res[2]


@pytest.mark.parametrize("nb", [1, 3, 8])
def test_grouped_exact_quantiles_many_buckets(spark, nb):
    rng = np.random.default_rng(5)
    groups = {"a": list(rng.integers(0, 50, 200).astype(float)),
              "b": [7.0] * 90 + [1.0, 2.0],                      # one hot value
              "c": list(rng.normal(100, 5, 31).round(2)),
              "d": [42.0]}
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {r["g"]: r for r in exact_quantiles(df, "x", [0.1, 0.5, 0.9], ["g"], n_buckets=nb).collect()}
    for g, vs in groups.items():
        for p, name in [(10, "q10"), (50, "q50"), (90, "q90")]:
            assert got[g][name] == pytest.approx(np.percentile(vs, p)), (g, name)
