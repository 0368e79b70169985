import math

import pytest
from pyspark.sql import functions as F

from lakelens.operators import clean, profile


def test_describe_edge_values(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (8.0,), (None,)], "x double")
    r = profile.profile_describe(df, ["x"]).first()
    assert r["count"] == 4
    assert (r["q25"], r["q50"], r["q75"]) == (1.75, 3.0, 5.0)
    assert r["std"] == pytest.approx(3.0957, abs=1e-4)


def test_describe_nan_and_all_null(spark):
    df = spark.createDataFrame([(1.0, None), (float("nan"), None), (3.0, None)], "x double, y double")
    rows = {r["column"]: r for r in profile.profile_describe(df, ["x", "y"]).collect()}
    assert rows["x"]["count"] == 2 and rows["x"]["q50"] == 2.0
    assert rows["y"]["count"] == 0 and rows["y"]["mean"] is None


def test_null_counts_and_info(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), None)], "x double, s string")
    nc = {r["column"]: r["nulls"] for r in profile.null_counts(df).collect()}
    assert nc == {"x": 1, "s": 1}


def test_corr_constant_and_pairwise_nulls(spark):
    df = spark.createDataFrame([(1.0, 5.0, 1.0), (2.0, 5.0, None), (3.0, 5.0, 3.0), (None, 5.0, 4.0)],
                               "a double, b double, c double")
    m = {(r["col_a"], r["col_b"]): r["r"] for r in profile.corr_matrix(df, ["a", "b", "c"]).collect()}
    assert m[("a", "b")] is None                     # constant column -> NULL, no error
    assert m[("a", "c")] == pytest.approx(1.0)       # only rows where both are present
    one = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    assert profile.corr_matrix(one).where("i != j").first()["r"] is None


def test_coerce_cases(spark):
    cases = [(" ", None), ("12d", None), (" 7 ", 7.0), ("1e3", 1000.0), ("inf", math.inf), ("nan", None), ("?", None)]
    df = spark.createDataFrame([(c,) for c, _ in cases], "s string")
    got = [r[0] for r in df.select(clean.coerce_numeric("s")).collect()]
    assert got == [e for _, e in cases]


def test_most_frequent_tie_smallest_and_unseen(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "c string")
    imp = clean.impute_most_frequent_fit(df, ["c"])
    assert imp.values["c"] == "a"
    test = spark.createDataFrame([("z",), (None,)], "c string")
    assert [r[0] for r in imp.transform(test).collect()] == ["z", "a"]
    allnull = spark.createDataFrame([(None,)], "c string")
    assert clean.impute_most_frequent_fit(allnull, ["c"]).values["c"] is None


def test_fill_median_and_clean_table(spark):
    df = spark.createDataFrame([(1.0, "1"), (None, "2"), (3.0, "?"), (3.0, "?")], "x double, s string")
    out, steps = clean.clean_table(df)
    rows = sorted(out.collect())
    assert rows == [(1.0, 1.0), (3.0, 2.0)]
    rep = {r["step"]: r["rows"] for r in clean.step_report(steps).collect()}
    assert rep == {"input": 4, "fill_median": 4, "drop_duplicates": 3, "coerce": 3, "drop_nulls": 2}
    out2, _ = clean.clean_table(df, coerce_first=True)
    assert sorted(out2.collect()) == [(1.0, 1.0), (3.0, 1.5), (3.0, 2.0)]


def test_inject_nulls_exact(spark):
    df = spark.range(100).withColumn("v", F.lit(1.0))
    out = clean.inject_nulls(df, "v", 11, ["id"])
    assert out.where(F.col("v").isNull()).count() == 11


def test_literal_rows_keeps_schema_and_values(spark):
    from lakelens.sources import files
    df = files.literal_rows(spark, [("TKT-000001", "Login fails", "Account"), ("TKT-000002", None, "Billing")],
                            "ticket_id string, ticket string, true_tag string")
    assert df.columns == ["ticket_id", "ticket", "true_tag"]
    assert [tuple(r) for r in df.orderBy("ticket_id").collect()] == [
        ("TKT-000001", "Login fails", "Account"), ("TKT-000002", None, "Billing")]


def test_value_shares_and_one_row_stats_attach(spark):
    from pyspark.sql import functions as F
    from lakelens.functions.common import join_null_safe
    from lakelens.operators import profile
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "v string")
    got = {r["value"]: (r["count"], r["share"]) for r in profile.value_shares(df, "v").collect()}
    assert got == {"a": (2, 2 / 3), "b": (1, 1 / 3)}
    stats = df.agg(F.count("v").alias("n"), F.max("v").alias("mx"))
    out = join_null_safe(df, stats, [], one_row=True)
    assert out.columns == ["v", "n", "mx"]
    assert sorted((r["v"] or "", r["n"], r["mx"]) for r in out.collect()) == [
        ("", 3, "b"), ("a", 3, "b"), ("a", 3, "b"), ("b", 3, "b")]
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()
