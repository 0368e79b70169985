import pytest
from pyspark.sql import functions as F

from lakelens.operators import metrics, sampling


def test_stratified_split_quotas_and_properties(spark):
    rows = [(i, "a") for i in range(61)] + [(100 + i, "b") for i in range(23)] + [(500, "c")]
    df = spark.createDataFrame(rows, "id long, y string")
    s = sampling.stratified_split(df, "y", ["id"], 0.2)
    n = s.count()
    test = s.where("part = 'test'").count()
    assert n == 85 and test == 17                         # ceil(0.2 * 85)
    per = {(r["part"], r["y"]): r["n"] for r in sampling.split_report(s, "part", "y").collect()}
    assert per[("test", "a")] + per[("train", "a")] == 61
    assert abs(per[("test", "a")] / 61 - 0.2) <= 1 / 61 + 1e-9
    again = sampling.stratified_split(df, "y", ["id"], 0.2)
    assert sorted(again.collect()) == sorted(s.collect())   # seed-stable


def test_folds_balanced(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(103)], "id long, y int")
    f = sampling.stratified_folds(df, "y", ["id"], 5).groupBy("y", "fold").count().collect()
    for y in range(3):
        sizes = [r["count"] for r in f if r["y"] == y]
        assert max(sizes) - min(sizes) <= 1


def test_random_split_and_sample_sizes(spark):
    df = spark.range(101)
    r = sampling.random_split(df, ["id"], 0.2)
    assert r.where("part = 'test'").count() == 21
    assert sampling.exact_sample(df, 10, ["id"]).count() == 10
    tr, te = sampling.split_parts(r)
    assert tr.join(te, "id").count() == 0 and tr.count() + te.count() == 101


def _auc(spark, ys, ss):
    df = spark.createDataFrame(list(zip(ys, [float(x) for x in ss])), "y int, score double")
    return metrics.roc_auc(df, "y", "score", n_buckets=3).first()["auc"]


def test_auc_edges(spark):
    assert _auc(spark, [0, 1, 0, 1], [0.5] * 4) == 0.5
    assert _auc(spark, [0, 0, 1, 1], [1, 2, 3, 4]) == 1.0
    assert _auc(spark, [0, 0, 1, 1], [4, 3, 2, 1]) == 0.0
    assert _auc(spark, [1, 1], [1, 2]) is None
    ys, ss = [0, 1, 1, 0, 1, 0, 1], [0.1, 0.4, 0.35, 0.8, 0.9, 0.4, 0.4]
    assert _auc(spark, ys, ss) == pytest.approx(1 - _auc(spark, ys, [-s for s in ss]))
    assert _auc(spark, ys, ss) == pytest.approx(7 / 12)   # (1.5 + 1 + 3 + 1.5) / (4 * 3)


def test_roc_curve_drops_collinear(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.4), (1, 0.35), (1, 0.8)], "y int, score double")
    pts = sorted((r["fpr"], r["tpr"]) for r in metrics.roc_curve(df, "y", "score").collect())
    assert pts == [(0.0, 0.0), (0.0, 0.5), (0.5, 0.5), (0.5, 1.0), (1.0, 1.0)]


def test_report_never_predicted_and_only_predicted(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "c"), ("b", "a")], "y string, pred string")
    rep = {r["label"]: r for r in metrics.classification_report(df, "y", "pred").collect()}
    assert rep["b"]["precision"] == 0.0 and rep["b"]["recall"] == 0.0
    assert rep["c"]["support"] == 0 and rep["c"]["f1"] == 0.0
    assert rep["accuracy"]["f1"] == pytest.approx(1 / 3)


def test_regression_constant_truth(spark):
    df = spark.createDataFrame([(2.0, 2.0), (2.0, 2.0)], "y double, pred double")
    assert metrics.regression_metrics(df).first()["r2"] == 1.0
    df2 = spark.createDataFrame([(2.0, 1.0), (2.0, 2.0)], "y double, pred double")
    assert metrics.regression_metrics(df2).first()["r2"] == 0.0
    one = spark.createDataFrame([(1.0, 3.0)], "y double, pred double").first()
    assert one is not None


def test_confusion_total(spark):
    df = spark.createDataFrame([(1, 1), (0, 1), (1, 0), (0, 0), (0, 0)], "y int, pred int")
    cm = metrics.confusion_matrix(df, [0, 1]).collect()
    assert sum(r["0"] + r["1"] for r in cm) == 5


def test_stratified_split_with_hot_class_spread_over_buckets(spark):
    # one class holds 40% of the rows; quotas stay exact and ranks stay unique
    from lakelens.operators import sampling
    from pyspark.sql import functions as F
    df = spark.range(2000).withColumn("label", F.when(F.col("id") < 800, 0).otherwise((F.col("id") % 3) + 1))
    out = sampling.stratified_split(df, "label", ["id"], 0.2)
    got = {(r["label"], r["part"]): r["n"] for r in out.groupBy("label", "part").agg(F.count("*").alias("n")).collect()}
    sizes = {r["label"]: r["c"] for r in df.groupBy("label").agg(F.count("*").alias("c")).collect()}
    assert sum(v for (lab, p), v in got.items() if p == "test") == 400
    for lab, n in sizes.items():
        assert got[(lab, "train")] + got[(lab, "test")] == n
        assert abs(got[(lab, "test")] - 0.2 * n) <= 1


def test_auc_scores_rows_once(spark):
    """The counts by score are stored: sizing, sketch, offsets and sums read them, not the scoring."""
    seen = spark.sparkContext.accumulator(0)

    def score(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    df = spark.range(400).select((F.col("id") % 2).cast("int").alias("y"), ((F.col("id") * 7 % 50) / 50).alias("score")) \
        .mapInArrow(score, "y int, score double")
    got = metrics.roc_auc(df, "y", "score").first()["auc"]
    rows = [(i % 2, i * 7 % 50) for i in range(400)]
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    assert got == pytest.approx(sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg)))
    assert seen.value == 400
