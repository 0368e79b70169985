"""Forests on dealt input, with nodes kept by row."""

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from lakelens.operators import models
from lakelens.session import deal


@pytest.fixture(scope="module")
def rows(spark):
    d = spark.range(0, 600, 1, 2).select(
        "id", (F.col("id") % 17).cast("double").alias("a"), (F.col("id") % 29).cast("double").alias("b"),
        ((F.col("id") * 7919) % 3 == 0).cast("double").alias("label"))
    return VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(d)


@pytest.mark.parametrize("make", [models.rf_regression, models.rf_classifier])
def test_kept_nodes_grow_the_same_forest(rows, make):
    est = make(trees=5, depth=6)
    assert est.getCacheNodeIds()
    kept, walked = est.fit(rows), est.copy({est.cacheNodeIds: False}).fit(rows)
    assert kept.toDebugString.split("\n")[1:] == walked.toDebugString.split("\n")[1:]


def test_deal_keeps_rows_and_uses_cores(spark):
    one = spark.range(0, 1000, 1, 1).withColumn("k", F.when(F.col("id") % 10 > 0, F.col("id")))
    assert deal(one, "k").rdd.getNumPartitions() == 1               # few rows stay as they are
    got = deal(one, "k", rows=250)
    parts = got.groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) > 1
    assert sorted(r["id"] for r in got.collect()) == list(range(1000))
    assert deal(got, "k", rows=250) is got
    assert deal(one.limit(0), "k", rows=250).count() == 0


def test_summary_runs_the_model_once(spark):
    from lakelens.plans.model_plans import _binary_summary
    seen = spark.sparkContext.accumulator(0)

    def vec(i):
        from pyspark.ml.linalg import Vectors
        seen.add(1)
        return Vectors.dense([1.0 - i / 100, i / 100])

    from pyspark.ml.linalg import VectorUDT
    scored = spark.range(100).select((F.col("id") >= 50).cast("int").alias("label"), F.lit(1.0).alias("prediction"),
                                     F.udf(vec, VectorUDT()).asNondeterministic()("id").alias("probability"))
    got = _binary_summary(scored).first()
    assert (got["auc"], got["accuracy"]) == (1.0, 0.5)
    assert seen.value == 100
