"""Tree rules, pruning, prefix curves, own metrics in selection, quotas, TF-IDF vectors."""
import uuid

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from lakelens.operators import features as fx
from lakelens.operators import metrics, models, sampling, trees
from lakelens.session import scratch_path


def fresh(spark):
    return scratch_path(spark, f"test-{uuid.uuid4().hex}")


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 3)).round(3)
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)) | (rng.uniform(size=600) < 0.1)
    df = spark.createDataFrame([(i, *map(float, r), float(t), i % 5, "train" if i % 4 else "test")
                                for i, (r, t) in enumerate(zip(x, y))],
                               "id long, a double, b double, `odd name` double, label double, fold int, part string")
    return df.cache()


NAMES = ["a", "b", "odd name"]


@pytest.fixture(scope="module")
def assembled(rows):
    return VectorAssembler(inputCols=NAMES, outputCol="features").transform(rows)


def test_rules_partition_the_rows(spark, rows, assembled):
    model = models.decision_tree().fit(assembled)
    rules = trees.tree_rules(spark, model, fresh(spark), NAMES, ["no", "yes"]).collect()
    assert len(rules) == (model.numNodes + 1) // 2 > 4
    rows.createOrReplaceTempView("tree_rows")
    met = None
    for r in rules:
        n = spark.sql(f"SELECT count(*) FROM tree_rows WHERE {r['rule']}").first()[0]
        assert n == r["n_train"] and r["class"] == ["no", "yes"][int(r["prediction"])] and 0.5 <= r["share"] <= 1
        assert r["depth"] == r["rule"].count(" AND ") + 1
        hit = F.expr(f"CAST({r['rule']} AS INT)")
        met = hit if met is None else met + hit
    assert rows.where(met != 1).count() == 0
    # each row's rule gives the model's own prediction
    said = F.coalesce(*[F.expr(f"CASE WHEN {r['rule']} THEN {r['prediction']} END") for r in rules])
    assert model.transform(assembled).where(said != F.col("prediction")).count() == 0


def test_lone_root_has_the_rule_true(spark, assembled):
    model = models.decision_tree().fit(assembled.withColumn("label", F.lit(1.0)))
    got = trees.tree_rules(spark, model, fresh(spark), NAMES).collect()
    assert [(r["rule"], r["depth"], r["n_train"]) for r in got] == [("true", 0, 600)]


def test_min_split_pruning(spark, assembled):
    model = models.decision_tree(depth=8).fit(assembled)
    path = fresh(spark)
    cut = trees.prune_min_split(spark, model, path, 60)
    assert 1 < cut.numNodes < model.numNodes
    for m, least in ((cut, 60), (model, 0)):
        nodes = trees.saved_nodes(spark, m, fresh(spark)).collect()
        assert all(r["rawCount"] >= least for r in nodes if r["leftChild"] >= 0)
    assert any(r["rawCount"] < 60 for r in trees.saved_nodes(spark, model, fresh(spark)).where("leftChild >= 0").collect())
    # rows that never reach a cut node are predicted as before
    grown = {r["rule"]: r["prediction"] for r in trees.tree_rules(spark, model, fresh(spark), NAMES).collect()}
    pruned = {r["rule"]: r["prediction"] for r in trees.tree_rules(spark, cut, fresh(spark), NAMES).collect()}
    same = set(grown) & set(pruned)
    assert same and all(grown[r] == pruned[r] for r in same)
    assert trees.prune_min_split(spark, model, fresh(spark), 0).numNodes == model.numNodes


@pytest.mark.parametrize("kind", ["class", "number"])
def test_curve_equals_the_model_cut_there(spark, assembled, kind):
    iters = 60
    train = assembled.where("part = 'train'")
    est = models.gbt_classifier(iters=iters, depth=2) if kind == "class" else \
        models.gbt_regression("a2", iters=iters, depth=2)
    data = assembled.withColumn("a2", F.col("a") * 2 + F.col("b"))
    train = data.where("part = 'train'")
    model = est.fit(train)
    label = "label" if kind == "class" else "a2"
    got = {(r["part"], r["iteration"]): r for r in trees.learning_curve(spark, model, data, fresh(spark), label).collect()}
    assert len(got) == 2 * iters
    if kind == "class":
        for part in ("train", "test"):
            own = model.evaluateEachIteration(data.where(F.col("part") == part))
            assert [got[part, i + 1]["loss"] for i in range(iters)] == pytest.approx(own, rel=1e-9)
        p = model.transform(data.where("part = 'test'")).select(F.col("label").cast("int").alias("y"),
                                                                F.col("prediction").cast("int").alias("pred"))
        assert got["test", iters]["accuracy"] == pytest.approx(metrics.accuracy(p).first()["accuracy"])
        assert got["test", iters]["f1"] == pytest.approx(metrics.f1_binary(p).first()["f1"])
    else:
        own = model.evaluateEachIteration(data.where("part = 'test'"), "squared")
        assert [got["test", i + 1]["loss"] for i in (0, 29, iters - 1)] == pytest.approx([own[i] for i in (0, 29, iters - 1)])
        assert got["test", 1]["accuracy"] is None and got["test", 1]["f1"] is None
    plan = trees.learning_curve(spark, model, data, fresh(spark), label)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1


def test_own_metric_in_model_selection(spark, assembled):
    """Fold scores are the table form's AUC on that fold; ties count half."""
    d = assembled.withColumn("label", F.col("label").cast("int"))
    ev = models.exact_auc()
    for est in (models.decision_tree(depth=2), models.rf_classifier(trees=5, depth=3)):
        got = models.grid_search_by_fold([], est, [{}], d, evaluator=ev)["folds"][0]
        for f in range(5):
            scored = models.predict_proba(est.fit(d.where(F.col("fold") != f)).transform(d.where(F.col("fold") == f)))
            assert got[f] == pytest.approx(metrics.roc_auc(scored, "label", "p1").first()["auc"])
        cv = CrossValidator(estimator=Pipeline(stages=[est]), estimatorParamMaps=ParamGridBuilder().build(),
                            evaluator=ev, foldCol="fold", numFolds=5).fit(d)
        assert cv.avgMetrics[0] == pytest.approx(np.mean(got))
    small = spark.createDataFrame([(1, 0.5), (0, 0.5), (1, 0.9)], "label int, p1 double")
    assert ev.evaluate(small) == pytest.approx(0.75)
    assert ev.evaluate(small.where("label = 1")) == float("-inf")


def quotas(counts, test_size=0.2):
    import math
    n = sum(counts.values())
    train = n - math.ceil(n * test_size)
    fl = {c: train * k // n for c, k in counts.items()}
    rest = sorted(counts, key=lambda c: (-(train * counts[c] % n), c))
    left = train - sum(fl.values())
    return {c: fl[c] + (i < left) for i, c in enumerate(rest)}


@pytest.mark.parametrize("n_classes", [1, 7, 900])
def test_quotas_with_ties_and_many_strata(spark, n_classes):
    counts = {f"c{i:04d}": 1 + i * 7 % 5 for i in range(n_classes)}
    df = spark.createDataFrame([(c,) for c, k in counts.items() for _ in range(k)], "label string")
    got = {r["label"]: r["n_train"] for r in sampling.class_quotas(df, "label").collect()}
    assert got == quotas(counts)
    assert sampling.class_quotas(df.limit(0), "label").count() == 0


def test_a_million_strata(spark):
    df = spark.range(2_500_000).select((F.col("id") % 1_000_000).alias("label"))
    q = sampling.class_quotas(df, "label")
    # 500,000 classes of 3 rows and 500,000 of 2: 2,000,000 training rows
    got = {(r["n_class"], r["n_train"]): r["n"] for r in q.groupBy("n_class", "n_train").agg(F.count("*").alias("n")).collect()}
    assert sum(k[1] * n for k, n in got.items()) == 2_000_000 and sum(got.values()) == 1_000_000
    # floors 2 and 1, remainders 0.4 and 0.6: all pairs get the spare row first
    assert got == {(3, 2): 500_000, (2, 2): 500_000}


def test_sample_by_cut_key(spark):
    df = spark.range(5000).select(F.col("id"), (F.col("id") % 7).alias("g"))
    key = sampling.with_key(df, ["id"], 42)
    for n in (0, 1, 100, 4999, 5000, 9000):
        got = sorted(r["id"] for r in sampling.exact_sample(df, n, ["id"]).collect())
        assert got == sorted(r["id"] for r in key.orderBy(sampling.KEY).limit(n).collect())


def test_tfidf_vectors(spark):
    docs = spark.createDataFrame([(1, "red red blue"), (2, "blue green"), (3, ""), (4, None), (4, "Red, unknown!")],
                                 "doc_id long, text string")
    vocab = fx.tfidf_vocabulary(docs.where("doc_id < 4"))
    v = {r["token"]: r for r in vocab.collect()}
    assert v["blue"]["idx"] == 0 and v["blue"]["docs"] == 2 and v["red"]["idf"] == pytest.approx(np.log(4 / 2))
    out = fx.tfidf_vectors(docs, vocab).collect()
    by = {(r["doc_id"], r["text"]): r["features"] for r in out}
    assert by[1, "red red blue"].size == 3
    assert by[1, "red red blue"][v["red"]["idx"]] == pytest.approx(2 * v["red"]["idf"])
    assert by[4, None].numNonzeros() == by[3, ""].numNonzeros() == 0
    assert by[4, "Red, unknown!"].indices.tolist() == [v["red"]["idx"]]
