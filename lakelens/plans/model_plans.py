"""§2.11-2.12 features and models on driver-derived tables (rows-only checks,
except the feature transforms that have an SQL twin).

Stand-ins: price bars = events daily bars; heart = orders joined to customer
(target: status F); churn = customers with their orders (target: half of them
finished); houses = parts with their lines (target: what they brought in);
news = documents labelled by language.
"""

import uuid

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..functions.keys import md5_key
from ..operators import features as fx
from ..operators import metrics, models, sampling, series, text, trees
from ..session import deal, materialize, scratch_path
from .registry import register, table

BAR_FEATURES = series.FEATURES


# ------------------------------------------------------------------ feature transforms (O)
CUST_TRAIN = "md5(concat(CAST(c_custkey AS VARCHAR), '|7')) < 'cc'"


def _cust_split(spark, sf):
    c = table(spark, sf, "customer").withColumn("__k", md5_key("c_custkey", seed=7))
    return c.where(F.col("__k") < "cc").drop("__k"), c.where(F.col("__k") >= "cc").drop("__k")


@register("standard_scale", f"""
  WITH s AS (SELECT avg(c_acctbal) AS m, stddev_pop(c_acctbal) AS sd FROM customer WHERE {CUST_TRAIN})
  SELECT c_custkey, ROUND((c_acctbal - m) / CASE WHEN sd > 0 THEN sd ELSE 1.0 END, 6) AS c_acctbal
  FROM customer, s WHERE NOT ({CUST_TRAIN})
""")
def q_standard_scale(spark, sf):
    train, test = _cust_split(spark, sf)
    _, test_s = fx.standard_scale(train, ["c_acctbal"], test)
    return test_s.select("c_custkey", "c_acctbal")


SEGMENTS_SQL = "(SELECT DISTINCT c_mktsegment AS v FROM customer WHERE " + CUST_TRAIN + ")"


def _one_hot_sql(spark_values):
    cols = ", ".join(f"CASE WHEN c_mktsegment = '{v}' THEN 1.0 ELSE 0.0 END AS \"seg_{v}\"" for v in spark_values)
    return f"SELECT c_custkey, {cols} FROM customer"


# The market segments of the customer table (alphabetical).
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@register("one_hot", _one_hot_sql(SEGMENTS))
def q_one_hot(spark, sf):
    """One-hot fitted on train rows, applied to all; wide form named by category."""
    from pyspark.ml import Pipeline
    train, _ = _cust_split(spark, sf)
    allc = table(spark, sf, "customer")
    m = Pipeline(stages=fx.one_hot_stages(["c_mktsegment"])).fit(train)
    labels = m.stages[0].labelsArray[0]
    out = m.transform(allc).withColumn("__a", vector_to_array("c_mktsegment_ohe"))
    return out.select("c_custkey", *[F.get("__a", i).alias(f"seg_{v}") for i, v in enumerate(labels)])


@register("softmax_argmax", """
  WITH l AS (SELECT vec_id, [CAST(x AS DOUBLE) FOR x IN embedding] AS z FROM embeddings),
  e AS (SELECT vec_id, z, list_max(z) AS m FROM l),
  x AS (SELECT vec_id, z, m, [exp(v - m) FOR v IN z] AS ex FROM e)
  SELECT vec_id, CAST(list_position(z, m) - 1 AS INTEGER) AS best,
         ROUND(ex[list_position(z, m)] / list_sum(ex), 6) AS confidence,
         CAST(len(z) AS INTEGER) AS n_classes FROM x
""")
def q_softmax(spark, sf):
    """Every element of the array is a class."""
    e = table(spark, sf, "embeddings")
    z = F.transform("embedding", lambda x: x.cast("double"))
    probs, best, conf = models.softmax_argmax(z)
    return e.select("vec_id", best.cast("int").alias("best"), conf.alias("confidence"), F.size(z).alias("n_classes"))


@register("class_probabilities", """
  WITH l AS (SELECT vec_id, [CAST(x AS DOUBLE) FOR x IN embedding] AS z FROM embeddings),
  x AS (SELECT vec_id, z, [exp(v - list_max(z)) FOR v IN z] AS ex FROM l),
  p AS (SELECT vec_id, unnest(range(len(z))) AS class, unnest(ex) / list_sum(ex) AS p FROM x)
  SELECT vec_id, CAST(class AS INTEGER) AS class, ROUND(p, 6) AS probability FROM p
""")
def q_class_probabilities(spark, sf):
    """One row per class: the table beside the top prediction."""
    e = table(spark, sf, "embeddings")
    probs, _, _ = models.softmax_argmax(F.transform("embedding", lambda x: x.cast("double")))
    return e.select("vec_id", F.posexplode(probs).alias("class", "probability"))


# ------------------------------------------------------------------ price forecast (R)
def _bars_split(spark, sf):
    f = materialize(series.chrono_split(series.ohlc_features(series.daily_bars(table(spark, sf, "events")))))
    return f.where(F.col("part") == "train"), f.where(F.col("part") == "test"), f


def _forecast_models(spark, sf, fit=("lr", "rf")):
    """Scaled OLS and the forest on the bar features; only the models asked
    for are fitted (the forest is the expensive one)."""
    train, test, allf = _bars_split(spark, sf)
    from pyspark.ml import Pipeline
    asm = VectorAssembler(inputCols=BAR_FEATURES, outputCol="raw")
    scl = fx.PopulationScaler(inputCols=BAR_FEATURES, outputCols=[c + "_s" for c in BAR_FEATURES])
    asm_s = VectorAssembler(inputCols=[c + "_s" for c in BAR_FEATURES], outputCol="features")
    lr = Pipeline(stages=[scl, asm_s, models.linear_regression("target", "features")]).fit(train) \
        if "lr" in fit else None
    rf = Pipeline(stages=[asm, models.rf_regression("target", "raw")]).fit(train) if "rf" in fit else None
    return lr, rf, train, test, allf


@register("linear_regression")
def q_linear_regression(spark, sf):
    lr, _, _, test, _ = _forecast_models(spark, sf, fit=("lr",))
    return metrics.regression_metrics(lr.transform(test), "target", "prediction")


@register("rf_regression")
def q_rf_regression(spark, sf):
    _, rf, _, test, _ = _forecast_models(spark, sf, fit=("rf",))
    return metrics.regression_metrics(rf.transform(test), "target", "prediction")


@register("forecast_next")
def q_forecast_next(spark, sf):
    lr, rf, _, _, allf = _forecast_models(spark, sf)
    last = series.latest_row(allf)
    a = lr.transform(last).select("entity", F.col("close").alias("last_close"), F.col("prediction").alias("lr_next"))
    b = rf.transform(last).select("entity", F.col("prediction").alias("rf_next"))
    return a.join(b, "entity")


@register("feature_importance")
def q_feature_importance(spark, sf):
    _, rf, *_ = _forecast_models(spark, sf, fit=("rf",))
    imp = models.feature_importance(rf.stages[-1], BAR_FEATURES)
    return spark.createDataFrame(imp, "feature string, importance double")


# ------------------------------------------------------------------ heart stand-in (R)
HEART_NUM = ["o_totalprice", "c_acctbal", "c_nationkey", "prio", "order_year", "order_month"]


def heart_frame(spark, sf):
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer")
    j = o.join(c, o.o_custkey == c.c_custkey)
    return j.select("o_orderkey", "o_totalprice", "c_acctbal", F.col("c_nationkey").cast("double").alias("c_nationkey"),
                    F.substring("o_orderpriority", 1, 1).cast("double").alias("prio"),
                    F.year("o_orderdate").cast("double").alias("order_year"),
                    F.month("o_orderdate").cast("double").alias("order_month"),
                    (F.col("o_orderstatus") == "F").cast("int").alias("label"))


def _heart(spark, sf):
    h = sampling.stratified_split(heart_frame(spark, sf), "label", ["o_orderkey"])
    h = materialize(sampling.stratified_folds(h, "label", ["o_orderkey"], k=5, seed=11))
    return h.where(F.col("part") == "train"), h.where(F.col("part") == "test")


def _heart_stages():
    scl = fx.PopulationScaler(inputCols=HEART_NUM, outputCols=[c + "_s" for c in HEART_NUM])
    asm = VectorAssembler(inputCols=[c + "_s" for c in HEART_NUM], outputCol="features")
    return [scl, asm]


def _binary_summary(scored):
    s = materialize(models.predict_proba(scored).select("label", "prediction", "p1"))      # the model runs once
    auc = metrics.roc_auc(s, "label", "p1")
    acc = metrics.accuracy(s.withColumn("prediction", F.col("prediction").cast("int")), "label", "prediction")
    return acc.withColumn("auc", auc.select("auc").scalar())


@register("logistic_regression")
def q_logistic(spark, sf):
    from pyspark.ml import Pipeline
    train, test = _heart(spark, sf)
    n = train.count()
    m = Pipeline(stages=_heart_stages() + [models.logistic_regression(n)]).fit(train)
    return _binary_summary(m.transform(test))


# Names of the two order states (status not F, status F).
STATES = ["open", "finished"]


def _heart_tree(spark, train):
    """Assembled raw features and the pruned tree (min-split 10) as one pipeline model."""
    from pyspark.ml import Pipeline, PipelineModel
    grown = Pipeline(stages=[VectorAssembler(inputCols=HEART_NUM, outputCol="features"), models.decision_tree()]).fit(train)
    cut = trees.prune_min_split(spark, grown.stages[-1], scratch_path(spark, f"tree-{uuid.uuid4().hex}"), 10)
    return PipelineModel([grown.stages[0], cut])


def _heart_logistic(train):
    from pyspark.ml import Pipeline
    return Pipeline(stages=_heart_stages() + [models.logistic_regression(train.count())]).fit(train)


@register("decision_tree")
def q_decision_tree(spark, sf):
    train, test = _heart(spark, sf)
    return _binary_summary(_heart_tree(spark, train).transform(test))


@register("cross_val_score")
def q_cross_val(spark, sf):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    train, _ = _heart(spark, sf)
    n = train.count()
    cv = models.cross_val_score(_heart_stages(), models.logistic_regression(int(n * 0.8)),
                                MulticlassClassificationEvaluator(metricName="accuracy"), "fold").fit(train)
    return spark.createDataFrame([(float(cv.avgMetrics[0]), float(cv.stdMetrics[0]), 5)],
                                 "mean_accuracy double, std_accuracy double, folds int")


@register("model_selection")
def q_model_selection(spark, sf):
    """The library's exact AUC inside the by-fold search: one row per model and fold."""
    train, _ = _heart(spark, sf)
    asm = [VectorAssembler(inputCols=HEART_NUM, outputCol="features")]
    rows = []
    for name, stages, est in [("logistic_regression", _heart_stages(), models.logistic_regression(train.count())),
                              ("decision_tree", asm, models.decision_tree())]:
        got = models.grid_search_by_fold(stages, est, [{}], train, evaluator=models.exact_auc())
        rows += [(name, f, float(a)) for f, a in enumerate(got["folds"][0])]
    return spark.createDataFrame(rows, "model string, fold int, auc double")


@register("tree_rules")
def q_tree_rules(spark, sf):
    """One rule per leaf of the pruned tree, in the table's own columns."""
    train, _ = _heart(spark, sf)
    path = scratch_path(spark, f"rules-{uuid.uuid4().hex}")
    return trees.tree_rules(spark, _heart_tree(spark, train).stages[-1], path, HEART_NUM, STATES)


@register("fitted_comparison")
def q_fitted_comparison(spark, sf):
    """Held-out accuracy, F1 and AUC of the fitted models; the best by AUC is
    saved, loaded again, and must give the same AUC (``auc_loaded``)."""
    from pyspark.ml import Pipeline
    from ..sources import files
    train, test = _heart(spark, sf)
    asm = VectorAssembler(inputCols=HEART_NUM, outputCol="features")
    fitted = {"logistic_regression": _heart_logistic(train), "decision_tree": _heart_tree(spark, train),
              "gradient_boosting": Pipeline(stages=[asm, models.gbt_classifier(iters=20)]).fit(train)}
    auc = models.exact_auc()
    rows = []
    for name, m in fitted.items():
        s = materialize(models.predict_proba(m.transform(test)).select("label", F.col("prediction").cast("int").alias("pred"), "p1"))
        rows.append((name, metrics.accuracy(s, "label", "pred").first()["accuracy"], metrics.f1_binary(s, "label", "pred").first()["f1"],
                     auc.evaluate(s)))
    best = max(rows, key=lambda r: (r[3], r[0]))[0]
    path = scratch_path(spark, f"best-{uuid.uuid4().hex}")
    files.sink_model(fitted[best], path)
    again = auc.evaluate(files.source_model(path).transform(test))
    return spark.createDataFrame([(*r, r[0] == best, again if r[0] == best else None) for r in rows],
                                 "model string, accuracy double, f1 double, auc double, best boolean, auc_loaded double")


# Mixed columns of an order and its customer, with missing values on both kinds.
MIXED_NUM = ["o_totalprice", "balance"]
MIXED_CAT = ["segment", "o_orderpriority"]
MIXED_SQL = """
  (SELECT o_orderkey, CAST(o_totalprice AS DOUBLE) AS o_totalprice, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS balance,
          CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_mktsegment END AS segment, o_orderpriority,
          o_orderstatus = 'F' AS finished, md5(concat(CAST(o_orderkey AS VARCHAR), '|7')) < 'cc' AS train
   FROM orders JOIN customer ON o_custkey = c_custkey)
"""


def _mixed(spark, sf):
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    d = o.join(c, o.o_custkey == c.c_custkey).select(
        "o_orderkey", F.col("o_totalprice").cast("double").alias("o_totalprice"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("balance"),
        F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_mktsegment")).alias("segment"), "o_orderpriority",
        (F.col("o_orderstatus") == "F").cast("int").alias("label"), md5_key("o_orderkey", seed=7).alias("__k"))
    d = materialize(d)
    return d.where(F.col("__k") < "cc").drop("__k"), d.where(F.col("__k") >= "cc").drop("__k")


@register("classifier_importance")
def q_classifier_importance(spark, sf):
    """Forest importances and logistic |coefficients| by one-hot name, top 15 of each."""
    from pyspark.ml import Pipeline
    train, _ = _mixed(spark, sf)
    fm = Pipeline(stages=fx.column_transformer(MIXED_NUM, MIXED_CAT)).fit(train)
    rows = materialize(fm.transform(train).select("label", "features"))
    names = fx.feature_names(fm.transform(train.limit(1)))
    out = []
    for kind, est in [("random_forest", models.rf_classifier(trees=50, depth=8)),
                      ("logistic_regression", models.logistic_regression(rows.count()))]:
        imp = models.feature_importance(est.fit(rows), names)[:15]
        out += [(kind, i + 1, n, float(v)) for i, (n, v) in enumerate(imp)]
    return spark.createDataFrame(out, "model string, rank int, feature string, importance double")


@register("predict_proba")
def q_predict_proba(spark, sf):
    from pyspark.ml import Pipeline
    train, test = _heart(spark, sf)
    m = Pipeline(stages=_heart_stages() + [models.logistic_regression(train.count())]).fit(train)
    return models.predict_proba(m.transform(test)).select("o_orderkey", "label", "prediction", "p1", "confidence")


@register("score_new_rows")
def q_score_new_rows(spark, sf):
    """Every order not used in training, through both saved models: label text
    and confidence per model."""
    from ..sources import files
    train, test = _heart(spark, sf)
    out = None
    for name, m in [("logistic_regression", _heart_logistic(train)), ("decision_tree", _heart_tree(spark, train))]:
        path = scratch_path(spark, f"heart-{uuid.uuid4().hex}")
        files.sink_model(m, path)
        s = models.predict_proba(files.source_model(path).transform(test))
        s = s.select("o_orderkey", F.lit(name).alias("model"),
                     F.when(F.col("prediction") == 1, STATES[1]).otherwise(STATES[0]).alias("label_text"), "confidence")
        out = s if out is None else out.unionByName(s)
    return out


# ------------------------------------------------------------------ customers (R)
CUSTOMER_NUM = ["balance", "n_orders", "total"]
CUSTOMER_CAT = ["segment", "nation"]


def _customers(spark, sf):
    """Customers with orders: missing values on both kinds of column; label 1 if
    at least half of their orders are finished.  Split and folds by label."""
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    per = o.groupBy("o_custkey").agg(F.count("*").cast("double").alias("n_orders"), F.sum("o_totalprice").alias("total"),
                                     F.avg((F.col("o_orderstatus") == "F").cast("double")).alias("__f"))
    d = c.join(per, c.c_custkey == per.o_custkey).select(
        "c_custkey", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("balance"), "n_orders", "total",
        F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_mktsegment")).alias("segment"),
        F.col("c_nationkey").cast("string").alias("nation"), (F.col("__f") >= 0.5).cast("int").alias("label"))
    d = sampling.stratified_split(materialize(d), "label", ["c_custkey"])
    d = materialize(sampling.stratified_folds(d, "label", ["c_custkey"], 5, seed=3))
    return d.where(F.col("part") == "train"), d.where(F.col("part") == "test")


def _mixed_sql(body):
    """DuckDB: fitted on the training rows (medians, population scale, modes,
    categories); modes by count, then smallest."""
    mode = lambda c: (f"(SELECT {c} FROM m WHERE train AND {c} IS NOT NULL GROUP BY 1 "  # noqa: E731
                      f"ORDER BY count(*) DESC, {c} LIMIT 1)")
    num = ", ".join(f"coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM m WHERE train)) AS {c}" for c in MIXED_NUM)
    cat = ", ".join(f"coalesce({c}, {mode(c)}) AS {c}" for c in MIXED_CAT)
    return f"WITH m AS MATERIALIZED {MIXED_SQL}, f AS (SELECT o_orderkey, train, {num}, {cat} FROM m) {body}"


# The segments (without the one made missing) and priorities of the tables.
MIXED_VALUES = {"segment": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"],
                "o_orderpriority": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]}
MIXED_NAMES = MIXED_NUM + [f"{c}_{v}" for c, vs in MIXED_VALUES.items() for v in vs]


@register("column_transformer", _mixed_sql("SELECT o_orderkey, " + ", ".join(
    [f"ROUND(({c} - (SELECT avg({c}) FROM f WHERE train)) / (SELECT stddev_pop({c}) FROM f WHERE train), 6) AS f{i}"
     for i, c in enumerate(MIXED_NUM)]
    + [f"CASE WHEN {c} = '{v}' THEN 1.0 ELSE 0.0 END AS f{i + len(MIXED_NUM)}"
       for i, (c, v) in enumerate((c, v) for c, vs in MIXED_VALUES.items() for v in vs)]) + " FROM f WHERE NOT train"))
def q_column_transformer(spark, sf):
    """Every assembled feature of the held-out orders."""
    from pyspark.ml import Pipeline
    train, test = _mixed(spark, sf)
    out = Pipeline(stages=fx.column_transformer(MIXED_NUM, MIXED_CAT)).fit(train).transform(test)
    a = vector_to_array("features")
    return out.select("o_orderkey", *[F.get(a, i).alias(f"f{i}") for i in range(len(MIXED_NAMES))])


@register("feature_names", _mixed_sql(
    "SELECT CAST(row_number() OVER (ORDER BY k, v) - 1 AS INTEGER) AS idx, name FROM ("
    + " UNION ALL ".join([f"SELECT {i} AS k, '' AS v, '{c}' AS name" for i, c in enumerate(MIXED_NUM)]
                         + [f"SELECT DISTINCT {i + len(MIXED_NUM)}, {c}, concat('{c}_', {c}) FROM f WHERE train"
                            for i, c in enumerate(MIXED_CAT)]) + ")"))
def q_feature_names(spark, sf):
    from pyspark.ml import Pipeline
    train, _ = _mixed(spark, sf)
    m = Pipeline(stages=fx.column_transformer(MIXED_NUM, MIXED_CAT)).fit(train)
    names = fx.feature_names(m.transform(train.limit(1)))
    return spark.createDataFrame(list(enumerate(names)), "idx int, name string")


@register("rf_classifier")
def q_rf_classifier(spark, sf):
    from pyspark.ml import Pipeline
    train, test = _customers(spark, sf)
    train = deal(train, "c_custkey")
    m = Pipeline(stages=fx.column_transformer(CUSTOMER_NUM, CUSTOMER_CAT) + [models.rf_classifier()]).fit(train)
    return _binary_summary(m.transform(test))


@register("grid_search")
def q_grid_search(spark, sf):
    train, test = _customers(spark, sf)
    n = train.count()
    lr = models.logistic_regression(int(n * 0.8))
    maps = models.grid_maps(lr, int(n * 0.8), Cs=[0.01, 0.1, 1.0, 10.0, 100.0])
    res = models.grid_search_by_fold(fx.column_transformer(CUSTOMER_NUM, CUSTOMER_CAT), lr, maps, train,
                                     evaluator=models.exact_auc())
    i, pm = res["best_index"], res["best_params"]
    test_auc = metrics.roc_auc(models.predict_proba(res["model"].transform(test)), "label", "p1").first()[0]
    return spark.createDataFrame([(i, float(res["avg"][i]), float(res["std"][i]),
                                   float(pm[lr.regParam]), float(pm[lr.elasticNetParam]), float(test_auc or 0.0))],
                                 "best_index int, cv_auc double, cv_auc_std double, reg_param double, "
                                 "elastic_net double, test_auc double")


@register("sink_model", _mixed_sql("SELECT o_orderkey, train, " + ", ".join(
    [f"ROUND(({c} - (SELECT avg({c}) FROM f WHERE train)) / (SELECT stddev_pop({c}) FROM f WHERE train), 6) AS f{i}"
     for i, c in enumerate(MIXED_NUM)]
    + [f"CASE WHEN {c} = '{v}' THEN 1.0 ELSE 0.0 END AS f{i + len(MIXED_NUM)}"
       for i, (c, v) in enumerate((c, v) for c, vs in MIXED_VALUES.items() for v in vs)]) + " FROM f"))
def q_sink_model(spark, sf):
    """Persist the fitted feature pipeline to the shared folder, load it back,
    and score every order with the loaded copy."""
    from pyspark.ml import Pipeline
    from ..sources import files
    train, test = _mixed(spark, sf)
    path = scratch_path(spark, f"order-features-{uuid.uuid4().hex}")
    files.sink_model(Pipeline(stages=fx.column_transformer(MIXED_NUM, MIXED_CAT)).fit(train), path)
    rows = train.withColumn("train", F.lit(True)).unionByName(test.withColumn("train", F.lit(False)))
    a = vector_to_array("features")
    return files.source_model(path).transform(rows).select(
        "o_orderkey", "train", *[F.get(a, i).alias(f"f{i}") for i in range(len(MIXED_NAMES))])


@register("verify_roundtrip", "SELECT CAST(ceil(CAST(count(*) AS DOUBLE) * 0.2) AS BIGINT) AS n_rows, "
          "CAST(0 AS BIGINT) AS n_diff, true AS same_auc FROM orders JOIN customer ON o_custkey = c_custkey")
def q_verify_roundtrip(spark, sf):
    """Save the fitted order pipeline, load it back, score the held-out rows with
    both: differing predictions must be 0 and AUC equal."""
    from ..sources import files
    train, test = _heart(spark, sf)
    m = _heart_logistic(train)
    path = scratch_path(spark, f"orders-{uuid.uuid4().hex}")
    files.sink_model(m, path)
    a = models.predict_proba(m.transform(test)).select("o_orderkey", "label", F.col("p1").alias("p_a"))
    b = models.predict_proba(files.source_model(path).transform(test)).select("o_orderkey", F.col("p1").alias("p_b"))
    j = materialize(a.join(b, "o_orderkey"))
    d = j.agg(F.count(F.lit(1)).alias("n_rows"), F.sum((F.col("p_a") != F.col("p_b")).cast("long")).alias("n_diff"))
    before, after = metrics.roc_auc(j, "label", "p_a").first()[0], metrics.roc_auc(j, "label", "p_b").first()[0]
    return d.withColumn("same_auc", F.lit(before is not None and before == after))


# ------------------------------------------------------------------ parts (R)
PART_FEATURES = ["p_retailprice", "p_size", "n_lines", "quantity", "discount", "tax"]


def _parts(spark, sf):
    """Parts with their lines summed up: what they brought in, and what tells it."""
    li, p = table(spark, sf, "lineitem"), table(spark, sf, "part")
    per = li.groupBy("l_partkey").agg(
        F.count("*").cast("double").alias("n_lines"), F.avg("l_quantity").alias("quantity"),
        F.avg("l_discount").alias("discount"), F.avg("l_tax").alias("tax"), F.sum("l_extendedprice").alias("price"))
    d = p.join(per, p.p_partkey == per.l_partkey).select(
        "p_partkey", F.col("p_retailprice").cast("double").alias("p_retailprice"),
        F.col("p_size").cast("double").alias("p_size"), "n_lines", "quantity", "discount", "tax", "price")
    d = sampling.random_split(materialize(d), ["p_partkey"], 0.2, seed=42)
    d = materialize(d.withColumn("log_price", F.log1p("price")))
    return d.where(F.col("part") == "train"), d.where(F.col("part") == "test")


@register("gbt_regression")
def q_gbt(spark, sf):
    from pyspark.ml import Pipeline
    train, test = _parts(spark, sf)
    m = Pipeline(stages=[fx.assemble_features(PART_FEATURES), models.gbt_regression("log_price")]).fit(train)
    p = m.transform(test).withColumn("pred_price", F.expm1("prediction"))
    return metrics.regression_metrics(p, "price", "pred_price")


@register("huber_regression")
def q_huber_regression(spark, sf):
    from pyspark.ml import Pipeline
    train, test = _parts(spark, sf)
    scl = fx.PopulationScaler(inputCols=PART_FEATURES, outputCols=[c + "_s" for c in PART_FEATURES])
    m = Pipeline(stages=[scl, fx.assemble_features([c + "_s" for c in PART_FEATURES]),
                         models.huber_regression("log_price")]).fit(train)
    p = m.transform(test).withColumn("pred_price", F.expm1("prediction"))
    return metrics.regression_metrics(p, "price", "pred_price")


@register("learning_curve")
def q_learning_curve(spark, sf):
    """Train and held-out loss of every prefix of a boosted regressor (200 trees)."""
    from pyspark.ml import Pipeline
    train, test = _parts(spark, sf)
    m = Pipeline(stages=[fx.assemble_features(PART_FEATURES), models.gbt_regression("log_price", iters=200)]).fit(train)
    return trees.learning_curve(spark, m.stages[-1], m.stages[0].transform(train.unionByName(test)),
                                scratch_path(spark, f"curve-{uuid.uuid4().hex}"), "log_price")


@register("learning_curve_classes")
def q_learning_curve_classes(spark, sf):
    """Loss, accuracy and F1 of every prefix of a boosted classifier, on both parts."""
    train, test = _heart(spark, sf)
    asm = VectorAssembler(inputCols=HEART_NUM, outputCol="features")
    m = models.gbt_classifier(iters=50).fit(asm.transform(train))
    return trees.learning_curve(spark, m, asm.transform(train.unionByName(test)),
                                scratch_path(spark, f"curve-{uuid.uuid4().hex}"))


# ------------------------------------------------------------------ news stand-in (R)
# Language code -> class id (four classes, like the four news topics).
LANGS = ["de", "en", "es", "fr"]


def _docs(spark, sf):
    d = table(spark, sf, "documents")
    m = F.create_map(*[x for i, l in enumerate(LANGS) for x in (F.lit(l), F.lit(float(i)))])
    d = d.withColumn("label", m[F.col("lang")]).where(F.col("label").isNotNull())
    d = materialize(sampling.stratified_split(d, "lang", ["doc_id"], 0.2, seed=42))
    return d.where(F.col("part") == "train"), d.where(F.col("part") == "test")


@register("text_tfidf", """
  WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '([a-z]+)', 1) AS toks,
                    md5(concat(CAST(doc_id AS VARCHAR), '|7')) < 'cc' AS train FROM documents),
  n AS (SELECT count(*) AS n FROM d WHERE train),
  df AS (SELECT token, count(*) AS docs FROM (SELECT doc_id, unnest(list_distinct(toks)) AS token FROM d WHERE train) GROUP BY 1),
  v AS (SELECT token, CAST(row_number() OVER (ORDER BY docs DESC, md5(token)) - 1 AS INTEGER) AS idx,
               ln(CAST(n + 1 AS DOUBLE) / (docs + 1)) AS idf FROM df, n),
  tf AS (SELECT doc_id, token, count(*) AS tf FROM (SELECT doc_id, unnest(toks) AS token FROM d WHERE NOT train) GROUP BY 1, 2)
  SELECT doc_id, token, idx, tf, ROUND(tf * idf, 6) AS weight FROM tf JOIN v USING (token)
""")
def q_text_tfidf(spark, sf):
    """Weights of the held-out documents under the training documents' vocabulary."""
    d = table(spark, sf, "documents").select("doc_id", "text", md5_key("doc_id", seed=7).alias("__k"))
    vocab = fx.tfidf_vocabulary(d.where(F.col("__k") < "cc"))
    return fx.tfidf_weights(d.where(F.col("__k") >= "cc"), vocab, "doc_id")


@register("text_classifier")
def q_text_classifier(spark, sf):
    train, test = _docs(spark, sf)
    vocab = fx.tfidf_vocabulary(train)
    m = models.text_classifier(4).fit(fx.tfidf_vectors(train.select("text", "label"), vocab))
    p = m.transform(fx.tfidf_vectors(test.select("text", "label"), vocab))
    return metrics.classification_report(p.withColumn("y", F.col("label").cast("int"))
                                          .withColumn("pred", F.col("prediction").cast("int")), "y", "pred")


@register("assemble_features", "SELECT l_orderkey, l_linenumber, ROUND(l_quantity, 6) AS f0, "
          "ROUND(l_extendedprice, 6) AS f1, ROUND(l_discount, 6) AS f2, ROUND(l_tax, 6) AS f3 FROM lineitem")
def q_assemble(spark, sf):
    out = fx.assemble_features(["l_quantity", "l_extendedprice", "l_discount", "l_tax"]).transform(table(spark, sf, "lineitem"))
    a = vector_to_array("features")
    return out.select("l_orderkey", "l_linenumber", *[F.get(a, i).alias(f"f{i}") for i in range(4)])
