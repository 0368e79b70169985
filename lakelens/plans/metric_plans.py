"""§2.13 metrics over rule-based predictions on lineitem (deterministic scorers)."""

from pyspark.sql import functions as F

from ..operators import metrics, tables
from .registry import register, table

LABELS = ["A", "N", "R"]

SCORED_SQL = """
  (SELECT l_orderkey, l_linenumber, l_returnflag AS y,
          CASE WHEN l_discount > 0.05 THEN 'R' WHEN l_tax > 0.04 THEN 'A' ELSE 'N' END AS pred,
          CAST(l_returnflag = 'R' AS INTEGER) AS yb,
          CAST(l_quantity > 25 AS INTEGER) AS pb,
          CAST(l_quantity AS DOUBLE) AS score,
          CAST(l_extendedprice AS DOUBLE) AS y_reg,
          CAST(l_quantity AS DOUBLE) * 2000.0 AS p_reg,
          l_tax * 100 AS y_h, l_discount * 100 AS p_h
   FROM lineitem)
"""


def scored(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber", F.col("l_returnflag").alias("y"),
        F.when(F.col("l_discount") > 0.05, "R").when(F.col("l_tax") > 0.04, "A").otherwise("N").alias("pred"),
        (F.col("l_returnflag") == "R").cast("int").alias("yb"),
        (F.col("l_quantity") > 25).cast("int").alias("pb"),
        F.col("l_quantity").cast("double").alias("score"),
        F.col("l_extendedprice").cast("double").alias("y_reg"),
        (F.col("l_quantity").cast("double") * 2000.0).alias("p_reg"),
        (F.col("l_tax") * 100).alias("y_h"), (F.col("l_discount") * 100).alias("p_h"))


@register("regression_metrics", f"""
  SELECT CAST(count(*) AS BIGINT) AS n, ROUND(avg(abs(p_reg - y_reg)), 6) AS mae,
         ROUND(sqrt(avg((p_reg - y_reg) * (p_reg - y_reg))), 6) AS rmse,
         ROUND(1 - sum((p_reg - y_reg) * (p_reg - y_reg)) / (var_pop(y_reg) * count(*)), 6) AS r2
  FROM {SCORED_SQL}
""")
def q_regression_metrics(spark, sf):
    return metrics.regression_metrics(scored(spark, sf), "y_reg", "p_reg")


@register("huber_loss", f"""
  SELECT ROUND(avg(CASE WHEN abs(p_h - y_h) <= 1.0 THEN 0.5 * abs(p_h - y_h) * abs(p_h - y_h)
                   ELSE 1.0 * (abs(p_h - y_h) - 0.5 * 1.0) END), 6) AS huber_loss FROM {SCORED_SQL}
""")
def q_huber(spark, sf):
    return metrics.huber_loss(scored(spark, sf), "y_h", "p_h", 1.0)


@register("residuals", f"""
  SELECT l_orderkey, l_linenumber, ROUND(y_reg, 6) AS y_reg, ROUND(p_reg, 6) AS p_reg,
         ROUND(p_reg - y_reg, 6) AS residual FROM {SCORED_SQL}
""")
def q_residuals(spark, sf):
    return metrics.residuals(scored(spark, sf), "y_reg", "p_reg").select(
        "l_orderkey", "l_linenumber", "y_reg", "p_reg", "residual")


@register("confusion_matrix", f"""
  SELECT y AS truth, {", ".join(f"CAST(count(*) FILTER (WHERE pred = '{v}') AS BIGINT) AS \"{v}\"" for v in LABELS)}
  FROM {SCORED_SQL} GROUP BY 1
""")
def q_confusion(spark, sf):
    return metrics.confusion_matrix(scored(spark, sf), LABELS, "y", "pred")


@register("accuracy", f"SELECT ROUND(avg(CAST(y = pred AS DOUBLE)), 6) AS accuracy FROM {SCORED_SQL}")
def q_accuracy(spark, sf):
    return metrics.accuracy(scored(spark, sf), "y", "pred")


@register("f1_binary", f"""
  SELECT ROUND(CASE WHEN 2 * sum(yb * pb) + sum((1 - yb) * pb) + sum(yb * (1 - pb)) = 0 THEN 0.0
         ELSE 2.0 * sum(yb * pb) / (2 * sum(yb * pb) + sum((1 - yb) * pb) + sum(yb * (1 - pb))) END, 6) AS f1
  FROM {SCORED_SQL}
""")
def q_f1_binary(spark, sf):
    return metrics.f1_binary(scored(spark, sf), "yb", "pb", 1)


PER_CLASS_SQL = f"""
  WITH s AS {SCORED_SQL},
  t AS (SELECT y AS label, count(*) AS support, sum(CAST(y = pred AS BIGINT)) AS tp FROM s GROUP BY 1),
  p AS (SELECT pred AS label, count(*) AS n_pred FROM s GROUP BY 1),
  c AS (SELECT coalesce(t.label, p.label) AS label, coalesce(tp, 0) AS tp,
               coalesce(n_pred, 0) - coalesce(tp, 0) AS fp, coalesce(support, 0) - coalesce(tp, 0) AS fn,
               coalesce(support, 0) AS support FROM t FULL OUTER JOIN p ON t.label = p.label)
  SELECT label,
         CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END AS precision,
         CASE WHEN tp + fn = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fn) END AS recall,
         CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2.0 * tp / (2 * tp + fp + fn) END AS f1,
         CAST(support AS BIGINT) AS support FROM c
"""


@register("per_class_f1", f"SELECT label, ROUND(f1, 6) AS f1, support FROM ({PER_CLASS_SQL})")
def q_per_class_f1(spark, sf):
    return metrics.per_class_f1(scored(spark, sf), "y", "pred")


@register("f1_weighted", f"""
  SELECT ROUND(sum(f1 * support) / sum(support), 6) AS f1_weighted FROM ({PER_CLASS_SQL})
""")
def q_f1_weighted(spark, sf):
    return metrics.f1_weighted(scored(spark, sf), "y", "pred")


@register("classification_report", f"""
  WITH pc AS ({PER_CLASS_SQL}),
  a AS (SELECT avg(CAST(y = pred AS DOUBLE)) AS acc FROM {SCORED_SQL})
  SELECT label, ROUND(precision, 6) AS precision, ROUND(recall, 6) AS recall, ROUND(f1, 6) AS f1, support FROM pc
  UNION ALL SELECT 'accuracy', ROUND(acc, 6), ROUND(acc, 6), ROUND(acc, 6), (SELECT CAST(sum(support) AS BIGINT) FROM pc) FROM a
  UNION ALL SELECT 'macro avg', ROUND(avg(precision), 6), ROUND(avg(recall), 6), ROUND(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM pc
  UNION ALL SELECT 'weighted avg', ROUND(sum(precision * support) / sum(support), 6),
         ROUND(sum(recall * support) / sum(support), 6), ROUND(sum(f1 * support) / sum(support), 6),
         CAST(sum(support) AS BIGINT) FROM pc
""")
def q_report(spark, sf):
    return metrics.classification_report(scored(spark, sf), "y", "pred")


AUC_SQL = """
  WITH s AS (SELECT {score} AS score, sum({y}) AS pos, sum(1 - {y}) AS neg FROM {src} GROUP BY 1),
  c AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                  AS neg_below FROM s)
  SELECT ROUND(CASE WHEN sum(pos) * sum(neg) = 0 THEN NULL
               ELSE sum(CAST(pos AS DOUBLE) * (CAST(neg_below AS DOUBLE) + neg / 2.0))
                    / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) END, 6) AS auc FROM c
"""


@register("roc_auc", AUC_SQL.format(score="score", y="yb", src=SCORED_SQL))
def q_roc_auc(spark, sf):
    return metrics.roc_auc(scored(spark, sf), "yb", "score")


@register("roc_curve", f"""
  WITH s AS (SELECT score, sum(yb) AS pos, sum(1 - yb) AS neg FROM {SCORED_SQL} GROUP BY 1),
  c AS (SELECT score, sum(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS tps,
               sum(neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS fps,
               sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM s),
  k AS (SELECT *, lag(fps) OVER o AS pf, lead(fps) OVER o AS nf, lag(tps) OVER o AS pt, lead(tps) OVER o AS nt
        FROM c WINDOW o AS (ORDER BY score DESC))
  SELECT ROUND(score, 6) AS threshold, ROUND(CAST(fps AS DOUBLE) / N, 6) AS fpr, ROUND(CAST(tps AS DOUBLE) / P, 6) AS tpr
  FROM k WHERE pf IS NULL OR nf IS NULL OR NOT (fps - pf = nf - fps AND tps - pt = nt - tps)
  UNION ALL SELECT CAST('inf' AS DOUBLE), 0.0, 0.0
""")
def q_roc_curve(spark, sf):
    return metrics.roc_curve(scored(spark, sf), "yb", "score")


MODELS = {"quantity": "l_quantity", "price": "l_extendedprice", "discount": "l_discount"}


def _models_long(spark, sf):
    li = table(spark, sf, "lineitem")
    parts = F.array(*[F.struct(F.lit(m).alias("model"), F.col(c).cast("double").alias("score"),
                               F.lit(i).alias("position")) for i, (m, c) in enumerate(MODELS.items())])
    return li.select((F.col("l_returnflag") == "R").cast("int").alias("y"), F.explode(parts).alias("m")) \
             .select("y", "m.*")


def _models_sql():
    parts = []
    for i, (m, c) in enumerate(MODELS.items()):
        parts.append(f"SELECT '{m}' AS model, {i} AS position, CAST({c} AS DOUBLE) AS score, "
                     f"CAST(l_returnflag = 'R' AS INTEGER) AS y FROM lineitem")
    return "(" + " UNION ALL ".join(parts) + ")"


MODEL_CMP_SQL = f"""
  WITH m AS {_models_sql()},
  med AS (SELECT model, quantile_cont(score, 0.5) AS thr FROM m GROUP BY 1),
  p AS (SELECT m.*, CAST(score > thr AS INTEGER) AS pred FROM m JOIN med ON m.model = med.model),
  s AS (SELECT model, score, sum(y) AS pos, sum(1 - y) AS neg FROM m GROUP BY 1, 2),
  c AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY model ORDER BY score
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb FROM s),
  auc AS (SELECT model, sum(CAST(pos AS DOUBLE) * (CAST(nb AS DOUBLE) + neg / 2.0))
                 / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) AS auc FROM c GROUP BY 1),
  acc AS (SELECT model, min(position) AS position, avg(CAST(y = pred AS DOUBLE)) AS accuracy,
                 CASE WHEN 2 * sum(y * pred) + sum((1 - y) * pred) + sum(y * (1 - pred)) = 0 THEN 0.0
                 ELSE 2.0 * sum(y * pred) / (2 * sum(y * pred) + sum((1 - y) * pred) + sum(y * (1 - pred))) END AS f1
          FROM p GROUP BY 1)
  SELECT acc.model, position, accuracy, f1, auc FROM acc JOIN auc ON acc.model = auc.model
"""


def model_comparison_frame(spark, sf):
    """Per model: accuracy and F1 at the median-score threshold, and exact AUC."""
    from ..functions.keys import exact_quantiles, grouped_prefix_sums
    m = _models_long(spark, sf)
    thr = exact_quantiles(m, "score", [0.5], ["model"], names=["thr"])
    p = m.join(F.broadcast(thr), "model").withColumn("pred", (F.col("score") > F.col("thr")).cast("int"))
    yb, pb = F.col("y"), F.col("pred")
    tp, fp, fn = F.sum(yb * pb), F.sum((1 - yb) * pb), F.sum(yb * (1 - pb))
    from ..functions.common import safe_div
    acc = p.groupBy("model").agg(F.min("position").alias("position"),
                                 F.avg((yb == pb).cast("double")).alias("accuracy"),
                                 F.coalesce(safe_div(2 * tp, 2 * tp + fp + fn), F.lit(0.0)).alias("f1"))
    sc = m.groupBy("model", "score").agg(F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg"))
    ps = grouped_prefix_sums(sc, "score", ["neg"], ["model"], inclusive=False)
    auc = ps.groupBy("model").agg(
        safe_div(F.sum(F.col("pos").cast("double") * (F.col("cum_neg").cast("double") + F.col("neg") / 2.0)),
                 F.sum("pos").cast("double") * F.sum("neg").cast("double")).alias("auc"))
    return acc.join(auc, "model")


@register("model_comparison", f"""
  SELECT model, CAST(position AS INTEGER) AS position, ROUND(accuracy, 6) AS accuracy, ROUND(f1, 6) AS f1,
         ROUND(auc, 6) AS auc FROM ({MODEL_CMP_SQL})
""")
def q_model_comparison(spark, sf):
    return model_comparison_frame(spark, sf)


@register("best_model", f"""
  SELECT arg_max(model, auc) AS best_model, ROUND(max(auc), 6) AS best_auc FROM ({MODEL_CMP_SQL})
""")
def q_best_model(spark, sf):
    return tables.argmax_group(model_comparison_frame(spark, sf), "model", "auc", "position")


ORDER_PRED = "CASE WHEN o_totalprice >= 150000 THEN 'O' ELSE 'F' END"

TRUTH_PRED_SQL = f"""
  SELECT t.o_orderkey, t.y, p.pred
  FROM (SELECT o_orderkey, o_orderstatus AS y FROM orders) t
  JOIN (SELECT o_orderkey, {ORDER_PRED} AS pred FROM orders) p ON t.o_orderkey = p.o_orderkey
"""


@register("join_truth_prediction", TRUTH_PRED_SQL)
def q_join_truth_prediction(spark, sf):
    """Truth and predictions held apart are aligned by a unique key, never by
    position: an equi-join on o_orderkey (both sides grow with the data, so a
    shuffle join; AQE may pick broadcast only from measured sizes).  When
    predictions come from ``transform`` they are already on the row and no
    join is planned."""
    o = table(spark, sf, "orders")
    truth = o.select("o_orderkey", F.col("o_orderstatus").alias("y"))
    pred = o.select("o_orderkey", F.when(F.col("o_totalprice") >= 150000, "O").otherwise("F").alias("pred"))
    return truth.join(pred, "o_orderkey", "inner")


@register("metric_fn", f"""
  SELECT 'accuracy' AS metric, accuracy AS value
    FROM (SELECT ROUND(avg(CAST(y = pred AS DOUBLE)), 6) AS accuracy FROM {SCORED_SQL})
  UNION ALL
  SELECT 'roc_auc', auc FROM ({AUC_SQL.format(score="score", y="yb", src=SCORED_SQL)})
  UNION ALL
  SELECT 'f1', f1 FROM (SELECT ROUND(CASE WHEN 2 * sum(yb * pb) + sum((1 - yb) * pb) + sum(yb * (1 - pb)) = 0
         THEN 0.0 ELSE 2.0 * sum(yb * pb) / (2 * sum(yb * pb) + sum((1 - yb) * pb) + sum(yb * (1 - pb))) END, 6)
         AS f1 FROM {SCORED_SQL})
""")
def q_metric_fn(spark, sf):
    """Scorers picked by name, as model selection does with ``scoring=``."""
    from ..functions.udf import score_by_name
    s = scored(spark, sf)
    parts = [score_by_name(s, "accuracy", y="y", pred="pred"),
             score_by_name(s, "roc_auc", y="yb", score="score"),
             score_by_name(s, "f1", y="yb", pred="pb")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
