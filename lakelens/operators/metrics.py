"""Evaluation metrics as plain aggregates: exact and oracle-checkable."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.common import safe_div
from ..functions.keys import prefix_sums


def _r2(sse: Column, sst: Column) -> Column:
    # constant truth: 1.0 when the fit is perfect, else 0.0 (as scikit-learn)
    return (F.when(sst == 0, F.when(sse == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
            .otherwise(F.lit(1.0) - safe_div(sse, sst)))


def regression_metrics(df: DataFrame, y: str = "y", pred: str = "pred",
                       group_cols: list[str] | tuple = ()) -> DataFrame:
    """n, MAE, RMSE, R^2 (R^2 from the stable centred variance), per group if given,
    over the rows where truth and prediction are both present."""
    df = df.where(F.col(y).isNotNull() & F.col(pred).isNotNull())
    e = F.col(pred).cast("double") - F.col(y).cast("double")
    agg = df.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(e)).alias("mae"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.sum(e * e).alias("__sse"),
        (F.var_pop(F.col(y).cast("double")) * F.count(F.lit(1))).alias("__sst"),
    )
    return agg.withColumn("r2", _r2(F.col("__sse"), F.col("__sst"))).drop("__sse", "__sst")


def huber_loss(df: DataFrame, y: str = "y", pred: str = "pred", delta: float = 1.0) -> DataFrame:
    e = F.abs(F.col(pred).cast("double") - F.col(y).cast("double"))
    loss = F.when(e <= delta, 0.5 * e * e).otherwise(delta * (e - 0.5 * delta))
    return df.agg(F.avg(loss).alias("huber_loss"))


def accuracy(df: DataFrame, y: str = "y", pred: str = "pred") -> DataFrame:
    return df.agg(F.avg((F.col(y) == F.col(pred)).cast("double")).alias("accuracy"))


def confusion_long(df: DataFrame, y: str = "y", pred: str = "pred") -> DataFrame:
    return df.groupBy(F.col(y).alias("truth"), F.col(pred).alias("predicted")) \
             .agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(df: DataFrame, labels: list, y: str = "y", pred: str = "pred") -> DataFrame:
    """truth x prediction counts, one column per label (explicit values: no extra job).
    A NULL truth is a row of its own; predictions outside ``labels`` have no column."""
    return (df.groupBy(F.col(y).alias("truth"))
            .pivot(pred, labels).agg(F.count(F.lit(1))).fillna(0, subset=[str(x) for x in labels]))


def class_counts(df: DataFrame, y: str = "y", pred: str = "pred") -> DataFrame:
    """Per class: tp, fp, fn, support — from two group-bys joined on class."""
    t = df.groupBy(F.col(y).alias("label")).agg(
        F.count(F.lit(1)).alias("support"),
        F.sum((F.col(y) == F.col(pred)).cast("long")).alias("tp"))
    p = df.groupBy(F.col(pred).alias("label")).agg(F.count(F.lit(1)).alias("n_pred"))
    j = t.join(p, "label", "full_outer")
    return j.select("label",
                    F.coalesce("tp", F.lit(0)).alias("tp"),
                    (F.coalesce("n_pred", F.lit(0)) - F.coalesce("tp", F.lit(0))).alias("fp"),
                    (F.coalesce("support", F.lit(0)) - F.coalesce("tp", F.lit(0))).alias("fn"),
                    F.coalesce("support", F.lit(0)).alias("support"))


def _prf(c: DataFrame) -> DataFrame:
    p = F.coalesce(safe_div(F.col("tp"), F.col("tp") + F.col("fp")), F.lit(0.0))
    r = F.coalesce(safe_div(F.col("tp"), F.col("tp") + F.col("fn")), F.lit(0.0))
    f1 = F.coalesce(safe_div(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")), F.lit(0.0))
    return c.select(F.col("label").cast("string").alias("label"),
                    p.alias("precision"), r.alias("recall"), f1.alias("f1"), "support")


def per_class_f1(df: DataFrame, y: str = "y", pred: str = "pred") -> DataFrame:
    return _prf(class_counts(df, y, pred)).select("label", "f1", "support")


def classification_report(df: DataFrame, y: str = "y", pred: str = "pred") -> DataFrame:
    """precision/recall/F1/support per class, then accuracy, macro avg, weighted avg rows.

    Undefined precision or recall is 0.  The 'accuracy' row carries accuracy in
    precision, recall and f1 and the total support, as scikit-learn prints it.
    """
    per = _prf(class_counts(df, y, pred))
    tot = per.agg(
        F.sum("support").alias("n"),
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
        safe_div(F.sum(F.col("precision") * F.col("support")), F.sum("support")).alias("wp"),
        safe_div(F.sum(F.col("recall") * F.col("support")), F.sum("support")).alias("wr"),
        safe_div(F.sum(F.col("f1") * F.col("support")), F.sum("support")).alias("wf"))
    acc = df.select(F.avg((F.col(y) == F.col(pred)).cast("double"))).scalar()
    summary = tot.withColumn("acc", acc)                              # scalar subquery, no join
    def row(name, p, r, f):
        return F.struct(F.lit(name).alias("label"), F.col(p).alias("precision"), F.col(r).alias("recall"),
                        F.col(f).alias("f1"), F.col("n").alias("support"))
    rows = summary.select(F.explode(F.array(
        row("accuracy", "acc", "acc", "acc"), row("macro avg", "mp", "mr", "mf"),
        row("weighted avg", "wp", "wr", "wf"))).alias("r")).select("r.*")
    return per.unionByName(rows)


def f1_binary(df: DataFrame, y: str = "y", pred: str = "pred", positive=1) -> DataFrame:
    yp = (F.col(y) == F.lit(positive))
    pp = (F.col(pred) == F.lit(positive))
    tp = F.sum((yp & pp).cast("long"))
    fp = F.sum((~yp & pp).cast("long"))
    fn = F.sum((yp & ~pp).cast("long"))
    return df.agg(F.coalesce(safe_div(2 * tp, 2 * tp + fp + fn), F.lit(0.0)).alias("f1"))


def f1_weighted(df: DataFrame, y: str = "y", pred: str = "pred") -> DataFrame:
    per = per_class_f1(df, y, pred)
    return per.agg(safe_div(F.sum(F.col("f1") * F.col("support")), F.sum("support")).alias("f1_weighted"))


def score_counts(df: DataFrame, y: str = "y", score: str = "score") -> DataFrame:
    """Distinct score -> (pos, neg): the only input ROC and AUC need.  Rows
    without a score or a truth are left out."""
    df = df.where(F.col(score).isNotNull() & F.col(y).isNotNull())
    return df.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.sum((F.col(y) == 1).cast("long")).alias("pos"),
        F.sum((F.col(y) != 1).cast("long")).alias("neg"))


def roc_auc(df: DataFrame, y: str = "y", score: str = "score", n_buckets: int | None = None) -> DataFrame:
    """Exact ROC AUC with ties counted half; NULL when only one class is present.
    Rows without a score or a truth are left out.

    Group by score first (a hot score collapses to one row), then running
    negatives below each score by bucketed prefix sums.
    """
    from ..session import stage_table
    sc = stage_table(score_counts(df, y, score), "score-counts")   # read four times; scoring through a model is dear
    ps = prefix_sums(sc, "score", ["neg"], ascending=True, inclusive=False, n_buckets=n_buckets)
    contrib = F.col("pos").cast("double") * (F.col("cum_neg").cast("double") + F.col("neg") / 2.0)
    return ps.agg(safe_div(F.sum(contrib), F.sum("pos").cast("double") * F.sum("neg").cast("double"))
                  .alias("auc"))


def roc_curve(df: DataFrame, y: str = "y", score: str = "score", n_buckets: int | None = None,
              drop_intermediate: bool = True) -> DataFrame:
    """(threshold, fpr, tpr) by descending threshold, starting at (inf, 0, 0).

    ``drop_intermediate`` removes points collinear with both neighbours, as
    scikit-learn does (second differences of fps and tps both zero).
    """
    from ..session import stage_table
    sc = stage_table(score_counts(df, y, score), "score-counts")   # read by sizing, sketch and main
    ps = prefix_sums(sc, "score", ["pos", "neg"], ascending=False, inclusive=True, n_buckets=n_buckets)
    pts = ps.select(F.col("score").alias("threshold"), F.col("cum_neg").alias("fps"),
                    F.col("cum_pos").alias("tps"), F.col("total_pos").alias("P"),
                    F.col("total_neg").alias("N"))
    if drop_intermediate:
        # neighbours in descending threshold order; partitioned by a bucket of the
        # score so the window runs in parallel, halo rows supplied by the lag/lead
        # over the whole ordered set is avoided with a self-join on rank.
        from ..functions.keys import rank_by_value
        pts = stage_table(pts, "roc-points")     # the ranking below reads it four times
        r = rank_by_value(pts.withColumn("__k", F.lit("0")), "threshold", "__k", "__rk",
                          descending=True, n_buckets=n_buckets)
        prev = r.select((F.col("__rk") + 1).alias("__rk"), F.col("fps").alias("__pf"), F.col("tps").alias("__pt"))
        nxt = r.select((F.col("__rk") - 1).alias("__rk"), F.col("fps").alias("__nf"), F.col("tps").alias("__nt"))
        r = r.join(prev, "__rk", "left").join(nxt, "__rk", "left")
        collinear = ((F.col("fps") - F.col("__pf")) == (F.col("__nf") - F.col("fps"))) & \
                    ((F.col("tps") - F.col("__pt")) == (F.col("__nt") - F.col("tps")))
        # scikit-learn's rule: keep where the second difference of fps or tps is non-zero
        keep = F.col("__pf").isNull() | F.col("__nf").isNull() | ~collinear
        pts = r.where(keep).drop("__rk", "__pf", "__pt", "__nf", "__nt", "__k")
    start = pts.agg(F.first("P").alias("P"), F.first("N").alias("N")) \
               .select(F.lit(float("inf")).alias("threshold"), F.lit(0).cast("long").alias("fps"),
                       F.lit(0).cast("long").alias("tps"), "P", "N")
    allp = pts.unionByName(start)
    return allp.select("threshold",
                       safe_div(F.col("fps"), F.col("N")).alias("fpr"),
                       safe_div(F.col("tps"), F.col("P")).alias("tpr"))


def topk_accuracy(results: DataFrame, group: str = "strategy") -> DataFrame:
    return results.groupBy(group).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg((F.col("top1_tag") == F.col("true_tag")).cast("double")).alias("top1_accuracy"),
        F.avg(F.col("hit_top3").cast("double")).alias("top3_accuracy"),
        F.avg(F.col("top1_conf").cast("double")).alias("mean_confidence"))


def residuals(df: DataFrame, y: str = "y", pred: str = "pred") -> DataFrame:
    return df.withColumn("residual", F.col(pred).cast("double") - F.col(y).cast("double"))
