"""§2.12 models and inference on Spark ML, configured to the reference's choices.

Training is Spark ML (distributed fit); scoring is ``transform`` (the model is
shipped with the plan).  Metrics come from the exact aggregates in
``metrics``; the ML evaluators are used only for model selection, with
``numBins=0`` (no down-sampling) for AUC.
"""

from __future__ import annotations

import math

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.evaluation import BinaryClassificationEvaluator, Evaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def linear_score(df, coefs: dict, intercept: float = 0.0, out: str = "score"):
    """Apply given coefficients to rows: sum(coef_i * x_i) + intercept, left to right."""
    expr = None
    for c, w in coefs.items():
        term = F.lit(float(w)) * F.col(c).cast("double")
        expr = term if expr is None else expr + term
    expr = (expr if expr is not None else F.lit(0.0)) + F.lit(float(intercept))
    return df.withColumn(out, expr)


# ------------------------------------------------------------------ estimators
def linear_regression(label: str = "label", features: str = "features") -> LinearRegression:
    """Ordinary least squares (normal equations, no penalty)."""
    return LinearRegression(labelCol=label, featuresCol=features, solver="normal", regParam=0.0)


def rf_regression(label="label", features="features", trees=200, depth=10, seed=42) -> RandomForestRegressor:
    """All features at every split, as the reference's forest does.  Each row's node
    in each tree is kept from level to level (the same forest: a row is not sent
    down every tree from its root again)."""
    return RandomForestRegressor(labelCol=label, featuresCol=features, numTrees=trees, maxDepth=depth,
                                 featureSubsetStrategy="all", seed=seed, cacheNodeIds=True)


def logistic_regression(n_train: int, C: float = 1.0, penalty: str = "l2", label="label",
                        features="features", max_iter: int = 1000) -> LogisticRegression:
    """scikit-learn's C * sum(loss) + penalty equals Spark's mean loss + lambda * penalty
    with lambda = 1 / (C * n_train)."""
    return LogisticRegression(labelCol=label, featuresCol=features, maxIter=max_iter,
                              regParam=1.0 / (C * max(n_train, 1)),
                              elasticNetParam=1.0 if penalty == "l1" else 0.0, standardization=False)


def decision_tree(label="label", features="features", depth=5, seed=42, max_bins=32) -> DecisionTreeClassifier:
    """Depth 5, gini, grown freely; ``trees.prune_min_split`` then applies the
    minimum of rows to split a node, which Spark's tree does not have."""
    return DecisionTreeClassifier(labelCol=label, featuresCol=features, maxDepth=depth, impurity="gini",
                                  minInstancesPerNode=1, maxBins=max_bins, seed=seed)


def rf_classifier(label="label", features="features", trees=200, depth=30, seed=42) -> RandomForestClassifier:
    """200 trees, sqrt features; 'unlimited' depth is Spark's largest, 30.  Nodes are
    kept by row and tree, so the grown trees are not sent out with every pass."""
    return RandomForestClassifier(labelCol=label, featuresCol=features, numTrees=trees, maxDepth=depth,
                                  featureSubsetStrategy="sqrt", seed=seed, cacheNodeIds=True)


def gbt_regression(label="label", features="features", iters=200, depth=4, step=0.1, seed=42) -> GBTRegressor:
    return GBTRegressor(labelCol=label, featuresCol=features, maxIter=iters, maxDepth=depth, stepSize=step,
                        seed=seed)


def huber_regression(label="label", features="features", epsilon: float = 1.35) -> LinearRegression:
    """Robust linear fit (Huber loss) on assembled image + tabular features."""
    return LinearRegression(labelCol=label, featuresCol=features, loss="huber", epsilon=epsilon,
                            regParam=0.0, maxIter=200)


def text_classifier(n_classes: int, label="label", features="features") -> LogisticRegression:
    return LogisticRegression(labelCol=label, featuresCol=features, family="multinomial", maxIter=100,
                              regParam=1e-3)


def gbt_classifier(label="label", features="features", iters=200, depth=3, step=0.1, seed=42) -> GBTClassifier:
    return GBTClassifier(labelCol=label, featuresCol=features, maxIter=iters, maxDepth=depth, stepSize=step, seed=seed)


# ------------------------------------------------------------------ tuning
class MetricEvaluator(Evaluator):
    """A metric of this library as an ML evaluator, so model selection scores
    with it: ``fn`` takes the scored rows (with ``p1``, the class-1 probability,
    where the model gives one) and returns a one-value frame.  A NULL metric
    (AUC of one class) counts as the worst value."""

    def __init__(self, fn, larger: bool = True):
        super().__init__()
        self.fn, self.larger = fn, larger

    def _evaluate(self, dataset: DataFrame) -> float:
        scored = predict_proba(dataset) if "probability" in dataset.columns else dataset
        got = self.fn(scored).first()[0]
        return float(got) if got is not None else (-math.inf if self.larger else math.inf)

    def isLargerBetter(self) -> bool:
        return self.larger


def exact_auc(label: str = "label") -> MetricEvaluator:
    """The exact ROC AUC, ties counted half."""
    from .metrics import roc_auc
    return MetricEvaluator(lambda d: roc_auc(d, label, "p1"))


def auc_evaluator(label="label", raw="rawPrediction") -> BinaryClassificationEvaluator:
    """Exact AUC (numBins=0: no curve down-sampling)."""
    return BinaryClassificationEvaluator(labelCol=label, rawPredictionCol=raw, metricName="areaUnderROC",
                                         numBins=0)


def grid_search(stages: list, lr: LogisticRegression, n_train: int, Cs: list[float],
                penalties: list[str] = ("l1", "l2"), fold_col: str = "fold", label="label",
                parallelism: int = 4, n_folds: int = 5) -> CrossValidator:
    """C x penalty grid over precomputed class-balanced folds, scored by AUC, refit on all."""
    grid = ParamGridBuilder()
    grid = grid.addGrid(lr.regParam, [1.0 / (c * max(n_train, 1)) for c in Cs])
    grid = grid.addGrid(lr.elasticNetParam, [1.0 if p == "l1" else 0.0 for p in penalties])
    return CrossValidator(estimator=Pipeline(stages=stages + [lr]), estimatorParamMaps=grid.build(),
                          evaluator=auc_evaluator(label), foldCol=fold_col, numFolds=n_folds,
                          parallelism=parallelism, collectSubModels=False)


def grid_search_by_fold(stages: list, lr, param_maps: list, train: DataFrame,
                        fold_col: str = "fold", label: str = "label", n_folds: int = 5,
                        parallelism: int = 4, evaluator: Evaluator | None = None) -> dict:
    """The same search as ``grid_search`` with the feature stages fitted once
    per fold instead of once per (fold, grid point): they do not depend on the
    grid, so refitting them for every point only repeats identical jobs.

    ``lr``: any estimator (logistic, tree, forest); ``evaluator``: any, ML's AUC
    by default, ``MetricEvaluator`` for the library's own metrics.

    Per fold: fit ``stages`` on the other folds, transform both sides, fit every
    grid point on the transformed rows and score AUC on the held-out fold.
    Grid points of a fold are fitted ``parallelism`` at a time (concurrent
    Spark jobs, as CrossValidator does).  Returns avg/std (population) AUC per
    point, the best index (first on ties) and the best configuration refitted
    on all rows as one PipelineModel.
    """
    from concurrent.futures import ThreadPoolExecutor

    import numpy as np
    ev = evaluator or auc_evaluator(label)
    feats = lr.getFeaturesCol()
    scores = np.zeros((len(param_maps), n_folds))
    for f in range(n_folds):
        tr = train.where(F.col(fold_col) != f)
        va = train.where(F.col(fold_col) == f)
        fm = Pipeline(stages=stages).fit(tr)
        trf = fm.transform(tr).select(label, feats)
        vaf = fm.transform(va).select(label, feats)
        def score(pm, trf=trf, vaf=vaf):
            return ev.evaluate(lr.fit(trf, pm).transform(vaf))
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            scores[:, f] = list(pool.map(score, param_maps))
    avg, std = scores.mean(axis=1), scores.std(axis=1)
    best = int(np.argmax(avg if ev.isLargerBetter() else -avg))
    model = Pipeline(stages=stages + [lr.copy(param_maps[best])]).fit(train)
    return {"folds": scores.tolist(), "avg": avg.tolist(), "std": std.tolist(), "best_index": best,
            "best_params": param_maps[best], "model": model}


def grid_maps(lr: LogisticRegression, n_train: int, Cs: list[float],
              penalties: list[str] = ("l1", "l2")) -> list:
    """C x penalty grid as Spark param maps (C -> regParam = 1 / (C n))."""
    grid = ParamGridBuilder()
    grid = grid.addGrid(lr.regParam, [1.0 / (c * max(n_train, 1)) for c in Cs])
    grid = grid.addGrid(lr.elasticNetParam, [1.0 if p == "l1" else 0.0 for p in penalties])
    return grid.build()


def cross_val_score(stages: list, est, evaluator, fold_col: str = "fold", parallelism: int = 4,
                    n_folds: int = 5) -> CrossValidator:
    """Per-fold scores of one configuration: avgMetrics and stdMetrics (population)."""
    return CrossValidator(estimator=Pipeline(stages=stages + [est]),
                          estimatorParamMaps=ParamGridBuilder().build(), evaluator=evaluator,
                          foldCol=fold_col, numFolds=n_folds, parallelism=parallelism)


# ------------------------------------------------------------------ outputs
def predict_proba(scored: DataFrame, prob: str = "probability", prediction: str = "prediction") -> DataFrame:
    """Class-1 probability and the confidence of the predicted class."""
    arr = vector_to_array(F.col(prob))
    return scored.withColumns({"p1": F.get(arr, 1),
                               "confidence": F.get(arr, F.col(prediction).cast("int"))})


def _bind(value, fn):
    """``fn`` of ``value`` with the value computed once: lambdas are interpreted, so
    an expression named inside one would be computed again for every element."""
    return F.get(F.transform(F.array(value), fn), 0)


def softmax_argmax(logits) -> tuple:
    """(probabilities, best index, its confidence) for an array column, stable
    (max subtracted), all array SQL.  Work per row is linear in the classes: the
    maximum, the exponentials and their sum are bound before elements are mapped."""
    def normalised(ex):
        return _bind(F.aggregate(ex, F.lit(0.0), lambda a, b: a + b), lambda tot: F.transform(ex, lambda x: x / tot))

    def exponentials(z):
        return _bind(F.array_max(z), lambda m: F.transform(z, lambda x: F.exp(x.cast("double") - m)))

    probs = _bind(_bind(logits, exponentials), normalised)
    best = _bind(logits, lambda z: F.array_position(z, F.array_max(z)) - 1)
    return probs, best, F.get(probs, best.cast("int"))


def feature_importance(model, names: list[str]) -> list[tuple[str, float]]:
    """Tree importances (or |coefficient|) by feature name, descending."""
    if hasattr(model, "featureImportances"):
        vals = model.featureImportances.toArray().tolist()
    else:
        vals = [abs(x) for x in model.coefficients.toArray().tolist()]
    return sorted(zip(names, vals), key=lambda t: (-t[1], t[0]))


def fit_pipeline(stages: list, df: DataFrame) -> PipelineModel:
    return Pipeline(stages=stages).fit(df)
