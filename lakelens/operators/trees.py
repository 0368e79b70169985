"""Fitted trees as tables: pruning, one rule per leaf, curves over tree prefixes.

A model's nodes are read from its saved form.  Their number is set by depth and
trees, not by the rows it was trained on.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NO_SPLIT = {"featureIndex": -1, "leftCategoriesOrThreshold": [], "numCategories": -1}


def saved_nodes(spark: SparkSession, model, path: str) -> DataFrame:
    """Node rows of one tree (id, prediction, impurityStats, rawCount, children, split)."""
    model.write().overwrite().save(path)
    return spark.read.parquet(path + "/data")


# ------------------------------------------------------------------ min-split pruning
def prune_min_split(spark: SparkSession, model, path: str, min_split: int = 10):
    """The tree with every node of fewer than ``min_split`` training rows made a
    leaf.  Splits are greedy and never look below, so this equals growing the
    tree with that minimum.  ``path`` is a fresh folder for the two saved forms."""
    raw = saved_nodes(spark, model, path + "/grown")
    nodes = {r["id"]: r.asDict(recursive=True) for r in raw.collect()}
    kept = []

    def walk(i: int) -> int:
        n = nodes[i] | {"id": len(kept)}
        kept.append(n)
        if n["rawCount"] < min_split or n["leftChild"] < 0:
            n |= {"leftChild": -1, "rightChild": -1, "gain": -1.0, "split": NO_SPLIT}
        else:
            left, right = n["leftChild"], n["rightChild"]
            n["leftChild"], n["rightChild"] = walk(left), walk(right)
        return n["id"]

    walk(0)
    model.write().overwrite().save(path + "/pruned")
    spark.createDataFrame(kept, raw.schema).coalesce(1).write.mode("overwrite").parquet(path + "/pruned/data")
    return type(model).load(path + "/pruned")


# ------------------------------------------------------------------ rules
def tree_rules(spark: SparkSession, model, path: str, names: list[str], classes: list[str] | None = None) -> DataFrame:
    """One row per leaf: leaf (node id), depth, rule (a SQL condition over the
    feature names; 'true' for a lone root), n_train, prediction, class, share.

    Paths are put together by pointer jumping: every node starts with its parent
    and the condition on that edge; each round it takes over its ancestor's
    conditions and that ancestor's ancestor, so paths of depth d need log2(d)
    joins.  Together the rules cover every row once, NULL features aside.
    """
    nodes = saved_nodes(spark, model, path)
    label = F.array(*[F.lit(f"`{n}`") for n in names])
    at = F.get(label, F.col("split.featureIndex"))
    cats = F.concat(F.lit("("), F.array_join(F.transform(
        "split.leftCategoriesOrThreshold", lambda x: x.cast("string")), ", "), F.lit(")"))
    cut = F.get(F.col("split.leftCategoriesOrThreshold"), 0).cast("string")
    ordered = F.col("split.numCategories") < 0
    left = F.when(ordered, F.concat(at, F.lit(" <= "), cut)).otherwise(F.concat(at, F.lit(" IN "), cats))
    right = F.when(ordered, F.concat(at, F.lit(" > "), cut)).otherwise(F.concat(at, F.lit(" NOT IN "), cats))
    inner = nodes.where("leftChild >= 0")
    edges = inner.select(F.col("leftChild").alias("node"), F.col("id").alias("up"), F.array(left).alias("path")) \
        .unionByName(inner.select(F.col("rightChild").alias("node"), F.col("id").alias("up"), F.array(right).alias("path")))
    root = F.array().cast("array<string>")
    jump = edges.unionByName(nodes.where("id = 0").select(F.col("id").alias("node"), F.lit(None).cast("int").alias("up"),
                                                          root.alias("path")))
    for _ in range(max(1, math.ceil(math.log2(max(2, model.depth + 1))))):
        over = jump.select(F.col("node").alias("up"), F.col("up").alias("__up"), F.col("path").alias("__path"))
        jump = jump.join(over, "up", "left").select(
            "node", F.col("__up").alias("up"), F.concat(F.coalesce("__path", root), F.col("path")).alias("path"))
    leaves = nodes.where("leftChild < 0").withColumnRenamed("id", "node").join(jump, "node")
    named = F.get(F.array(*[F.lit(c) for c in classes]), F.col("prediction").cast("int")) if classes \
        else F.col("prediction").cast("string")
    total = F.aggregate("impurityStats", F.lit(0.0), lambda a, x: a + x)
    return leaves.select(
        F.col("node").alias("leaf"), F.size("path").alias("depth"),
        F.when(F.size("path") == 0, "true").otherwise(F.array_join("path", " AND ")).alias("rule"),
        F.col("rawCount").cast("long").alias("n_train"), "prediction", named.alias("class"),
        (F.get("impurityStats", F.col("prediction").cast("int")) / total).alias("share"))


# ------------------------------------------------------------------ curves over prefixes
def _tables(spark: SparkSession, model, path: str) -> list[dict]:
    """Every tree of a boosted model as arrays, with its weight."""
    model.write().overwrite().save(path)
    raw = spark.read.parquet(path + "/data")
    by: dict[int, list] = {}
    for r in raw.select("treeID", "nodeData.*").collect():
        by.setdefault(r["treeID"], []).append(r)
    out = []
    for t, w in enumerate(model.treeWeights):
        rows = sorted(by[t], key=lambda r: r["id"])
        cut = [r["split"]["leftCategoriesOrThreshold"] for r in rows]
        if any(r["split"]["numCategories"] >= 0 for r in rows):
            raise ValueError("tree prefixes are scored for continuous features")
        out.append({"left": np.array([r["leftChild"] for r in rows]), "right": np.array([r["rightChild"] for r in rows]),
                    "feature": np.array([max(r["split"]["featureIndex"], 0) for r in rows]),
                    "cut": np.array([c[0] if c else 0.0 for c in cut]),
                    "value": np.array([r["prediction"] for r in rows]) * w})
    return out


def prefix_scores(trees: list[dict], x: np.ndarray) -> np.ndarray:
    """rows x trees: the running sum of weighted tree outputs."""
    out = np.empty((len(x), len(trees)))
    at = np.arange(len(x))
    for t, tree in enumerate(trees):
        node = np.zeros(len(x), dtype=np.int64)
        while True:
            live = tree["left"][node] >= 0
            if not live.any():
                break
            go = x[at, tree["feature"][node]] <= tree["cut"][node]
            node = np.where(live, np.where(go, tree["left"][node], tree["right"][node]), node)
        out[:, t] = tree["value"][node]
    return out.cumsum(1)


SUMS = ["loss", "hit", "tp", "fp", "fn"]


def learning_curve(spark: SparkSession, model, df: DataFrame, path: str, label: str = "label", features: str = "features",
                   part: str = "part") -> DataFrame:
    """Per part and iteration of a boosted model: rows, mean loss and, for a
    classifier, accuracy and F1 (NULL for a regressor), as if the model had been
    cut there.  One scan of ``df``: each row's tree outputs are summed up once
    and every prefix is scored from the running sum.

    Loss: mean squared error; for classifiers 2 log(1 + exp(-2 m y)), y = -1 or 1.
    """
    trees = _tables(spark, model, path)
    classes = hasattr(model, "numClasses")
    share = spark.sparkContext.broadcast(trees)         # trees x 2^depth nodes

    def run(batches):
        total: dict[str, np.ndarray] = {}
        for b in batches:
            if not b.num_rows:
                continue
            x = b.column(2).flatten().to_numpy().reshape(b.num_rows, -1)
            y = b.column(1).to_numpy().astype(np.float64)[:, None]
            parts = np.array(b.column(0).to_pylist(), dtype=object)
            for start in range(0, len(x), 4096):        # bounded: 4,096 rows x trees
                cut = slice(start, start + 4096)
                m = prefix_scores(share.value, x[cut])
                if classes:
                    z = -2 * m * (2 * y[cut] - 1)
                    loss, pred = 2 * np.logaddexp(0.0, z), m > 0
                    pos = y[cut] > 0
                    sums = [loss, pred == pos, pred & pos, pred & ~pos, ~pred & pos]
                else:
                    none = np.zeros_like(m)
                    sums = [(m - y[cut]) ** 2, none, none, none, none]
                for p in set(parts[cut]):
                    own = parts[cut] == p
                    got = np.stack([s[own].sum(0, dtype=np.float64) for s in sums] + [np.full(m.shape[1], own.sum(), float)])
                    total[p] = total.get(p, 0) + got
        for p, s in total.items():
            k = s.shape[1]
            yield pa.RecordBatch.from_arrays(
                [pa.array([p] * k, pa.string()), pa.array(np.arange(1, k + 1, dtype=np.int32)),
                 *[pa.array(row) for row in s]], ["part", "iteration", *SUMS, "n"])

    rows = df.select(F.col(part).cast("string").alias("part"), F.col(label).cast("double").alias("y"),
                     vector_to_array(features).alias("x"))
    out = rows.mapInArrow(run, "part string, iteration int, " + ", ".join(f"{s} double" for s in [*SUMS, "n"]))
    g = out.groupBy("part", "iteration").agg(*[F.sum(s).alias(s) for s in [*SUMS, "n"]])
    den = 2 * F.col("tp") + F.col("fp") + F.col("fn")
    only = lambda c: c if classes else F.lit(None).cast("double")
    return g.select("part", "iteration", F.col("n").cast("long").alias("n"), (F.col("loss") / F.col("n")).alias("loss"),
                    only(F.col("hit") / F.col("n")).alias("accuracy"),
                    only(F.when(den > 0, 2 * F.col("tp") / den).otherwise(0.0)).alias("f1"))
