"""§2.9-2.10 seeded samples, exact splits and folds; §2.8 sort / top-k.

numpy's random stream cannot be reproduced on a cluster, so the contract is
sizes, ratios, disjointness and seed stability.  Every row gets a key
``md5(id | seed)`` (pure, partition-independent, equal in DuckDB); exact
sizes come from distributed ranks over that key (``rank_by_key``), never
from a one-task window or a driver-side list of ids.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.common import BROADCAST_GROUPS, join_null_safe
from ..functions.keys import MD5_PREFIX, md5_key, prefix_sums, rank_by_key, rank_by_value
from ..session import stage_table

KEY = "__key"


def with_key(df: DataFrame, key_cols: list[str], seed: int = 42, out: str = KEY) -> DataFrame:
    return df.withColumn(out, md5_key(*key_cols, seed=seed))


def exact_sample(df: DataFrame, n: int, key_cols: list[str], seed: int = 42) -> DataFrame:
    """Exactly ``min(n, rows)`` rows without replacement: the n smallest keys."""
    r = rank_by_key(with_key(df, key_cols, seed), KEY, rank_col="__r")
    return r.where(F.col("__r") <= n).drop(KEY, "__r")


def shuffle_rows(df: DataFrame, key_cols: list[str], seed: int = 42, out: str = "pos") -> DataFrame:
    """Seeded permutation: position of each row in key order (1-based)."""
    return rank_by_key(with_key(df, key_cols, seed), KEY, rank_col=out).drop(KEY)


def random_split(df: DataFrame, key_cols: list[str], test_size: float = 0.2, seed: int = 42,
                 exact: bool = True, out: str = "part") -> DataFrame:
    """test = ceil(test_size * n) rows (exact mode), else an expected-size hash cut."""
    k = with_key(df, key_cols, seed)
    if not exact:
        h = F.conv(F.substring(F.col(KEY), 1, 8), 16, 10).cast("double") / 4294967296.0
        return k.withColumn(out, F.when(h < test_size, "test").otherwise("train")).drop(KEY)
    r = rank_by_key(k, KEY, rank_col="__r", size_col="__n")
    quota = F.ceil(F.col("__n").cast("double") * F.lit(test_size))
    return r.withColumn(out, F.when(F.col("__r") <= quota, "test").otherwise("train")).drop(KEY, "__r", "__n")


# Classes up to which per-class frames are broadcast (their md5 buckets: 65,536 a class).
BROADCAST_CLASSES = 16


def _label_rank(rows: DataFrame, label: str, cuts: int = 64) -> DataFrame:
    """1-based rank (``__pos``) of distinct ``label`` values in ascending order, NULL first.

    Cut points are the sorted labels of a fixed hash sample (at most ``cuts``);
    counts between them give offsets and a window ranks inside each range."""
    sample = [r[0] for r in rows.where(F.col(label).isNotNull()).select(label)
              .orderBy(F.xxhash64(label)).limit(cuts).collect()]
    kind = rows.schema[label].dataType
    marks = F.array(*[F.lit(x).cast(kind) for x in sorted(sample)])
    bucket = F.when(F.col(label).isNull(), F.lit(-1)).otherwise(
        F.size(F.filter(marks, lambda m: m <= F.col(label))) if sample else F.lit(0))
    d = rows.withColumn("__b", bucket)
    n = d.groupBy("__b").agg(F.count(F.lit(1)).alias("__n"))          # at most cuts + 2 rows
    off = n.withColumn("__off", F.coalesce(F.sum("__n").over(
        Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("__n")
    w = Window.partitionBy("__b").orderBy(label)
    return d.join(F.broadcast(off), "__b").withColumn("__pos", F.row_number().over(w) + F.col("__off")).drop("__b", "__off")


def class_quotas(df: DataFrame, label: str, test_size: float = 0.2) -> DataFrame:
    """Per class: n and test quota.  Train sizes are the largest-remainder
    allocation of ``n - ceil(test_size * n)`` (ties -> smaller label); test
    takes the rest, as scikit-learn's stratified shuffle split does.

    The classes that get one more are found by a threshold: classes are counted
    by remainder, running counts place the remainder at which the spare rows end
    (all larger ones get one), and only the classes at it are ranked by label.
    No step holds all classes in one task.
    """
    cc = stage_table(df.groupBy(label).agg(F.count(F.lit(1)).alias("n_class")), "class-counts")
    total = cc.agg(F.sum("n_class")).first()[0] or 0
    n_train = total - math.ceil(total * test_size)
    # exact integers: the product passes int64 from about 3e9 rows on
    num = f"(cast({n_train} as decimal(19,0)) * cast(n_class as decimal(19,0)))"
    den = f"cast({max(total, 1)} as decimal(19,0))"
    q = cc.withColumn("__fl", F.expr(f"{num} div {den}").cast("long")) \
          .withColumn("__rem", F.expr(f"{num} % {den}").cast("long"))
    left = n_train - (q.agg(F.sum("__fl")).first()[0] or 0)
    by_rem = stage_table(q.groupBy("__rem").agg(F.count(F.lit(1)).alias("__k")), "class-remainders")
    at = prefix_sums(by_rem, "__rem", ["__k"], ascending=False, inclusive=False) \
        .where((F.col("cum___k") < left) & (F.col("cum___k") + F.col("__k") >= left)).select("__rem", "cum___k").first()
    cut, spare = (at["__rem"], left - at["cum___k"]) if at else (None, 0)
    if cut is None:
        more = q.withColumn("__more", F.lit(0))
    else:
        tied = _label_rank(q.where(F.col("__rem") == cut), label)
        tied = tied.withColumn("__more", (F.col("__pos") <= spare).cast("int")).drop("__pos")
        more = q.where(F.col("__rem") != cut).withColumn("__more", (F.col("__rem") > cut).cast("int")).unionByName(tied)
    out = more.withColumn("n_train", F.col("__fl") + F.col("__more"))
    return out.select(label, "n_class", "n_train", (F.col("n_class") - F.col("n_train")).alias("n_test"))


def stratified_split(df: DataFrame, label: str, key_cols: list[str], test_size: float = 0.2,
                     seed: int = 42, out: str = "part") -> DataFrame:
    """Same class ratio in both parts, exact quotas; rows ranked by key inside each
    class (spread over md5 buckets, so a big class is many tasks).  Per-class
    frames are broadcast only if the classes, counted, are few."""
    q = stage_table(class_quotas(df, label, test_size), "class-quotas")
    few = q.count()
    r = rank_by_key(with_key(df, key_cols, seed), KEY, [label], rank_col="__r", small_groups=few <= BROADCAST_CLASSES)
    j = join_null_safe(r, q.select(label, "n_test"), [label], hint_broadcast=few <= BROADCAST_GROUPS)
    return j.withColumn(out, F.when(F.col("__r") <= F.col("n_test"), "test").otherwise("train")) \
            .drop(KEY, "__r", "n_test")


def stratified_folds(df: DataFrame, label: str, key_cols: list[str], k: int = 5, seed: int = 42,
                     out: str = "fold") -> DataFrame:
    """fold = (rank inside class by key - 1) mod k: class-balanced, sizes differ by <= 1."""
    few = df.select(label).distinct().limit(BROADCAST_CLASSES + 1).count() <= BROADCAST_CLASSES
    r = rank_by_key(with_key(df, key_cols, seed), KEY, [label], rank_col="__r", small_groups=few)
    return r.withColumn(out, ((F.col("__r") - 1) % k).cast("int")).drop(KEY, "__r")


def split_report(df: DataFrame, part: str = "part", label: str | None = None) -> DataFrame:
    g = [part] + ([label] if label else [])
    return df.groupBy(*g).agg(F.count(F.lit(1)).alias("n"))


def split_parts(df: DataFrame, part: str = "part") -> tuple[DataFrame, DataFrame]:
    """train and its complement: two filters on one flag."""
    return df.where(F.col(part) == "train"), df.where(F.col(part) == "test")


def systematic_sample(df: DataFrame, order_col: str, key_cols: list[str], k: int = 10,
                      seed: int = 42) -> DataFrame:
    """Sort by ``order_col``, take positions 0, s, 2s, ... (s = n // k), first k."""
    kd = with_key(df, key_cols, seed)
    r = rank_by_value(kd, order_col, KEY, rank_col="position")
    n = df.count()
    step = max(n // k, 1)
    p0 = F.col("position") - 1
    return r.where(((p0 % step) == 0) & (p0 < step * k)).drop(KEY)


def top_k(df: DataFrame, score: str, k: int, name: str | None = None, ascending: bool = False) -> DataFrame:
    """Top k rows by score (then name): TakeOrdered, k per task then merged."""
    order = [F.col(score).asc() if ascending else F.col(score).desc()]
    if name:
        order.append(F.col(name).asc())
    return df.orderBy(*order).limit(k)


def top_k_per_group(df: DataFrame, group: str, score: str, k: int, tiebreak: str) -> DataFrame:
    w = Window.partitionBy(group).orderBy(F.col(score).desc(), F.col(tiebreak))
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def sort_scores(df: DataFrame, score: str, ascending: bool = False) -> DataFrame:
    return df.orderBy(F.col(score).asc() if ascending else F.col(score).desc())
