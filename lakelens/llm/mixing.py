"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target in words.  Whole copies that are certain
(``floor(target / source size)``) come first; the rest of the target is filled
by Pareto order sampling: documents are ranked by the odds of a uniform number
divided by the odds of their inclusion probability (which grows with the square
root of their size, so that the expected words equal the rest), and the lowest
ranks are taken until the rest is filled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import staged

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2.0
BINS = 4096


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE,
                   most: float = MOST) -> DataFrame:
    """(_src, _total) -> adds ``_target``.  Sources in code-point order, NULL
    last, take ``weights`` in turn; a target stops at ``most`` times its
    source's size and the excess is shared again by weight.

    That sharing has a closed form: target = least(most * size, level * weight),
    where the level is the largest of (total - limits before) / (weights from
    here on) along the sources ordered by limit / weight.  One row per source.
    """
    one = W.orderBy(F.col("_src").asc_nulls_last())
    d = sizes.withColumn("_w", F.element_at(
        F.array(*[F.lit(float(x)) for x in weights]),
        ((F.row_number().over(one) - 1) % len(weights) + 1).cast("int")))
    d = d.withColumn("_limit", F.col("_total") * F.lit(most))
    by = W.orderBy(F.col("_limit") / F.col("_w"), F.col("_src").asc_nulls_last())
    d = d.withColumn("_before", F.coalesce(F.sum("_limit").over(
        by.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)))
    d = d.withColumn("_after", F.sum("_w").over(by.rowsBetween(0, W.unboundedFollowing)))
    whole = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    d = d.withColumn("_all", F.sum("_total").over(whole) * F.lit(share))
    d = d.withColumn("_level", F.max((F.col("_all") - F.col("_before")) / F.col("_after")).over(whole))
    return d.select("_src", "_total", F.least("_limit", F.col("_level") * F.col("_w")).alias("_target"))


def _cut(rows: DataFrame, bin_col: str, need: str) -> DataFrame:
    """Per source the bin in which the running words reach ``need``: (_src, bin, words before it)."""
    per = rows.groupBy("_src", bin_col).agg(F.sum("_size").alias("_s"), F.max(need).alias("_need"))
    w = W.partitionBy("_src").orderBy(bin_col).rowsBetween(W.unboundedPreceding, -1)
    per = per.withColumn("_b4", F.coalesce(F.sum("_s").over(w), F.lit(0)))
    return (per.filter((F.col("_b4") < F.col("_need")) & (F.col("_b4") + F.col("_s") >= F.col("_need")))
            .groupBy("_src").agg(F.min(bin_col).alias("_cut"), F.min("_b4").alias("_b4"))
            .withColumnRenamed("_src", "_csrc"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", weights=WEIGHTS, share: float = SHARE,
        most: float = MOST, seed: int = 7) -> DataFrame:
    """One row per input row: id, source, size (words), source_size, target
    (words of its source), copies, taken (= copies * size).

    NULL text: size 0.  NULL source: a source of its own, last in order.  An
    empty table gives an empty result; rows of size 0 get the certain copies
    only.  The choice depends on the id and ``seed`` alone, so reruns agree;
    rows that repeat an id rank next to each other.
    """
    d = docs.select(F.col(id_col).alias("_id"), F.col(source_col).alias("_src"),
                    F.coalesce(F.regexp_count(F.col(text_col), F.lit("[^\\x20\\x09-\\x0D]+")),
                               F.lit(0)).cast("long").alias("_size"))
    return _mix_sizes(staged(d, "mix-sizes"), weights, share, most, seed).select(
        F.col("_id").alias(id_col), F.col("_src").alias(source_col), F.col("_size").alias("size"),
        F.col("_total").alias("source_size"), F.col("_target").alias("target"),
        "copies", (F.col("copies") * F.col("_size")).alias("taken"))


def _mix_sizes(rows: DataFrame, weights, share, most, seed) -> DataFrame:
    sizes = rows.groupBy("_src", "_size").agg(F.count("*").alias("_n"))
    totals = sizes.groupBy("_src").agg(F.sum(F.col("_size") * F.col("_n")).alias("_total"))
    goal = (source_targets(totals, weights, share, most)
            .withColumn("_whole", F.when(F.col("_total") > 0, F.floor(F.col("_target") / F.col("_total"))).otherwise(F.lit(0)))
            .withColumn("_rest", F.col("_target") - F.col("_whole") * F.col("_total")))
    goal = staged(goal, "mix-targets")
    # inclusion probability least(1, c * sqrt(size)) with expected words = rest:
    # the largest sizes are certain, and c has a closed form along the sizes
    # (one row per distinct size of a source)
    g = goal.withColumnRenamed("_src", "_gsrc")
    s = sizes.join(g, F.col("_src").eqNullSafe(F.col("_gsrc"))).filter("_rest > 0 and _size > 0")
    w = W.partitionBy("_src").orderBy(F.col("_size").desc())
    words = F.col("_size") * F.col("_n")
    c = ((F.col("_rest") - F.coalesce(F.sum(words).over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
         / F.sum(words * F.sqrt("_size")).over(w.rowsBetween(0, W.unboundedFollowing)))
    scale = (s.withColumn("_c", c).groupBy("_src").agg(F.max("_c").alias("_c"))
             .withColumnRenamed("_src", "_ssrc"))
    goal = staged(g.join(scale, F.col("_gsrc").eqNullSafe(F.col("_ssrc")), "left").drop("_ssrc"), "mix-goal")

    d = rows.join(goal, F.col("_src").eqNullSafe(F.col("_gsrc"))).drop("_gsrc")
    u = (F.shiftrightunsigned(F.xxhash64("_id", F.lit(seed)), 11).cast("double") + 0.5) / float(1 << 53)
    d = d.withColumn("_pi", F.least(F.lit(1.0), F.coalesce("_c", F.lit(0.0)) * F.sqrt("_size")))
    # Pareto rank value q, mapped to q / (1 + q) in [0, 1]
    d = d.withColumn("_q", F.when(F.col("_pi") <= 0, F.lit(1.0)).otherwise(
        u * (1 - F.col("_pi")) / (u * (1 - F.col("_pi")) + (1 - u) * F.col("_pi"))))
    d = d.withColumn("_b1", F.floor(F.col("_q") * BINS).cast("int"))
    d = d.withColumn("_b2", F.floor((F.col("_q") * BINS - F.col("_b1")) * BINS).cast("int"))
    live = d.filter("_rest > 0 and _size > 0")
    cut1 = staged(_cut(live, "_b1", "_rest"), "mix-cut")
    inside = (live.join(cut1, F.col("_src").eqNullSafe(F.col("_csrc")) & (F.col("_b1") == F.col("_cut")))
              .withColumn("_need2", F.col("_rest") - F.col("_b4")).drop("_csrc", "_cut", "_b4"))
    cut2 = staged(_cut(inside, "_b2", "_need2"), "mix-cut")
    cuts = staged(cut1.select(F.col("_csrc"), F.col("_cut").alias("_cut1"), F.col("_b4").alias("_b41"))
                  .join(cut2.select(F.col("_csrc").alias("_c2src"), F.col("_cut").alias("_cut2"),
                                    F.col("_b4").alias("_b42")),
                        F.col("_csrc").eqNullSafe(F.col("_c2src")), "left").drop("_c2src"), "mix-cuts")
    d = d.join(cuts, F.col("_src").eqNullSafe(F.col("_csrc")), "left")
    cell = ((F.col("_rest") > 0) & (F.col("_size") > 0)
            & (F.col("_b1") == F.col("_cut1")) & (F.col("_b2") == F.col("_cut2")))
    cell = F.coalesce(cell, F.lit(False))
    below = ((F.col("_rest") > 0) & (F.col("_size") > 0) & ((F.col("_b1") < F.col("_cut1")) | (
        (F.col("_b1") == F.col("_cut1")) & (F.col("_b2") < F.col("_cut2")))))
    keep = ["_id", "_src", "_size", "_total", "_target"]
    plain = d.filter(~cell).select(
        *keep, (F.col("_whole") + F.when(F.coalesce(below, F.lit(False)), 1).otherwise(0)).cast("int").alias("copies"))
    # rows of one cell (a 2**-24 part of the rank range) are ranked one by one
    run = W.partitionBy("_src").orderBy("_q", "_id").rowsBetween(W.unboundedPreceding, -1)
    edge = d.filter(cell).withColumn("_at", F.coalesce(F.sum("_size").over(run), F.lit(0)))
    take = F.col("_b41") + F.col("_b42") + F.col("_at") + F.col("_size") / 2 <= F.col("_rest")
    edge = edge.select(*keep, (F.col("_whole") + F.when(take, 1).otherwise(0)).cast("int").alias("copies"))
    return plain.unionByName(edge)
