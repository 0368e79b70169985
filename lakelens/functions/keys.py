"""Seeded sampling keys, exact ranks and running sums without one-task windows.

A window with no ``partitionBy`` runs in a single task.  The helpers here turn
global order into fixed buckets: per-bucket totals form a small frame (bounded
by the number of buckets), their running total is broadcast back as offsets,
and the final window runs inside each bucket in parallel.  Bucket ids are pure
expressions of the row (never ``spark_partition_id``), so a recomputed stage
gives the same answer.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_GROUPS, col_of, join_null_safe

# Hex digits of the md5 key used as bucket: 16**4 = 65,536 buckets at most.
MD5_PREFIX = 4
# Target rows per bucket when buckets come from value quantiles.
ROWS_PER_BUCKET = 500_000
MAX_VALUE_BUCKETS = 65_536


def md5_key(*cols: str | Column, seed: int | str = 42) -> Column:
    """md5(c1 | c2 | ... | seed) as hex; equal to DuckDB's md5 of the same string."""
    parts = [col_of(c).cast("string") for c in cols] + [F.lit(str(seed))]
    return F.md5(F.concat_ws("|", *parts))


def _offsets(counts: DataFrame, group_cols: list[str], order_col: str,
             value_cols: list[str]) -> DataFrame:
    """Running totals over a small per-bucket frame (exclusive, per group)."""
    w = Window.partitionBy(*group_cols).orderBy(order_col)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group_cols)
    out = counts
    for v in value_cols:
        out = out.withColumn(f"__off_{v}", F.coalesce(F.sum(v).over(before), F.lit(0)))
        out = out.withColumn(f"__tot_{v}", F.sum(v).over(whole))
    return out.drop(*value_cols)


def rank_by_key(df: DataFrame, key: str, group_cols: list[str] | tuple = (),
                rank_col: str = "rank", size_col: str | None = None,
                prefix_len: int = MD5_PREFIX, small_groups: bool = True) -> DataFrame:
    """1-based rank of each row by an md5 hex ``key`` within ``group_cols``.

    Equals ``row_number() OVER (PARTITION BY groups ORDER BY key)``.  The md5
    prefix is order-preserving and uniform, so buckets are even whatever the
    data, and a hot group is spread over up to 16**prefix_len tasks.
    ``small_groups`` says the number of groups is small (class labels), so the
    offsets frame (groups x buckets) is bounded and is broadcast; otherwise the
    join is left to AQE, which broadcasts only after measuring it.
    """
    group_cols = list(group_cols)
    b = "__bucket"
    tagged = df.withColumn(b, F.substring(F.col(key), 1, prefix_len))
    counts = tagged.groupBy(*group_cols, b).agg(F.count(F.lit(1)).alias("__n"))
    offs = _offsets(counts, group_cols, b, ["__n"])
    joined = join_null_safe(tagged, offs, group_cols + [b], hint_broadcast=small_groups)
    w = Window.partitionBy(*group_cols, b).orderBy(F.col(key))
    out = joined.withColumn(rank_col, F.row_number().over(w) + F.col("__off___n"))
    if size_col:
        out = out.withColumnRenamed("__tot___n", size_col)
    return out.drop(b, "__off___n", "__tot___n")


def _n_buckets(n: int, rows_per_bucket: int) -> int:
    return max(1, min(MAX_VALUE_BUCKETS, math.ceil(n / rows_per_bucket)))


def value_buckets(df: DataFrame, col: str, n_buckets: int) -> tuple[list[float], dict[int, float]]:
    """Quantile cut points of ``col`` (a small list of literals) and hot values.

    A value that fills a whole quantile step shows up as a repeated cut point;
    those are returned as ``{bucket_index: value}`` so callers can split them.
    """
    if n_buckets <= 1:
        return [-math.inf, math.inf], {}
    probs = [i / n_buckets for i in range(1, n_buckets)]
    cuts = df.approxQuantile(col, probs, 1.0 / (4 * n_buckets))
    distinct = sorted(set(c for c in cuts if c is not None and not math.isnan(c)))
    splits = [-math.inf] + distinct + [math.inf]
    hot = {}
    for v in distinct:
        if cuts.count(v) >= 2:
            hot[splits.index(v)] = v
    return splits, hot


def _bucketize(d: DataFrame, col: str, out: str, n_buckets: int) -> tuple[DataFrame, dict]:
    """Add bucket index ``out`` from quantile cut points (one bucket when n_buckets <= 1)."""
    splits, hot = value_buckets(d, col, n_buckets)
    if len(splits) < 3:
        # one bucket (NULLs apart, first in ascending order); an expression of
        # the row rather than a literal, so the offsets join keeps its key
        return d.withColumn(out, F.when(F.col(col).isNull(), F.lit(-1.0)).otherwise(F.lit(0.0))), {}
    d = Bucketizer(splits=splits, inputCol=col, outputCol=out, handleInvalid="keep").transform(d)
    # NULLs have the same bucket of their own for every bucket count
    return d.withColumn(out, F.coalesce(F.col(out), F.lit(-1.0))), hot


def _ordered(order_col: str, ascending: bool):
    """Order by the column itself (a double would merge int64 values from 2**53
    on), NULLs first as their bucket is."""
    c = F.col(order_col)
    return c.asc_nulls_first() if ascending else c.desc_nulls_first()


def prefix_sums(df: DataFrame, order_col: str, value_cols: list[str], ascending: bool = True,
                inclusive: bool = True, n_buckets: int | None = None,
                rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Running sums of ``value_cols`` in ``order_col`` order over the whole frame.

    ``order_col`` must be distinct per row (group by it first), numeric.
    Adds ``cum_<v>`` (inclusive or exclusive of the row) and ``total_<v>``.
    """
    if n_buckets is None:
        n_buckets = _n_buckets(df.count(), rows_per_bucket)
    sign = 1.0 if ascending else -1.0
    skey = "__skey"
    d = df.withColumn(skey, F.col(order_col).cast("double") * F.lit(sign))
    d = _bucketize(d, skey, "__bucket", n_buckets)[0]
    totals = d.groupBy("__bucket").agg(*[F.sum(v).alias(v) for v in value_cols])
    offs = _offsets(totals, [], "__bucket", value_cols)   # <= n_buckets rows
    d = d.join(F.broadcast(offs), "__bucket")
    w = Window.partitionBy("__bucket").orderBy(_ordered(order_col, ascending))
    frame = w.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    cols = {}
    for v in value_cols:
        cols[f"cum_{v}"] = F.coalesce(F.sum(v).over(frame), F.lit(0)) + F.col(f"__off_{v}")
        cols[f"total_{v}"] = F.col(f"__tot_{v}")
    d = d.withColumns(cols)
    return d.drop(skey, "__bucket", *[f"__off_{v}" for v in value_cols],
                  *[f"__tot_{v}" for v in value_cols])


def rank_by_value(df: DataFrame, order_col: str, tiebreak_key: str, rank_col: str = "rank",
                  n_buckets: int | None = None, rows_per_bucket: int = ROWS_PER_BUCKET,
                  descending: bool = False) -> DataFrame:
    """1-based global rank by (``order_col``, ``tiebreak_key``) (an md5 hex key).

    Equals ``row_number() OVER (ORDER BY order_col, tiebreak_key)``.  Buckets
    come from value quantiles; a hot value (one holding a whole quantile step
    or more) is split further by the md5 prefix of the tiebreak key, which
    keeps the order because inside that value rows sort by the key alone.
    """
    if n_buckets is None:
        n_buckets = _n_buckets(df.count(), rows_per_bucket)
    sign = -1.0 if descending else 1.0
    skey = "__skey"
    d = df.withColumn(skey, F.col(order_col).cast("double") * F.lit(sign))
    d, hot = _bucketize(d, skey, "__b", n_buckets)
    # from 2**53 on one double stands for several integers, which the tie-break
    # alone would not order
    hot = {b: v for b, v in hot.items() if abs(v) < 1 << 53}
    if hot:
        hot_map = F.create_map(*[x for kv in hot.items() for x in (F.lit(float(kv[0])), F.lit(kv[1]))])
        is_hot_row = F.col(skey) == hot_map[F.col("__b")]
        sub = F.when(is_hot_row, F.concat(F.lit("0"), F.substring(F.col(tiebreak_key), 1, 2))) \
               .otherwise(F.lit("1"))
    else:
        sub = F.lit("1")
    d = d.withColumn("__s", F.coalesce(sub, F.lit("1")))
    counts = d.groupBy("__b", "__s").agg(F.count(F.lit(1)).alias("__n"))
    w_small = Window.orderBy("__b", "__s").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.select("__b", "__s", F.coalesce(F.sum("__n").over(w_small), F.lit(0)).alias("__off"))
    d = d.join(F.broadcast(offs), ["__b", "__s"])           # bounded: buckets x 257
    w = Window.partitionBy("__b", "__s").orderBy(_ordered(order_col, not descending), tiebreak_key)
    d = d.withColumn(rank_col, F.row_number().over(w) + F.col("__off"))
    return d.drop(skey, "__b", "__s", "__off")


def grouped_prefix_sums(df: DataFrame, order_col: str, value_cols: list[str],
                        group_cols: list[str] | tuple = (), inclusive: bool = True,
                        n_buckets: int | None = None,
                        rows_per_bucket: int = ROWS_PER_BUCKET,
                        keep_bucket: bool = False) -> DataFrame:
    """Running sums of ``value_cols`` by ascending ``order_col`` inside each group.

    ``(group, order_col)`` must be unique (group by it first).  Buckets come
    from global value quantiles, so a group with many distinct values is
    spread over many tasks; offsets are per (group, bucket).
    Adds ``cum_<v>`` and ``total_<v>`` (and ``__bucket`` if ``keep_bucket``,
    so later joins can key on it too).
    """
    group_cols = list(group_cols)
    if n_buckets is None:
        n_buckets = _n_buckets(df.count(), rows_per_bucket)
    skey = "__skey"
    d = df.withColumn(skey, F.col(order_col).cast("double"))
    d = _bucketize(d, skey, "__bucket", n_buckets)[0]
    totals = d.groupBy(*group_cols, "__bucket").agg(*[F.sum(v).alias(v) for v in value_cols])
    offs = _offsets(totals, group_cols, "__bucket", value_cols)
    d = join_null_safe(d, offs, group_cols + ["__bucket"])
    w = Window.partitionBy(*group_cols, "__bucket").orderBy(_ordered(order_col, True))
    frame = w.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    cols = {}
    for v in value_cols:
        cols[f"cum_{v}"] = F.coalesce(F.sum(v).over(frame), F.lit(0)) + F.col(f"__off_{v}")
        cols[f"total_{v}"] = F.col(f"__tot_{v}")
    d = d.withColumns(cols)
    return d.drop(skey, *([] if keep_bucket else ["__bucket"]), *[f"__off_{v}" for v in value_cols],
                  *[f"__tot_{v}" for v in value_cols])


# Rank error of the sketches is at most rows / SKETCH; a bracket reaches three
# times as far.  Groups of at most SKETCH_ROWS rows need no bracket.
SKETCH = 10_000
SKETCH_ROWS = 20_000
# Bracketed values (all groups) that one window per group may order.
BRACKET_ROWS = 1_000_000


def sketch_aggs(value: Column, probs: list[float]) -> list[Column]:
    """Count and quantile sketch of a group: the input of ``exact_quantiles(sketch=...)``."""
    reach = 3.0 / SKETCH
    at = [x for p in probs for x in (max(p - reach, 0.0), min(p + reach, 1.0))]
    return [F.count(value).alias("__n"), F.percentile_approx(value, at, SKETCH).alias("__at")]


def exact_quantiles(df: DataFrame, value_col: str, probs: list[float],
                    group_cols: list[str] | tuple = (), names: list[str] | None = None,
                    n_buckets: int | None = None, sketch: DataFrame | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation (pandas / DuckDB ``quantile_cont``).

    Two passes.  The first merges a quantile sketch per group, which brackets
    every wanted order statistic within a few rows / 10,000.  The second counts
    the rows between the brackets and keeps only the values inside them, with
    their counts; rows outside collapse to one row per gap and task before the
    shuffle, so no table of distinct values is made.  What is left is small; if
    it is not (many groups, ``BRACKET_ROWS``) its ranks come from bucketed prefix
    sums instead of one window per group.  NULL values are ignored.

    ``sketch``: the first pass made elsewhere (groups, ``sketch_aggs``).
    """
    from ..session import stage_table
    group_cols = list(group_cols)
    names = names or [f"q{int(round(p * 100))}" for p in probs]
    base = df.where(F.col(value_col).isNotNull()).select(*group_cols, F.col(value_col).cast("double").alias("__v"))
    if sketch is None:
        sketch = stage_table(base.groupBy(*group_cols).agg(*sketch_aggs(F.col("__v"), probs)), "quantile-sketch")
    whole = F.col("__n") <= SKETCH_ROWS
    reach = 3.0 / SKETCH
    lows = [F.when(whole | F.lit(p - reach <= 0), F.lit(-math.inf)).otherwise(F.col("__at")[2 * i])
            for i, p in enumerate(probs)]
    highs = [F.when(whole | F.lit(p + reach >= 1), F.lit(math.nan)).otherwise(F.col("__at")[2 * i + 1])
             for i, p in enumerate(probs)]         # NaN orders last
    br = sketch.where(F.col("__n") > 0).select(*group_cols, *[c.alias(f"__lo{i}") for i, c in enumerate(lows)],
                                               *[c.alias(f"__hi{i}") for i, c in enumerate(highs)])
    small = not group_cols or sketch.count() <= BROADCAST_GROUPS
    j = join_null_safe(base, br, group_cols, hint_broadcast=small and bool(group_cols), one_row=not group_cols)
    inside, gap = F.lit(False), F.lit(0)
    for i in range(len(probs)):
        inside = inside | ((F.col("__v") >= F.col(f"__lo{i}")) & (F.col("__v") <= F.col(f"__hi{i}")))
        gap = gap + (F.col("__v") > F.col(f"__hi{i}")).cast("int")
    kept = j.select(*group_cols, "__v", F.when(inside, F.col("__v")).alias("__in"),
                    F.when(inside, F.lit(-1)).otherwise(gap).alias("__gap"))
    # one row per gap between brackets (its least value stands for it) or value inside
    dv = kept.groupBy(*group_cols, "__gap", "__in").agg(F.count(F.lit(1)).alias("__c"), F.min("__v").alias("__v"))
    dv = stage_table(dv.select(*group_cols, "__v", "__c"), "quantile-brackets")
    if n_buckets is None and dv.count() <= BRACKET_ROWS:
        cum = _group_sums(dv, group_cols)
    else:
        cum = grouped_prefix_sums(dv, "__v", ["__c"], group_cols, inclusive=True, n_buckets=n_buckets,
                                  keep_bucket=True)
    return _order_statistics(cum, probs, group_cols, names)


def _group_sums(dv: DataFrame, group_cols: list[str]) -> DataFrame:
    """Running counts by value, one window per group (few rows, one bucket)."""
    d = dv.withColumn("__bucket", F.lit(0.0))
    w = Window.partitionBy(*group_cols, "__bucket").orderBy(_ordered("__v", True))
    return d.withColumn("cum___c", F.sum("__c").over(w.rowsBetween(Window.unboundedPreceding, 0)))


def _order_statistics(cum: DataFrame, probs: list[float], group_cols: list[str], names: list[str]) -> DataFrame:
    """Interpolated quantiles from (group, bucket, value, count, running count).

    Each target rank is first placed in its bucket from the small (group,
    bucket) rank ranges, so the join with the covering value is keyed by bucket
    as well and no task holds a whole group.
    """
    cum = cum.withColumn("__lo_rank", F.col("cum___c") - F.col("__c"))   # 0-based first rank

    # per group and prob: positions lo, hi (0-based) and interpolation weight
    # (group, bucket) rank ranges: a small frame (groups x buckets); group sizes
    # come from it too, so ``cum`` itself is read only here and in the cover join
    ranges = cum.groupBy(*group_cols, "__bucket").agg(
        F.min("__lo_rank").alias("__b_lo"), F.max("cum___c").alias("__b_hi"))
    sizes = ranges.groupBy(*group_cols).agg(F.max("__b_hi").alias("__n"))
    tg = sizes.select(*group_cols, "__n", F.explode(F.array(*[
        F.struct(F.lit(i).alias("pi"), F.lit(float(p)).alias("p")) for i, p in enumerate(probs)])).alias("t"))
    pos = (F.col("__n") - 1).cast("double") * F.col("t.p")
    tg = tg.select(*group_cols, F.col("t.pi").alias("__pi"), pos.alias("__pos"))
    tg = tg.withColumns({"__r_lo": F.floor("__pos"), "__r_hi": F.ceil("__pos")})
    pts = tg.select(*group_cols, "__pi", "__pos", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.col("__r_lo").alias("r")),
        F.struct(F.lit(1).alias("side"), F.col("__r_hi").alias("r")))).alias("s")) \
        .select(*group_cols, "__pi", "__pos", "s.side", "s.r")
    ren = {c: f"__g_{c}" for c in group_cols}

    def same_group(cond):
        for c in group_cols:
            cond = cond & F.col(c).eqNullSafe(F.col(ren[c]))
        return cond
    # target rank -> its bucket, from the (group, bucket) rank ranges (small x small)
    br = ranges.withColumnsRenamed(ren)
    pts = pts.join(br, same_group((F.col("r") >= F.col("__b_lo")) & (F.col("r") < F.col("__b_hi"))), "inner") \
             .select(*group_cols, "__pi", "__pos", "side", "r", "__bucket")
    # cover: lo_rank <= r < cum   (equi on group and bucket, range inside)
    cvr = cum.select(*group_cols, F.col("__bucket").alias("__cb"), "__v", "__lo_rank",
                     F.col("cum___c").alias("__hi_rank")).withColumnsRenamed(ren)
    cond = same_group((F.col("__bucket") == F.col("__cb"))
                      & (F.col("r") >= F.col("__lo_rank")) & (F.col("r") < F.col("__hi_rank")))
    hit = pts.join(cvr, cond, "inner").select(*group_cols, "__pi", "__pos", "side", "__v")
    per = hit.groupBy(*group_cols, "__pi").agg(
        F.first("__pos").alias("__pos"),
        F.max(F.when(F.col("side") == 0, F.col("__v"))).alias("__vlo"),
        F.max(F.when(F.col("side") == 1, F.col("__v"))).alias("__vhi"))
    val = F.col("__vlo") + (F.col("__vhi") - F.col("__vlo")) * (F.col("__pos") - F.floor("__pos"))
    per = per.select(*group_cols, "__pi", val.alias("__q"))
    out = per.groupBy(*group_cols).pivot("__pi", list(range(len(probs)))).agg(F.first("__q"))
    return out.withColumnsRenamed({str(i): n for i, n in enumerate(names)})
