"""§2.6 plot-data tables on driver tables (lineitem by return flag ~ iris by species)."""

from pyspark.sql import functions as F

from ..operators import tables
from .registry import register, table

STATUSES = ["F", "O", "P"]
LINESTATUS = ["F", "O"]


def _pivot_sql(row, col, values, src, fill=True, share=False):
    cells = []
    for v in values:
        c = f"count(*) FILTER (WHERE {col} = '{v}')"
        if share:
            tot = " + ".join(f"count(*) FILTER (WHERE {col} = '{u}')" for u in values)
            cells.append(f"ROUND(CASE WHEN ({tot}) = 0 THEN NULL ELSE CAST({c} AS DOUBLE) / ({tot}) END, 6) AS \"{v}\"")
        elif fill:
            cells.append(f"CAST({c} AS BIGINT) AS \"{v}\"")
        else:
            cells.append(f"CAST(CASE WHEN {c} = 0 THEN NULL ELSE {c} END AS BIGINT) AS \"{v}\"")
    return f"SELECT {row}, {', '.join(cells)} FROM {src} GROUP BY {row}"


@register("group_size", """
  SELECT o_orderpriority, o_orderstatus, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY 1, 2
""")
def q_group_size(spark, sf):
    return tables.group_size(table(spark, sf, "orders"), "o_orderpriority", "o_orderstatus")


@register("crosstab_filled", _pivot_sql("o_orderpriority", "o_orderstatus", STATUSES, "orders"))
def q_crosstab_filled(spark, sf):
    return tables.crosstab(table(spark, sf, "orders"), "o_orderpriority", "o_orderstatus", STATUSES)


@register("crosstab_sparse", _pivot_sql("l_returnflag", "l_linestatus", LINESTATUS, "lineitem", fill=False))
def q_crosstab_sparse(spark, sf):
    return tables.crosstab(table(spark, sf, "lineitem"), "l_returnflag", "l_linestatus", LINESTATUS, fill=False)


@register("crosstab_row_share", _pivot_sql("l_returnflag", "l_linestatus", LINESTATUS, "lineitem", share=True))
def q_crosstab_row_share(spark, sf):
    return tables.crosstab_row_share(table(spark, sf, "lineitem"), "l_returnflag", "l_linestatus", LINESTATUS)


@register("crosstab_fixed_columns", _pivot_sql("o_orderpriority", "o_orderstatus", STATUSES + ["X"], "orders"))
def q_crosstab_fixed(spark, sf):
    return tables.crosstab(table(spark, sf, "orders"), "o_orderpriority", "o_orderstatus", STATUSES + ["X"])


def _hist_sql(x, bins, src, group=None):
    g = f"{group} AS g" if group else "0 AS g"
    out_g = f"grid.g AS {group}, " if group else ""
    return f"""
  WITH d AS (SELECT {g}, CAST({x} AS DOUBLE) AS x FROM {src} WHERE {x} IS NOT NULL),
  st AS (SELECT g, CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS lo,
                   CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END AS hi FROM d GROUP BY g),
  st2 AS (SELECT *, (hi - lo) / CAST({bins} AS DOUBLE) AS w FROM st),
  i0 AS (SELECT d.g, x, lo, w, least(floor((x - lo) * (CAST({bins} AS DOUBLE) / (hi - lo))), {bins - 1}) AS i
         FROM d JOIN st2 ON d.g = st2.g),
  i1 AS (SELECT g, x, lo, w, CASE WHEN x < lo + i * w THEN i - 1 ELSE i END AS i FROM i0),
  i2 AS (SELECT g, CASE WHEN x >= lo + (i + 1) * w AND i != {bins - 1} THEN i + 1 ELSE i END AS i FROM i1),
  c AS (SELECT g, CAST(i AS BIGINT) AS bin, count(*) AS n FROM i2 GROUP BY 1, 2),
  grid AS (SELECT g, lo, hi, w, CAST(b AS BIGINT) AS bin FROM st2, range(0, {bins}) t(b))
  SELECT {out_g}grid.bin, ROUND(lo + CAST(grid.bin AS DOUBLE) * w, 6) AS edge_lo,
         ROUND(CASE WHEN grid.bin = {bins - 1} THEN hi ELSE lo + CAST(grid.bin + 1 AS DOUBLE) * w END, 6) AS edge_hi,
         CAST(coalesce(n, 0) AS BIGINT) AS count
  FROM grid LEFT JOIN c ON grid.g = c.g AND grid.bin = c.bin
"""


@register("hist_by_group", _hist_sql("l_quantity", 15, "lineitem", "l_returnflag"))
def q_hist_by_group(spark, sf):
    return tables.histogram(table(spark, sf, "lineitem"), "l_quantity", 15, ["l_returnflag"])


@register("hist_global", _hist_sql("o_totalprice", 40, "orders"))
def q_hist_global(spark, sf):
    return tables.histogram(table(spark, sf, "orders"), "o_totalprice", 40)


def _box_sql(x, group, src):
    return f"""
  WITH d AS (SELECT {group}, CAST({x} AS DOUBLE) AS x FROM {src} WHERE {x} IS NOT NULL),
  q AS (SELECT {group}, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median,
               quantile_cont(x, 0.75) AS q3 FROM d GROUP BY 1),
  j AS (SELECT d.{group}, x, q1, median, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS flo, q3 + 1.5 * (q3 - q1) AS fhi
        FROM d JOIN q ON d.{group} = q.{group})
  SELECT {group}, CAST(count(*) AS BIGINT) AS n, ROUND(min(q1), 6) AS q1, ROUND(min(median), 6) AS median,
         ROUND(min(q3), 6) AS q3, ROUND(min(iqr), 6) AS iqr,
         ROUND(min(x) FILTER (WHERE x >= flo AND x <= fhi), 6) AS whisker_lo,
         ROUND(max(x) FILTER (WHERE x >= flo AND x <= fhi), 6) AS whisker_hi,
         CAST(count(*) FILTER (WHERE NOT (x >= flo AND x <= fhi)) AS BIGINT) AS n_outliers
  FROM j GROUP BY 1
"""


@register("box_stats", _box_sql("l_extendedprice", "l_returnflag", "lineitem"))
def q_box_stats(spark, sf):
    return tables.box_stats(table(spark, sf, "lineitem"), "l_extendedprice", ["l_returnflag"])


@register("dist_by_category", _box_sql("value", "event_type", "events"))
def q_dist_by_category(spark, sf):
    return tables.box_stats(table(spark, sf, "events"), "value", ["event_type"])


@register("box_outliers", """
  WITH d AS (SELECT event_type, event_id, CAST(value AS DOUBLE) AS x FROM events),
  q AS (SELECT event_type, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.75) AS q3 FROM d GROUP BY 1)
  SELECT d.event_type, event_id, ROUND(x, 6) AS value FROM d JOIN q ON d.event_type = q.event_type
  WHERE x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1)
""")
def q_box_outliers(spark, sf):
    return tables.box_outliers(table(spark, sf, "events"), "value", ["event_type"], keep=["event_id"])


@register("kde_by_group", """
  WITH d AS (SELECT l_returnflag AS g, CAST(l_quantity AS DOUBLE) AS x FROM lineitem),
  st AS (SELECT g, count(*) AS n, stddev_samp(x) AS sd, min(x) AS mn, max(x) AS mx FROM d GROUP BY g),
  st2 AS (SELECT *, sd * pow(CAST(n AS DOUBLE), -0.2) AS h FROM st),
  dv AS (SELECT g, x, count(*) AS c FROM d GROUP BY g, x),
  grid AS (SELECT g, n, h, CAST(p AS INTEGER) AS point,
                  (mn - (mx - mn) / 2) + CAST(p AS DOUBLE) * ((mx - mn) * 2 / CAST(999 AS DOUBLE)) AS grid_x
           FROM st2, range(0, 1000) t(p))
  SELECT grid.g AS l_returnflag, point, ROUND(min(grid_x), 6) AS grid_x,
         ROUND(sum(c * exp(-0.5 * ((grid_x - x) / h) * ((grid_x - x) / h))) /
               (CAST(min(n) AS DOUBLE) * min(h) * sqrt(2 * pi())), 6) AS density
  FROM dv JOIN grid ON dv.g = grid.g GROUP BY 1, 2
""")
def q_kde(spark, sf):
    return tables.kde(table(spark, sf, "lineitem"), "l_quantity", ["l_returnflag"], points=1000)


@register("scatter_pairs", """
  SELECT l_orderkey, l_linenumber, l_returnflag AS class, p.pair, ROUND(p.x, 6) AS x, ROUND(p.y, 6) AS y FROM (
    SELECT l_orderkey, l_linenumber, l_returnflag, unnest([
      {'pair': 'l_quantity~l_extendedprice', 'x': CAST(l_quantity AS DOUBLE), 'y': CAST(l_extendedprice AS DOUBLE)},
      {'pair': 'l_discount~l_tax', 'x': CAST(l_discount AS DOUBLE), 'y': CAST(l_tax AS DOUBLE)}]) AS p
    FROM lineitem)
""")
def q_scatter(spark, sf):
    return tables.scatter_pairs(table(spark, sf, "lineitem"),
                                [("l_quantity", "l_extendedprice"), ("l_discount", "l_tax")],
                                cls="l_returnflag", key_cols=["l_orderkey", "l_linenumber"])


@register("group_mean", """
  SELECT event_type, ROUND(avg(value), 6) AS mean_value FROM events GROUP BY 1
""")
def q_group_mean(spark, sf):
    return tables.group_mean(table(spark, sf, "events"), "event_type", ["value"])


@register("argmax_group", """
  SELECT arg_max(c_mktsegment, m) AS best_c_mktsegment, ROUND(max(m), 6) AS best_m
  FROM (SELECT c_mktsegment, avg(c_acctbal) AS m FROM customer GROUP BY 1)
""")
def q_argmax(spark, sf):
    seg = table(spark, sf, "customer").groupBy("c_mktsegment").agg(F.avg("c_acctbal").alias("m"))
    return tables.argmax_group(seg, "c_mktsegment", "m")


@register("min_max_range", """
  SELECT ROUND(min(o_totalprice), 6) AS min, ROUND(max(o_totalprice), 6) AS max,
         ROUND(max(o_totalprice) - min(o_totalprice), 6) AS range FROM orders
""")
def q_min_max_range(spark, sf):
    return tables.min_max_range(table(spark, sf, "orders"), "o_totalprice")
