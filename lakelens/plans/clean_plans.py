"""§2.3-2.4 projection, scalar and cleaning queries."""

from pyspark.sql import functions as F

from ..functions.keys import md5_key
from ..operators import clean
from .profile_plans import GAPPY_ORDERS_SQL, gappy_orders
from .registry import register, table

NUM_RE = clean.NUMBER_PATTERN
SPC_RE = clean.SPECIAL_PATTERN


def coerce_sql(x: str) -> str:
    t = f"trim({x})"
    v = (f"CASE WHEN regexp_matches({t}, '{NUM_RE}') OR regexp_matches({t}, '{SPC_RE}') "
         f"THEN TRY_CAST({t} AS DOUBLE) END")
    return f"(CASE WHEN isnan({v}) THEN NULL ELSE {v} END)"


@register("rename_positional", "SELECT n_nationkey AS nation_key, n_name AS nation, n_regionkey AS region_key FROM nation")
def q_rename(spark, sf):
    return clean.rename_positional(table(spark, sf, "nation"), ["nation_key", "nation", "region_key"])


@register("drop_columns", "SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer")
def q_drop_columns(spark, sf):
    return clean.drop_columns(table(spark, sf, "customer"), ["c_acctbal", "not_there"])


@register("select_except", """
  SELECT l_quantity, ROUND(l_extendedprice, 6) AS l_extendedprice, ROUND(l_discount, 6) AS l_discount,
         ROUND(l_tax, 6) AS l_tax FROM lineitem
""")
def q_select_except(spark, sf):
    li = table(spark, sf, "lineitem").select("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag")
    return clean.select_except(li, ["l_returnflag"])


@register("filter_by_class", """
  SELECT l_orderkey, l_linenumber, ROUND(l_quantity, 6) AS l_quantity FROM lineitem WHERE l_returnflag = 'R'
""")
def q_filter_by_class(spark, sf):
    li = table(spark, sf, "lineitem")
    return clean.filter_by_class(li, "l_returnflag", "R").select("l_orderkey", "l_linenumber", "l_quantity")


@register("binarize", f"""
  SELECT o_orderkey, CAST(coalesce(o_orderstatus = 'F', false) AS INTEGER) AS target,
         CAST(coalesce(o_totalprice > 200000, false) AS INTEGER) AS big
  FROM {GAPPY_ORDERS_SQL}
""")
def q_binarize(spark, sf):
    o = gappy_orders(spark, sf)
    return o.select("o_orderkey", clean.binarize(F.col("o_orderstatus") == "F").alias("target"),
                    clean.binarize(F.col("o_totalprice") > 200000).alias("big"))


# Class names for line numbers 1..7 (a label list, as a code -> name map).
LINE_LABELS = {1: "first", 2: "second", 3: "third", 4: "fourth", 5: "fifth", 6: "sixth", 7: "seventh"}


@register("code_to_label", "SELECT l_orderkey, l_linenumber, CASE l_linenumber " +
          " ".join(f"WHEN {k} THEN '{v}'" for k, v in LINE_LABELS.items()) + " END AS label FROM lineitem")
def q_code_to_label(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    return clean.code_to_label(li, "l_linenumber", LINE_LABELS)


@register("derive_arith", """
  SELECT l_orderkey, l_linenumber, ROUND(l_extendedprice - l_quantity, 6) AS diff,
         ROUND(round_even(l_quantity * l_discount, 2), 6) AS prod2
  FROM lineitem
""")
def q_derive_arith(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", (F.col("l_extendedprice") - F.col("l_quantity")).alias("diff"),
                     F.bround(F.col("l_quantity") * F.col("l_discount"), 2).alias("prod2"))


# strings built from events so that every coercion case occurs in the driver table
RAW_SQL = """
  (SELECT event_id, CASE event_type
      WHEN 'error' THEN concat(CAST(value AS VARCHAR), 'd')
      WHEN 'view' THEN concat(' ', CAST(value AS VARCHAR), ' ')
      WHEN 'click' THEN '?'
      WHEN 'purchase' THEN concat(CAST(CAST(floor(value) AS BIGINT) AS VARCHAR), 'e2')
      ELSE CAST(value AS VARCHAR) END AS raw FROM events)
"""


def raw_strings(spark, sf):
    e = table(spark, sf, "events")
    v = F.col("value").cast("string")
    raw = (F.when(F.col("event_type") == "error", F.concat(v, F.lit("d")))
           .when(F.col("event_type") == "view", F.concat(F.lit(" "), v, F.lit(" ")))
           .when(F.col("event_type") == "click", F.lit("?"))
           .when(F.col("event_type") == "purchase", F.concat(F.floor("value").cast("bigint").cast("string"), F.lit("e2")))
           .otherwise(v))
    return e.select("event_id", raw.alias("raw"))


@register("coerce_numeric", f"SELECT event_id, raw, ROUND({coerce_sql('raw')}, 6) AS num FROM {RAW_SQL}")
def q_coerce(spark, sf):
    return raw_strings(spark, sf).withColumn("num", clean.coerce_numeric("raw"))


@register("clip", """
  SELECT o_orderkey, ROUND(greatest(50000.0, least(300000.0, o_totalprice)), 6) AS price FROM orders
""")
def q_clip(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", clean.clip("o_totalprice", 50000.0, 300000.0).alias("price"))


@register("min_max_scale", """
  SELECT c_custkey, ROUND((c_acctbal - mn) / (mx - mn + 1e-9), 6) AS c_acctbal
  FROM customer, (SELECT min(c_acctbal) AS mn, max(c_acctbal) AS mx FROM customer)
""")
def q_min_max(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return clean.min_max_scale(c, ["c_acctbal"])


@register("log_target", """
  SELECT o_orderkey, ROUND(ln(1 + o_totalprice), 6) AS log_price,
         ROUND(exp(ln(1 + o_totalprice)) - 1, 6) AS price_back FROM orders
""")
def q_log_target(spark, sf):
    o = table(spark, sf, "orders")
    lp = clean.log_target("o_totalprice")
    return o.select("o_orderkey", lp.alias("log_price"), F.expm1(lp).alias("price_back"))


@register("format_id", """
  SELECT c_custkey, printf('CUST-%05d', row_number() OVER (ORDER BY c_custkey)) AS customer_id FROM customer
""")
def q_format_id(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey")
    r = clean.number_rows(c, "c_custkey")
    return r.select("c_custkey", clean.format_id(F.col("rank"), "CUST-", 5).alias("customer_id"))


@register("inject_nulls", """
  SELECT c_custkey, CASE WHEN row_number() OVER (ORDER BY md5(concat(CAST(c_custkey AS VARCHAR), '|42'))) <= 11
                    THEN NULL ELSE ROUND(c_acctbal, 6) END AS c_acctbal FROM customer
""")
def q_inject_nulls(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return clean.inject_nulls(c, "c_acctbal", 11, ["c_custkey"])


@register("fill_median", f"""
  SELECT o_orderkey, ROUND(coalesce(o_totalprice, (SELECT quantile_cont(o_totalprice, 0.5) FROM {GAPPY_ORDERS_SQL})), 6)
         AS o_totalprice
  FROM {GAPPY_ORDERS_SQL}
""")
def q_fill_median(spark, sf):
    o = gappy_orders(spark, sf).select("o_orderkey", "o_totalprice")
    filled, _ = clean.fill_median(o, ["o_totalprice"])
    return filled


@register("fill_median_report", f"""
  SELECT 'o_totalprice' AS column, CAST(count(*) - count(o_totalprice) AS BIGINT) AS filled,
         ROUND(quantile_cont(o_totalprice, 0.5), 6) AS median FROM {GAPPY_ORDERS_SQL}
""")
def q_fill_median_report(spark, sf):
    o = gappy_orders(spark, sf).select("o_orderkey", "o_totalprice")
    _, rep = clean.fill_median(o, ["o_orderkey", "o_totalprice"])
    return rep


@register("drop_duplicates", "SELECT DISTINCT o_custkey, o_orderstatus FROM orders")
def q_drop_duplicates(spark, sf):
    return clean.drop_duplicates(table(spark, sf, "orders").select("o_custkey", "o_orderstatus"))


@register("drop_nulls", f"""
  SELECT o_orderkey, o_custkey, o_orderstatus, ROUND(o_totalprice, 6) AS o_totalprice, o_orderdate, o_orderpriority
  FROM {GAPPY_ORDERS_SQL}
  WHERE o_orderstatus IS NOT NULL AND o_totalprice IS NOT NULL AND o_orderpriority IS NOT NULL
""")
def q_drop_nulls(spark, sf):
    return clean.drop_nulls(gappy_orders(spark, sf))


CLEAN_IN_SQL = f"""
  (SELECT o_custkey, o_totalprice, substring(o_orderpriority, 1, 1) AS prio FROM {GAPPY_ORDERS_SQL})
"""


def clean_input(spark, sf):
    o = gappy_orders(spark, sf)
    return o.select("o_custkey", "o_totalprice", F.substring("o_orderpriority", 1, 1).alias("prio"))


@register("clean_table", f"""
  WITH m AS (SELECT quantile_cont(o_custkey, 0.5) AS mc, quantile_cont(o_totalprice, 0.5) AS mp FROM {CLEAN_IN_SQL}),
  f AS (SELECT DISTINCT coalesce(o_custkey, CAST(mc AS BIGINT)) AS o_custkey,
               coalesce(o_totalprice, mp) AS o_totalprice, prio FROM {CLEAN_IN_SQL}, m),
  c AS (SELECT o_custkey, o_totalprice, {coerce_sql('prio')} AS prio FROM f)
  SELECT o_custkey, ROUND(o_totalprice, 6) AS o_totalprice, ROUND(prio, 6) AS prio FROM c
  WHERE o_custkey IS NOT NULL AND o_totalprice IS NOT NULL AND prio IS NOT NULL
""")
def q_clean_table(spark, sf):
    out, _ = clean.clean_table(clean_input(spark, sf))
    return out


@register("clean_report", f"""
  WITH m AS (SELECT quantile_cont(o_totalprice, 0.5) AS mp FROM {CLEAN_IN_SQL}),
  f AS (SELECT o_custkey, coalesce(o_totalprice, mp) AS o_totalprice, prio FROM {CLEAN_IN_SQL}, m),
  d AS (SELECT DISTINCT * FROM f),
  c AS (SELECT o_custkey, o_totalprice, {coerce_sql('prio')} AS prio FROM d)
  SELECT CAST(0 AS INTEGER) AS pos, 'input' AS step, CAST(count(*) AS BIGINT) AS rows FROM {CLEAN_IN_SQL}
  UNION ALL SELECT 1, 'fill_median', CAST(count(*) AS BIGINT) FROM f
  UNION ALL SELECT 2, 'drop_duplicates', CAST(count(*) AS BIGINT) FROM d
  UNION ALL SELECT 3, 'coerce', CAST(count(*) AS BIGINT) FROM c
  UNION ALL SELECT 4, 'drop_nulls', CAST(count(*) AS BIGINT) FROM c WHERE prio IS NOT NULL
""")
def q_clean_report(spark, sf):
    _, steps = clean.clean_table(clean_input(spark, sf))
    return clean.step_report(steps)


SPLIT_KEY = "md5(concat(CAST(o_orderkey AS VARCHAR), '|7'))"


@register("impute_median_fit", f"""
  WITH g AS (SELECT *, {SPLIT_KEY} < 'cc' AS is_train FROM {GAPPY_ORDERS_SQL}),
  m AS (SELECT quantile_cont(o_totalprice, 0.5) AS mp FROM g WHERE is_train)
  SELECT o_orderkey, ROUND(coalesce(o_totalprice, mp), 6) AS o_totalprice FROM g, m WHERE NOT is_train
""")
def q_impute_median_fit(spark, sf):
    o = gappy_orders(spark, sf).withColumn("__k", md5_key("o_orderkey", seed=7))
    train = o.where(F.col("__k") < "cc")
    test = o.where(F.col("__k") >= "cc")
    imp = clean.impute_median_fit(train, ["o_totalprice"])
    return imp.transform(test).select("o_orderkey", "o_totalprice")


@register("impute_most_frequent", f"""
  WITH g AS (SELECT * FROM {GAPPY_ORDERS_SQL}),
  cs AS (SELECT o_orderstatus AS v, count(*) AS n FROM g WHERE o_orderstatus IS NOT NULL GROUP BY 1),
  ms AS (SELECT min(v) AS v FROM cs WHERE n = (SELECT max(n) FROM cs)),
  cp AS (SELECT o_orderpriority AS v, count(*) AS n FROM g WHERE o_orderpriority IS NOT NULL GROUP BY 1),
  mp AS (SELECT min(v) AS v FROM cp WHERE n = (SELECT max(n) FROM cp))
  SELECT o_orderkey, coalesce(o_orderstatus, ms.v) AS o_orderstatus, coalesce(o_orderpriority, mp.v) AS o_orderpriority
  FROM g, ms, mp
""")
def q_impute_most_frequent(spark, sf):
    o = gappy_orders(spark, sf).select("o_orderkey", "o_orderstatus", "o_orderpriority")
    imp = clean.impute_most_frequent_fit(o, ["o_orderstatus", "o_orderpriority"])
    return imp.transform(o)
