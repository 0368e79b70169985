"""§2.2 profiling queries bound to driver tables (lineitem ~ iris, orders ~ heart)."""

from pyspark.sql import functions as F

from ..operators import profile
from .registry import register, table

LI_NUM = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
          "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LI_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]

# orders with holes: NULLs made by nullif, the same way in both engines
GAPPY_ORDERS_SQL = """
  (SELECT o_orderkey, o_custkey,
          nullif(o_orderstatus, 'O') AS o_orderstatus,
          CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_totalprice END AS o_totalprice,
          o_orderdate,
          nullif(o_orderpriority, '1-URGENT') AS o_orderpriority
   FROM orders)
"""


def gappy_orders(spark, sf):
    o = table(spark, sf, "orders")
    return o.select(
        "o_orderkey", "o_custkey",
        F.nullif(F.col("o_orderstatus"), F.lit("O")).alias("o_orderstatus"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None).cast("double"))
         .otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        "o_orderdate",
        F.nullif(F.col("o_orderpriority"), F.lit("1-URGENT")).alias("o_orderpriority"))


@register("profile_shape", "SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(11 AS BIGINT) AS n_cols FROM lineitem")
def q_profile_shape(spark, sf):
    return profile.profile_shape(table(spark, sf, "lineitem"))


@register("profile_head", """
  SELECT o_orderkey, o_custkey, o_orderstatus, ROUND(o_totalprice, 6) AS o_totalprice, o_orderdate,
         o_orderpriority FROM orders ORDER BY o_orderkey LIMIT 5
""")
def q_profile_head(spark, sf):
    return profile.profile_head(table(spark, sf, "orders"), ["o_orderkey"], 5)


@register("text_head", """
  SELECT doc_id, concat(substring(text, 1, 80), '…') AS text FROM documents ORDER BY doc_id LIMIT 3
""")
def q_text_head(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text")
    return profile.text_head(d, "text", ["doc_id"], 3, 80)


def _info_sql():
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column, CAST(count({c}) AS BIGINT) AS non_null FROM {GAPPY_ORDERS_SQL}" for c in cols)


@register("profile_info", _info_sql())
def q_profile_info(spark, sf):
    return profile.profile_info(gappy_orders(spark, sf)).select("column", "non_null")


def _nulls_sql():
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
    inner = " UNION ALL ".join(
        f"SELECT '{c}' AS column, CAST(count(*) - count({c}) AS BIGINT) AS nulls FROM {GAPPY_ORDERS_SQL}"
        for c in cols)
    return f"SELECT * FROM ({inner}) WHERE nulls > 0"


@register("null_counts", _nulls_sql())
def q_null_counts(spark, sf):
    return profile.null_counts(gappy_orders(spark, sf))


def _describe_sql():
    parts = []
    for c in LI_NUM:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(f"""SELECT '{c}' AS column, CAST(count({x}) AS BIGINT) AS count,
            ROUND(avg({x}), 6) AS mean, ROUND(stddev_samp({x}), 6) AS std,
            ROUND(min({x}), 6) AS min, ROUND(quantile_cont({x}, 0.25), 6) AS q25,
            ROUND(quantile_cont({x}, 0.5), 6) AS q50, ROUND(quantile_cont({x}, 0.75), 6) AS q75,
            ROUND(max({x}), 6) AS max FROM lineitem""")
    return " UNION ALL ".join(parts)


@register("profile_describe", _describe_sql())
def q_profile_describe(spark, sf):
    return profile.profile_describe(table(spark, sf, "lineitem"), LI_NUM)


@register("value_counts", """
  SELECT event_type AS value, CAST(count(*) AS BIGINT) AS count FROM events
  WHERE event_type IS NOT NULL GROUP BY 1
""")
def q_value_counts(spark, sf):
    return profile.value_counts(table(spark, sf, "events"), "event_type")


@register("value_shares", """
  SELECT event_type AS value, CAST(count(*) AS BIGINT) AS count,
         ROUND(count(*) / sum(count(*)) OVER (), 6) AS share
  FROM events WHERE event_type IS NOT NULL GROUP BY 1
""")
def q_value_shares(spark, sf):
    return profile.value_shares(table(spark, sf, "events"), "event_type")


@register("flag_rate", """
  SELECT quality, CAST(count(*) AS BIGINT) AS n, ROUND(avg(CAST(toxic = 1 AS DOUBLE)), 6) AS rate
  FROM labels GROUP BY quality
""")
def q_flag_rate(spark, sf):
    lab = table(spark, sf, "labels")
    return profile.flag_rate(lab, F.col("toxic") == 1, ["quality"])


@register("distinct_count", """
  SELECT CAST(count(DISTINCT event_type) AS BIGINT) AS distinct_event_type,
         CAST(count(DISTINCT user_id) AS BIGINT) AS distinct_user_id FROM events
""")
def q_distinct_count(spark, sf):
    return profile.distinct_count(table(spark, sf, "events"), ["event_type", "user_id"])


@register("duplicate_count", """
  SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT text) AS BIGINT) AS n_distinct,
         CAST(count(*) - count(DISTINCT text) AS BIGINT) AS n_duplicates FROM documents
""")
def q_duplicate_count(spark, sf):
    return profile.duplicate_count(table(spark, sf, "documents"), ["text"])


def _corr_sql(lower_only=False):
    cols = LI_MEASURES
    parts = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            if lower_only and not i > j:
                continue
            r = (f"CASE WHEN stddev_pop({a}) * stddev_pop({b}) = 0 THEN NULL "
                 f"ELSE covar_pop({a}, {b}) / (stddev_pop({a}) * stddev_pop({b})) END")
            parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, CAST({i} AS BIGINT) AS i, "
                         f"CAST({j} AS BIGINT) AS j, ROUND({r}, 6) AS r FROM lineitem")
    return " UNION ALL ".join(parts)


@register("corr_matrix", _corr_sql())
def q_corr_matrix(spark, sf):
    return profile.corr_matrix(table(spark, sf, "lineitem"), LI_MEASURES)


# Twelve columns with missing values on different rows and one constant.
WIDE = {
    "quantity": "l_quantity", "price": "l_extendedprice", "discount": "l_discount", "tax": "l_tax",
    "net": "l_extendedprice * (1 - l_discount)", "unit": "l_extendedprice / l_quantity",
    "line": "CAST(l_linenumber AS DOUBLE)", "part_no": "CAST(l_partkey AS DOUBLE)",
    "low_tax": "CASE WHEN l_tax < 0.04 THEN l_tax END", "bulk": "CASE WHEN l_quantity > 25 THEN l_quantity END",
    "returned": "CASE WHEN l_returnflag = 'R' THEN 1.0 WHEN l_returnflag = 'A' THEN 0.0 END",
    "same": "CASE WHEN l_linenumber <> 2 THEN CAST(7 AS DOUBLE) END"}


def _corr_wide_sql():
    base = ", ".join(f"CAST({e} AS DOUBLE) AS {c}" for c, e in WIDE.items())
    parts = []
    for i, a in enumerate(WIDE):
        for j, b in enumerate(WIDE):
            x, y = f"CASE WHEN {b} IS NOT NULL THEN {a} END", f"CASE WHEN {a} IS NOT NULL THEN {b} END"
            sd = f"stddev_pop({x}) * stddev_pop({y})"
            parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, CAST({i} AS BIGINT) AS i, CAST({j} AS BIGINT) AS j, "
                         f"ROUND(CASE WHEN {sd} > 0 THEN covar_pop({x}, {y}) / ({sd}) END, 6) AS r FROM w")
    return f"WITH w AS MATERIALIZED (SELECT {base} FROM lineitem) " + " UNION ALL ".join(parts)


@register("corr_matrix_wide", _corr_wide_sql())
def q_corr_wide(spark, sf):
    """Blocked one-scan form, as used beyond a dozen or so columns."""
    from ..operators.gram import corr_wide
    d = table(spark, sf, "lineitem").selectExpr(*[f"CAST({e} AS DOUBLE) AS {c}" for c, e in WIDE.items()])
    return corr_wide(d, list(WIDE))


@register("corr_lower_triangle", _corr_sql(lower_only=True))
def q_corr_lower(spark, sf):
    return profile.corr_lower_triangle(table(spark, sf, "lineitem"), LI_MEASURES)


@register("corr_with_target", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, ROUND(CASE WHEN stddev_pop({c}) * stddev_pop(l_extendedprice) = 0 THEN NULL "
    f"ELSE covar_pop({c}, l_extendedprice) / (stddev_pop({c}) * stddev_pop(l_extendedprice)) END, 6) AS r "
    f"FROM lineitem" for c in ["l_quantity", "l_discount", "l_tax"]))
def q_corr_target(spark, sf):
    return profile.corr_with_target(table(spark, sf, "lineitem"), "l_extendedprice",
                                    ["l_quantity", "l_discount", "l_tax"])


@register("columns_by_type", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def q_columns_by_type(spark, sf):
    """Numeric columns found from the schema (no job), then projected: the
    scan reads only those columns."""
    o = table(spark, sf, "orders")
    return o.select(*profile.columns_by_type(o)["numeric"])
