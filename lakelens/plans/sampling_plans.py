"""§2.8-2.10 samples, splits, folds and top-k on driver tables."""

from pyspark.sql import functions as F

from ..operators import sampling
from .registry import register, table

DOC_KEY = "md5(concat(CAST(doc_id AS VARCHAR), '|42'))"
ORD_KEY = "md5(concat(CAST(o_orderkey AS VARCHAR), '|42'))"

STRAT_SQL = f"""
  WITH cc AS (SELECT toxic, count(*) AS n_class FROM labels GROUP BY 1),
  t AS (SELECT *, sum(n_class) OVER () AS n FROM cc),
  t2 AS (SELECT *, n - CAST(ceil(n * 0.2) AS BIGINT) AS ntrain FROM t),
  t3 AS (SELECT *, (ntrain * n_class) // n AS fl, (ntrain * n_class) % n AS rem FROM t2),
  t4 AS (SELECT *, ntrain - sum(fl) OVER () AS lft, row_number() OVER (ORDER BY rem DESC, toxic) AS ord FROM t3),
  q AS (SELECT toxic, n_class - (fl + CASE WHEN ord <= lft THEN 1 ELSE 0 END) AS n_test FROM t4),
  r AS (SELECT labels.*, row_number() OVER (PARTITION BY toxic ORDER BY {DOC_KEY}) AS rk FROM labels)
  SELECT r.doc_id, r.quality, r.toxic, CASE WHEN rk <= n_test THEN 'test' ELSE 'train' END AS part
  FROM r JOIN q ON r.toxic = q.toxic
"""


def _strat(spark, sf):
    return sampling.stratified_split(table(spark, sf, "labels"), "toxic", ["doc_id"])


@register("exact_sample", f"""
  SELECT doc_id, lang FROM documents ORDER BY {DOC_KEY} LIMIT 100
""")
def q_exact_sample(spark, sf):
    return sampling.exact_sample(table(spark, sf, "documents").select("doc_id", "lang"), 100, ["doc_id"])


@register("shuffle_rows", f"""
  SELECT o_orderkey, CAST(row_number() OVER (ORDER BY {ORD_KEY}) AS INTEGER) AS pos FROM orders
""")
def q_shuffle(spark, sf):
    return sampling.shuffle_rows(table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"])


@register("random_split", f"""
  SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY {ORD_KEY}) <= ceil(count(*) OVER () * 0.2)
                     THEN 'test' ELSE 'train' END AS part FROM orders
""")
def q_random_split(spark, sf):
    return sampling.random_split(table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"])


@register("stratified_split", STRAT_SQL)
def q_stratified(spark, sf):
    return _strat(spark, sf)


@register("split_report", f"""
  SELECT part, toxic, CAST(count(*) AS BIGINT) AS n FROM ({STRAT_SQL}) GROUP BY 1, 2
""")
def q_split_report(spark, sf):
    return sampling.split_report(_strat(spark, sf), "part", "toxic")


@register("split_complement", f"SELECT doc_id, toxic FROM ({STRAT_SQL}) WHERE part = 'test'")
def q_split_complement(spark, sf):
    _, test = sampling.split_parts(_strat(spark, sf))
    return test.select("doc_id", "toxic")


@register("stratified_folds", f"""
  SELECT doc_id, toxic, CAST((row_number() OVER (PARTITION BY toxic ORDER BY {DOC_KEY}) - 1) % 5 AS INTEGER) AS fold
  FROM labels
""")
def q_folds(spark, sf):
    return sampling.stratified_folds(table(spark, sf, "labels").select("doc_id", "toxic"), "toxic", ["doc_id"])


@register("systematic_sample", f"""
  WITH r AS (SELECT o_orderkey, o_totalprice,
                    row_number() OVER (ORDER BY o_totalprice, {ORD_KEY}) AS position,
                    count(*) OVER () AS n FROM orders)
  SELECT o_orderkey, ROUND(o_totalprice, 6) AS o_totalprice, CAST(position AS INTEGER) AS position FROM r
  WHERE (position - 1) % greatest(n // 10, 1) = 0 AND position - 1 < greatest(n // 10, 1) * 10
""")
def q_systematic(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return sampling.systematic_sample(o, "o_totalprice", ["o_orderkey"], 10)


@register("global_rank", f"""
  SELECT l_orderkey, l_linenumber,
         CAST(row_number() OVER (ORDER BY l_extendedprice, md5(concat(CAST(l_orderkey AS VARCHAR), '|',
              CAST(l_linenumber AS VARCHAR), '|42'))) AS INTEGER) AS rank
  FROM lineitem
""")
def q_global_rank(spark, sf):
    from ..functions.keys import md5_key, rank_by_value
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    li = li.withColumn("__k", md5_key("l_orderkey", "l_linenumber", seed=42))
    return rank_by_value(li, "l_extendedprice", "__k", "rank").select("l_orderkey", "l_linenumber", "rank")


@register("top_k", """
  SELECT c_custkey, c_name, ROUND(c_acctbal, 6) AS c_acctbal FROM customer ORDER BY c_acctbal DESC, c_name LIMIT 15
""")
def q_top_k(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    return sampling.top_k(c, "c_acctbal", 15, name="c_name")


@register("sort_scores", """
  SELECT p_type, ROUND(avg(p_retailprice), 6) AS score FROM part GROUP BY 1 ORDER BY score
""")
def q_sort_scores(spark, sf):
    p = table(spark, sf, "part").groupBy("p_type").agg(F.avg("p_retailprice").alias("score"))
    return sampling.sort_scores(p, "score", ascending=True)
