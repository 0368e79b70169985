"""§2.1 sources and sinks on driver tables (round trips go through the shared
checkpoint folder, never a machine-local path)."""

import uuid

from pyspark.sql import functions as F

from ..session import scratch_path, spread
from ..sources import files, generators
from .registry import register, table


def _u(key, name):
    return (f"(CAST(('0x' || substr(md5(concat_ws('|', CAST({key} AS VARCHAR), '{name}', '42')), 1, 8)) AS BIGINT)"
            f" / 4294967296.0)")


def _u_open(key, name):
    return (f"((CAST(('0x' || substr(md5(concat_ws('|', CAST({key} AS VARCHAR), '{name}', '42')), 1, 8)) AS BIGINT)"
            f" + 1.0) / 4294967297.0)")


def _choice_sql(key, name, values, probs):
    u = _u(key, name)
    if probs is None:
        lst = "[" + ", ".join(f"'{v}'" for v in values) + "]"
        return f"{lst}[CAST(floor({u} * {len(values)}) AS INTEGER) + 1]"
    parts, cum = [], 0.0
    for v, p in zip(values[:-1], probs[:-1]):
        cum += p
        parts.append(f"WHEN {u} < {cum!r} THEN '{v}'")
    return f"CASE {' '.join(parts)} ELSE '{values[-1]}' END"


def _int_sql(key, name, lo, hi):
    return f"CAST({lo} + floor({_u(key, name)} * {hi - lo}) AS BIGINT)"


def churn_sql(key="c_custkey", src="customer"):
    cols = [f"printf('CUST-%05d', {key}) AS customerID"]
    for name, (vals, probs) in generators.CHURN_CATEGORIES.items():
        cols.append(f"{_choice_sql(key, name, vals, probs)} AS \"{name}\"")
    cols.append(f"CAST({_int_sql(key, 'SeniorCitizen', 0, 2)} AS INTEGER) AS SeniorCitizen")
    cols.append(f"CAST({_int_sql(key, 'tenure', 0, 72)} AS DOUBLE) AS tenure")
    cols.append(f"round(18.0 + {_u(key, 'MonthlyCharges')} * 100.0, 2) AS MonthlyCharges")
    return f"""
  (WITH g AS (SELECT {key} AS __id, {', '.join(cols)} FROM {src}),
   t AS (SELECT *, round(tenure * MonthlyCharges, 2) AS tc,
                row_number() OVER (ORDER BY md5(concat_ws('|', CAST(__id AS VARCHAR), 'null', '42'))) AS r FROM g)
   SELECT customerID, gender, SeniorCitizen, Partner, Dependents, tenure, PhoneService, MultipleLines,
          InternetService, OnlineSecurity, TechSupport, Contract, PaperlessBilling, PaymentMethod,
          MonthlyCharges, CASE WHEN r <= {generators.CHURN_NULLS} THEN NULL ELSE tc END AS TotalCharges, Churn FROM t)
"""


def housing_sql(key="p_partkey", src="part"):
    lin = " + ".join(f"{c} * {w!r}" for c, w in generators.HOUSE_COEFS.items())
    noise = (f"(0.0 + {generators.HOUSE_NOISE_SD!r} * sqrt(-2.0 * ln({_u_open(key, 'noise.1')})) "
             f"* cos({2 * 3.141592653589793!r} * {_u(key, 'noise.2')}))")
    return f"""
  (WITH g AS (SELECT {key} AS house_id,
       CAST({_int_sql(key, 'sqft', 600, 4500)} AS DOUBLE) AS sqft,
       CAST({_int_sql(key, 'bedrooms', 1, 6)} AS DOUBLE) AS bedrooms,
       round(1.0 + {_u(key, 'bathrooms')} * 3.0, 1) AS bathrooms,
       CAST({_int_sql(key, 'house_age', 0, 60)} AS DOUBLE) AS house_age,
       CAST({_int_sql(key, 'has_garage', 0, 2)} AS DOUBLE) AS has_garage,
       round(1.0 + {_u(key, 'location_score')} * 9.0, 1) AS location_score,
       {noise} AS noise FROM {src})
   SELECT house_id, sqft, bedrooms, bathrooms, house_age, has_garage, location_score,
          greatest({generators.HOUSE_CLIP[0]!r}, least({generators.HOUSE_CLIP[1]!r}, {lin} + noise)) AS price,
          printf('images/house_%04d.jpg', house_id) AS img_path FROM g)
"""


def churn_frame(spark, sf):
    return generators.gen_churn(table(spark, sf, "customer").select(F.col("c_custkey").alias("id")))


def housing_frame(spark, sf):
    return generators.gen_housing(spread(table(spark, sf, "part").select(F.col("p_partkey").alias("id"))))


CHURN_COLS = ["customerID", "gender", "SeniorCitizen", "Partner", "Dependents", "tenure", "PhoneService",
              "MultipleLines", "InternetService", "OnlineSecurity", "TechSupport", "Contract",
              "PaperlessBilling", "PaymentMethod", "MonthlyCharges", "TotalCharges", "Churn"]


@register("gen_churn", f"SELECT * FROM {churn_sql()}")
def q_gen_churn(spark, sf):
    return churn_frame(spark, sf)


@register("gen_housing", f"""
  SELECT house_id, sqft, bedrooms, bathrooms, house_age, has_garage, location_score,
         ROUND(price, 2) AS price, img_path FROM {housing_sql()}
""")
def q_gen_housing(spark, sf):
    return housing_frame(spark, sf).withColumn("price", F.round("price", 2))


@register("scan_or_generate", f"SELECT * FROM {churn_sql()}")
def q_scan_or_generate(spark, sf):
    path = scratch_path(spark, f"absent-{uuid.uuid4().hex}.csv")
    df, _src = files.scan_or_generate(spark, path, lambda: churn_frame(spark, sf))
    return df


NATION_SCHEMA = "n_nationkey INT, n_name STRING, n_regionkey INT"


@register("scan_csv", "SELECT * FROM nation")
def q_scan_csv(spark, sf):
    """nation -> CSV in the shared scratch folder -> read back with its schema."""
    path = scratch_path(spark, f"nation-{uuid.uuid4().hex}")
    files.sink_csv(table(spark, sf, "nation"), path)
    return files.scan_csv(spark, path, NATION_SCHEMA)


@register("scan_landed", """
  SELECT event_id, ts, user_id, event_type, ROUND(value, 6) AS value FROM events
  WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY
""")
def q_scan_landed(spark, sf):
    df = files.scan_landed(spark, f"{sf.rstrip('/')}/events.parquet", "parquet", "ts", 7)
    return df.select("event_id", "ts", "user_id", "event_type", "value")


@register("flatten_columns", "SELECT event_id, ROUND(value, 6) AS value, user_id AS user_id_id, event_type AS user_id_type FROM events")
def q_flatten(spark, sf):
    e = table(spark, sf, "events")
    nested = e.select("event_id", F.struct(F.col("value").alias("AAPL")).alias("value"),
                      F.struct(F.col("user_id").alias("id"), F.col("event_type").alias("type")).alias("user_id"))
    return files.flatten_columns(nested)


@register("sink_csv", "SELECT ticket_id, strategy, hit_top3 FROM {RESULTS}")
def q_sink_csv(spark, sf):
    """Tag results (with an array column) -> CSV -> read back."""
    from .text_plans import tag_results
    r = tag_results(spark, sf).select("ticket_id", "strategy", "top3_tags", "hit_top3")
    path = scratch_path(spark, f"results-{uuid.uuid4().hex}")
    files.sink_csv(r, path)
    back = files.scan_csv(spark, path, "ticket_id STRING, strategy STRING, top3_tags STRING, hit_top3 BOOLEAN")
    return back.select("ticket_id", "strategy", "hit_top3")


def _fix_sink_sql():
    from .registry import REGISTRY
    from .text_plans import RESULTS_SQL
    fn, sql = REGISTRY["sink_csv"]
    REGISTRY["sink_csv"] = (fn, sql.replace("{RESULTS}", RESULTS_SQL))


_fix_sink_sql()
