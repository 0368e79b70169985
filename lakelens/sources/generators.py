"""Keyed synthetic generators: every column is a pure function of (key, column
name, seed) through md5, so output does not depend on partitioning, runs in
parallel, equals its DuckDB twin, and grows with the key frame it is given
(``spark.range(n)`` or the keys of a real table)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import rank_by_key


def uniform(key: Column, name: str, seed: int = 42) -> Column:
    """U[0, 1) from the first 32 bits of md5(key|name|seed)."""
    h = F.md5(F.concat_ws("|", key.cast("string"), F.lit(name), F.lit(str(seed))))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint").cast("double") / F.lit(4294967296.0)


def uniform_open(key: Column, name: str, seed: int = 42) -> Column:
    """U(0, 1): never 0, safe for log."""
    h = F.md5(F.concat_ws("|", key.cast("string"), F.lit(name), F.lit(str(seed))))
    return (F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint").cast("double") + 1.0) / F.lit(4294967297.0)


def choice(key: Column, name: str, values: list, probs: list[float] | None = None, seed: int = 42) -> Column:
    u = uniform(key, name, seed)
    if probs is None:
        return F.get(F.array(*[F.lit(v) for v in values]), F.floor(u * len(values)).cast("int"))
    expr, cum = None, 0.0
    for v, p in zip(values[:-1], probs[:-1]):
        cum += p
        expr = F.when(u < F.lit(cum), F.lit(v)) if expr is None else expr.when(u < F.lit(cum), F.lit(v))
    return expr.otherwise(F.lit(values[-1]))


def integers(key: Column, name: str, lo: int, hi: int, seed: int = 42) -> Column:
    """Integer in [lo, hi)."""
    return (F.lit(lo) + F.floor(uniform(key, name, seed) * (hi - lo))).cast("long")


def normal(key: Column, name: str, mu: float = 0.0, sd: float = 1.0, seed: int = 42) -> Column:
    """Box-Muller from two keyed uniforms."""
    u1 = uniform_open(key, name + ".1", seed)
    u2 = uniform(key, name + ".2", seed)
    return F.lit(mu) + F.lit(sd) * F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2 * math.pi) * u2)


# Churn table categories and weights.
YES_NO = ["Yes", "No"]
CHURN_CATEGORIES = {
    "gender": (["Male", "Female"], None),
    "Partner": (YES_NO, None),
    "Dependents": (YES_NO, None),
    "PhoneService": (YES_NO, None),
    "MultipleLines": (["Yes", "No", "No phone service"], None),
    "InternetService": (["DSL", "Fiber optic", "No"], None),
    "OnlineSecurity": (["Yes", "No", "No internet service"], None),
    "TechSupport": (["Yes", "No", "No internet service"], None),
    "Contract": (["Month-to-month", "One year", "Two year"], [0.55, 0.25, 0.20]),
    "PaperlessBilling": (YES_NO, None),
    "PaymentMethod": (["Electronic check", "Mailed check", "Bank transfer", "Credit card"], None),
    "Churn": (YES_NO, [0.27, 0.73]),
}
CHURN_NULLS = 11


def gen_churn(keys: DataFrame, key: str = "id", seed: int = 42, n_nulls: int = CHURN_NULLS) -> DataFrame:
    """Telco-style churn rows, one per key: 17 columns, weighted categories,
    TotalCharges = round(tenure * MonthlyCharges, 2) with exactly ``n_nulls``
    NULLs (the smallest md5 keys).  Labels are independent of the features."""
    k = F.col(key)
    cols = [F.format_string("CUST-%05d", k).alias("customerID")]
    for name, (vals, probs) in CHURN_CATEGORIES.items():
        if name in ("Churn",):
            continue
        cols.append(choice(k, name, vals, probs, seed).alias(name))
    cols.append(integers(k, "SeniorCitizen", 0, 2, seed).cast("int").alias("SeniorCitizen"))
    cols.append(integers(k, "tenure", 0, 72, seed).cast("double").alias("tenure"))
    cols.append(F.round(F.lit(18.0) + uniform(k, "MonthlyCharges", seed) * 100.0, 2).alias("MonthlyCharges"))
    cols.append(choice(k, "Churn", *CHURN_CATEGORIES["Churn"], seed=seed).alias("Churn"))
    df = keys.select(k.alias("__id"), *cols)
    df = df.withColumn("TotalCharges", F.round(F.col("tenure") * F.col("MonthlyCharges"), 2))
    r = rank_by_key(df.withColumn("__k", F.md5(F.concat_ws("|", F.col("__id").cast("string"), F.lit("null"),
                                                           F.lit(str(seed))))), "__k", rank_col="__r")
    r = r.withColumn("TotalCharges", F.when(F.col("__r") <= n_nulls, F.lit(None).cast("double"))
                     .otherwise(F.col("TotalCharges")))
    order = ["customerID", "gender", "SeniorCitizen", "Partner", "Dependents", "tenure", "PhoneService",
             "MultipleLines", "InternetService", "OnlineSecurity", "TechSupport", "Contract",
             "PaperlessBilling", "PaymentMethod", "MonthlyCharges", "TotalCharges", "Churn"]
    return r.select(*order)


# Housing price model (coefficients, noise, clip bounds).
HOUSE_COEFS = {"sqft": 110.0, "bedrooms": 8000.0, "bathrooms": 12000.0, "house_age": -1500.0,
               "has_garage": 20000.0, "location_score": 15000.0}
HOUSE_NOISE_SD = 25000.0
HOUSE_CLIP = (50000.0, 2_000_000.0)


def gen_housing(keys: DataFrame, key: str = "id", seed: int = 42) -> DataFrame:
    """Houses, one per key: six features, linear price + normal noise clipped
    to [50000, 2e6], and an image path named after the key."""
    k = F.col(key)
    df = keys.select(
        k.alias("house_id"),
        integers(k, "sqft", 600, 4500, seed).cast("double").alias("sqft"),
        integers(k, "bedrooms", 1, 6, seed).cast("double").alias("bedrooms"),
        F.round(F.lit(1.0) + uniform(k, "bathrooms", seed) * 3.0, 1).alias("bathrooms"),
        integers(k, "house_age", 0, 60, seed).cast("double").alias("house_age"),
        integers(k, "has_garage", 0, 2, seed).cast("double").alias("has_garage"),
        F.round(F.lit(1.0) + uniform(k, "location_score", seed) * 9.0, 1).alias("location_score"),
        normal(k, "noise", 0.0, HOUSE_NOISE_SD, seed).alias("__noise"))
    lin = None
    for c, w in HOUSE_COEFS.items():
        t = F.col(c) * F.lit(w)
        lin = t if lin is None else lin + t
    price = F.greatest(F.lit(HOUSE_CLIP[0]), F.least(F.lit(HOUSE_CLIP[1]), lin + F.col("__noise")))
    return df.withColumn("price", price).withColumn(
        "img_path", F.format_string("images/house_%04d.jpg", F.col("house_id"))).drop("__noise")


def house_tiles(houses: DataFrame, size: int = 16, price: str = "price", path: str = "img_path") -> DataFrame:
    """One plain-colour image per house, in the image source's struct layout
    (origin, height, width, nChannels, mode, data as BGR bytes).

    Colour encodes the price tier as in the reference's generated photos:
    t = (price - min) / (range + 1e-9); red = floor(200 t + 30),
    green = floor(180 (1 - 2 |t - 0.5|) + 50), blue = floor(200 (1 - t) + 30).
    The min/max are scalar subqueries (Catalyst merges them into one partial
    aggregate), and the bytes are built by ``unhex(repeat(...))``, so nothing
    leaves the JVM and no join is planned.
    Drawing the house outline and pixel noise is not built.
    """
    lo = houses.select(F.min(price)).scalar()
    hi = houses.select(F.max(price)).scalar()
    t = (F.col(price) - lo) / (hi - lo + F.lit(1e-9))
    r = F.floor(t * 200 + 30).cast("int")
    g = F.floor((F.lit(1.0) - F.abs(t - 0.5) * 2) * 180 + 50).cast("int")
    b = F.floor((F.lit(1.0) - t) * 200 + 30).cast("int")
    pixel = F.format_string("%02X%02X%02X", b, g, r)
    image = F.struct(
        F.concat(F.lit("file:/"), F.col(path)).alias("origin"),
        F.lit(size).alias("height"), F.lit(size).alias("width"), F.lit(3).alias("nChannels"),
        F.lit(16).alias("mode"),  # CV_8UC3
        F.unhex(F.repeat(pixel, size * size)).alias("data"))
    return houses.select(F.col("house_id"), image.alias("image"))
