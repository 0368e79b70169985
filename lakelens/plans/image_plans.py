"""§2.1/2.5/2.11 image work on tiles Spark builds from the housing rows
(part -> gen_housing -> one plain-colour tile per house, price tier as colour).
"""

from pyspark.sql import functions as F

from ..operators import features as fx
from ..session import stage_table
from ..sources import files, generators
from .registry import register
from .source_plans import housing_frame, housing_sql

TILE = 16
BINS = 4


def tiles(spark, sf):
    houses = stage_table(housing_frame(spark, sf).select(
        "house_id", "img_path", F.round("price", 2).alias("price")), "houses")
    return generators.house_tiles(houses, TILE)


# Twin of house_tiles + image_color_features: a plain tile has one colour, so
# each channel's mean is that value / 255, its std is 0, and its histogram puts
# all mass in bucket floor(v / 64).
TILE_SQL = f"""
  (WITH h AS (SELECT house_id, round(price, 2) AS price, img_path FROM {housing_sql()}),
        t AS (SELECT house_id, img_path,
                     (price - (SELECT min(price) FROM h)) /
                     ((SELECT max(price) FROM h) - (SELECT min(price) FROM h) + 1e-9) AS t FROM h)
   SELECT house_id, img_path,
          CAST(floor((1.0 - t) * 200 + 30) AS INTEGER) AS b,
          CAST(floor((1.0 - abs(t - 0.5) * 2) * 180 + 50) AS INTEGER) AS g,
          CAST(floor(t * 200 + 30) AS INTEGER) AS r FROM t)
"""


def _feature_sql(prefix=""):
    cols = [f"ROUND({prefix}{c} / 255.0, 6) AS mean_{c}" for c in "bgr"]
    cols += [f"0.0 AS std_{c}" for c in "bgr"]
    cols += [f"CASE WHEN floor({prefix}{c} / 64) = {i} THEN 1.0 ELSE 0.0 END AS hist_{c}_{i}"
             for c in "bgr" for i in range(BINS)]
    return ", ".join(cols)


@register("image_color_features", f"SELECT house_id, {_feature_sql()} FROM {TILE_SQL}")
def q_image_color_features(spark, sf):
    f = fx.image_color_features(tiles(spark, sf), bins=BINS)
    return f.drop("image")


@register("image_normalize")
def q_image_normalize(spark, sf):
    """Block-mean resize to 8 x 8, to [0, 1], then (x - 0.5) / 0.5 (RGB, flat)."""
    out = fx.image_normalize(tiles(spark, sf), size=8)
    return out.select("house_id", F.size("pixels").alias("n_values"),
                      F.array_min("pixels").alias("lo"), F.array_max("pixels").alias("hi"),
                      F.col("pixels")[0].alias("r0"), F.col("pixels")[1].alias("g0"),
                      F.col("pixels")[2].alias("b0"))


@register("join_image_features", f"""
  SELECT house_id, ROUND(price, 2) AS price, lower(regexp_extract(img_path, '([^/\\\\]+)$', 1)) AS file,
         {_feature_sql()}
  FROM {TILE_SQL} JOIN (SELECT house_id AS hid, price FROM {housing_sql()}) p ON p.hid = house_id
""")
def q_join_image_features(spark, sf):
    """Rows -> their image by normalised file name (an equi-join; both sides
    grow with the data, so a sort-merge / AQE-chosen join, no broadcast)."""
    houses = housing_frame(spark, sf).select(
        "house_id", F.round("price", 2).alias("price"), files.file_name("img_path").alias("file"))
    feats = fx.image_color_features(tiles(spark, sf), bins=BINS).select(
        files.file_name(F.col("image.origin")).alias("file"), *fx.IMAGE_FEATURES,
        *[f"hist_{c}_{i}" for c in "bgr" for i in range(BINS)])
    joined, _missing = files.join_images(houses, feats, "file")
    return joined
