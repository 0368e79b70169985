"""File sources and sinks (CSV, landed parquet/csv/json, images, Spark ML models)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def path_exists(spark: SparkSession, path: str) -> bool:
    """Hadoop FileSystem check on the driver (works for any cluster filesystem)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def scan_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             header: bool = True) -> DataFrame:
    """Headered CSV; blank lines are skipped by the reader.  Give a schema in
    production: inference costs a pass over the data."""
    r = spark.read.option("header", str(header).lower()).option("mode", "PERMISSIVE")
    if schema is not None:
        return r.schema(schema).csv(path)
    return r.option("inferSchema", "true").csv(path)


def scan_or_generate(spark: SparkSession, path: str, fallback, schema=None) -> tuple[DataFrame, str]:
    """The file if it exists, else ``fallback()`` (a generator); says which one."""
    if path_exists(spark, path):
        return scan_csv(spark, path, schema), "file"
    return fallback(), "generated"


def scan_landed(spark: SparkSession, path: str, fmt: str = "parquet", ts_col: str | None = None,
                period_days: int | None = None, schema=None) -> DataFrame:
    """A landed copy of a named dataset; optionally only the last ``period_days``
    before its newest timestamp.  The cut is a literal, so it reaches the scan
    as a pushed filter."""
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    if fmt == "csv":
        r = r.option("header", "true")
    df = r.load(path)
    if ts_col and period_days:
        mx = df.agg(F.max(ts_col)).first()[0]
        if mx is not None:
            df = df.where(F.col(ts_col) >= F.lit(mx) - F.expr(f"INTERVAL {int(period_days)} DAYS"))
    return df


def flatten_columns(df: DataFrame, sep: str = "_") -> DataFrame:
    """Drop the outer level of two-level names: a struct with one field becomes
    a column named after the struct; wider structs become outer_inner columns."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StructType):
            inner = f.dataType.fields
            if len(inner) == 1:
                cols.append(F.col(f"`{f.name}`.`{inner[0].name}`").alias(f.name))
            else:
                cols += [F.col(f"`{f.name}`.`{i.name}`").alias(f"{f.name}{sep}{i.name}") for i in inner]
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def literal_rows(spark: SparkSession, rows: list, schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def sink_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header; array/struct/map columns are written as JSON text
    (Spark's CSV writer rejects them)."""
    out = df.select(*[F.to_json(F.col(f.name)).alias(f.name)
                      if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)) else F.col(f.name)
                      for f in df.schema.fields])
    out.write.mode(mode).option("header", "true").csv(path)


def scan_images(spark: SparkSession, path: str, drop_invalid: bool = True) -> DataFrame:
    """Image source: struct(origin, height, width, nChannels, mode, data); data is BGR."""
    return spark.read.format("image").option("dropInvalid", str(drop_invalid).lower()).load(path)


def file_name(c) -> "F.Column":
    """Normalised file name of a path or URI (join key between rows and images)."""
    return F.lower(F.regexp_extract(c, r"([^/\\]+)$", 1))


def join_images(rows: DataFrame, images: DataFrame, key: str = "file") -> tuple[DataFrame, DataFrame]:
    """Rows joined to their image on a normalised file name, plus the
    ``left_anti`` report of rows whose image is missing (the reference raises
    on the first one; here the caller decides)."""
    return rows.join(images, key, "inner"), rows.join(images.select(key), key, "left_anti")


def sink_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def source_model(path: str):
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)
