"""Helpers shared by the operators of this subpackage.

Conventions that hold for every operator here:

* An operator selects the identifier and the columns it needs under internal
  names (``_id``, ``_text``, ...), so extra columns of any name never clash.
* A NULL text counts as an empty text.  Rows that repeat a ``doc_id`` are rows
  of their own: each one is scored or placed.
* Lineage that is costly to replay is cut by writing narrow rows as parquet to
  the shared folder in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stage_table

WORD_SPLIT = "[\\x20\\x09-\\x0D]+"      # the contract's word separators
SPACES = " \t\n\x0b\x0c\r"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Two columns, ``_id`` and ``_text`` (NULL text: empty)."""
    return docs.select(F.col(id_col).alias("_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("_text"))


def id_type(docs: DataFrame, id_col: str = "doc_id") -> str:
    return docs.schema[id_col].dataType.simpleString()


def words(text: Column) -> Column:
    """Array of maximal runs of non-space characters."""
    body = F.btrim(text, F.lit(SPACES))
    return F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, WORD_SPLIT))


def fold(id_col: Column, n: int) -> Column:
    """crc32 of the id written as text, modulo n (NULL id: 0)."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % n, F.lit(0))


def dense_index(df: DataFrame, keys: list[str], order: list[str], out: str,
                buckets: int = 4096) -> DataFrame:
    """0-based gapless index of the rows inside each value of ``keys``.

    Rows are cut into ``buckets`` parts per key by a hash of ``order``; counts
    per part give offsets, and a window numbers the rows inside a part only, so
    a key that holds most of the rows is spread over many tasks.
    """
    b = df.withColumn("_b", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    n = b.groupBy(*keys, "_b").agg(F.count("*").alias("_n"))
    from pyspark.sql import Window as W
    # at most `buckets` rows per key here, whatever the number of rows
    off = n.withColumn("_off", F.sum("_n").over(
        W.partitionBy(*keys).orderBy("_b").rowsBetween(W.unboundedPreceding, -1)))
    off = off.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
                     F.col("_b").alias("_ob"), F.coalesce("_off", F.lit(0)).alias("_off"))
    on = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    joined = b.join(off, on + [F.col("_b") == F.col("_ob")])
    w = W.partitionBy(*keys, "_b").orderBy(*order)
    return (joined.withColumn(out, F.col("_off") + F.row_number().over(w) - 1)
            .drop("_b", "_ob", "_off", *[f"_k{i}" for i in range(len(keys))]))


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared checkpoint folder, read back."""
    return stage_table(df, "llm-" + name)
