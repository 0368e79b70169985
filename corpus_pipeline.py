"""Corpus pipeline over ``documents``: toxicity, SimHash near-dedup, benchmark
decontamination, source mixing, sharding.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept.  A stage that filters returns the columns of ``documents`` unchanged.

Defined cases: a NULL or empty text is not toxic, shares fingerprint zero with
other wordless texts, matches no benchmark item, has size 0 in the mix (only
certain copies remain) and is placed like any other row.  Rows that repeat a
``doc_id``, or have none, are rows of their own; in the mix rows of one id share
its copies.  Very long texts are read whole by every stage.  Extra columns may
have any name.  An empty table stays empty.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakelens.llm import decontaminate, mixing, sharding, simhash, toxicity
from lakelens.llm.common import read_table
from lakelens.session import scratch_path, stage_table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows scored under 0.5; the model learns from ``labels`` and these texts."""
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    return docs.filter(toxicity.scorer(docs, model)(F.col("text")) < 0.5)


def _packed(docs: DataFrame) -> DataFrame:
    """Each row as one struct, so that no column of it can clash with ours."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"))


def _unpacked(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*[F.col("_doc").getField(c).alias(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: the one with the smallest
    doc_id (rows that share it or have none: the first as read)."""
    rows = stage_table(_packed(docs).withColumn("_row", F.monotonically_increasing_id()), "pipeline-rows")
    found = simhash.near_duplicates(rows.select("_row", F.col("_doc.text").alias("text")), "_row")
    named = found.join(rows.select("_row", F.col("_doc.doc_id").alias("_id")), "_row")
    first = named.groupBy("component_id").agg(
        F.min(F.struct(F.col("_id").isNull().alias("none"), "_id", "_row")).alias("_first"))
    keep = first.select(F.col("_first._row").alias("_row"))
    return _unpacked(rows.join(keep, "_row", "left_semi"), docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a window like a benchmark item."""
    return decontaminate.clean(docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows repeated as often as the mix takes them (0, 1 or 2 times)."""
    n = (mixing.mix(docs).groupBy(F.col("doc_id").alias("_id"))
         .agg(F.sum("copies").alias("_copies"), F.count("*").alias("_rows")).filter("_copies > 0"))
    both = _packed(docs).join(n, F.col("_doc.doc_id").eqNullSafe(F.col("_id")))
    # rows that repeat an id share its copies evenly (they rank side by side)
    times = F.ceil(F.col("_copies") / F.col("_rows")).cast("int")
    return _unpacked(both.withColumn("_time", F.explode(F.sequence(F.lit(1), times))), docs)


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each row goes: doc_id, size, text_crc32, law, shard, slot."""
    return sharding.shard_documents(docs).drop("grown_shard")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("source_mix", mix_sources),
    ("sharding", assign_shards),
]

# A trained model, XXH64 fingerprints and label propagation have no SQL form;
# tests/llm/test_pipeline.py holds the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as parquet and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}-{uuid.uuid4().hex}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
