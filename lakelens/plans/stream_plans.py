"""§2.15 streaming queries: each runs an availableNow stream over a driver
table into the shared scratch folder and returns what it wrote, so the result
can be checked against the batch form (and its SQL twin)."""

import uuid

from pyspark.sql import functions as F

from ..session import scratch_path
from ..operators.text import HEALTH_RULES
from ..streaming import chat as sc
from ..streaming import turns
from .registry import REGISTRY, register


def _read(spark, sf, name, schema):
    """The table as a stream, whether it is one file or a folder of part files."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf.rstrip('/')}/{name}.parquet")
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).isDirectory():
        return sc.read_stream(spark, f"{sf.rstrip('/')}/{name}.parquet", schema)
    return sc.read_stream(spark, sf.rstrip("/"), schema, file_glob=f"{name}.parquet")


@register("stream_safety_route")
def q_stream_safety_route(spark, sf):
    s = _read(spark, sf, "conversations", sc.CONV_SCHEMA).where(F.col("role") == "user")
    routed = sc.stream_safety_route(s).select("conv_id", "turn", "category", "canned_reply")
    base = scratch_path(spark, f"stream-route-{uuid.uuid4().hex}")
    sc.run_available(routed, base + "/out", base + "/ckpt")
    return spark.read.schema("conv_id long, turn long, category string, canned_reply string").parquet(base + "/out")


def _chat_state(spark, sf, rules, turns_of=lambda s: s):
    """The table carries no arrival times, so all turns arrive at one instant; a
    closing row far in the future then ends the waits and idle sessions."""
    base = scratch_path(spark, f"stream-chat-{uuid.uuid4().hex}")
    schema = sc.CONV_SCHEMA + ", ts timestamp"
    spark.sql("SELECT CAST(NULL AS LONG) AS conv_id, CAST(NULL AS LONG) AS turn, CAST(NULL AS STRING) AS role, "
              "CAST(NULL AS STRING) AS text, TIMESTAMP '2999-01-01' AS ts").write.parquet(base + "/end")
    s = turns_of(_read(spark, sf, "conversations", sc.CONV_SCHEMA)).withColumn("ts", F.lit("2000-01-01").cast("timestamp"))
    s = s.unionByName(sc.read_stream(spark, base + "/end", schema))
    s = s.withWatermark("ts", "1 minute").where("ts < TIMESTAMP '2900-01-01'")
    with turns.rocksdb_state(spark):
        sc.run_available(turns.stream_chat_turns(s, None, rules), base + "/out", base + "/ckpt")
    return spark.read.schema(sc.OUT_SCHEMA).parquet(base + "/out")


@register("stream_chat_state")
def q_stream_chat_state(spark, sf):
    from .text_plans import FIXTURE_RULES
    return _chat_state(spark, sf, FIXTURE_RULES)


@register("stream_safety_route_derived")
def q_stream_safety_route_derived(spark, sf):
    from .text_plans import derived_turns
    s = derived_turns(_read(spark, sf, "conversations", sc.CONV_SCHEMA)).where(F.col("role") == "user")
    routed = sc.stream_safety_route(s).select("conv_id", "turn", "category", "canned_reply")
    base = scratch_path(spark, f"stream-route-{uuid.uuid4().hex}")
    sc.run_available(routed, base + "/out", base + "/ckpt")
    return spark.read.schema("conv_id long, turn long, category string, canned_reply string").parquet(base + "/out")


@register("stream_chat_state_derived")
def q_stream_chat_state_derived(spark, sf):
    """Commands, alarming words, empty turns and missing replies occur."""
    from .text_plans import derived_turns
    return _chat_state(spark, sf, HEALTH_RULES, derived_turns)


@register("stream_score")
def q_stream_score(spark, sf):
    """Fit a language classifier on documents (batch), save it, load it, and
    score the documents table as a stream."""
    from pyspark.ml import Pipeline, PipelineModel
    from ..operators import features as fx
    from ..operators import models
    from .model_plans import _docs
    train, _ = _docs(spark, sf)
    m = Pipeline(stages=fx.text_tfidf_stages("text", "features", 1 << 18, hashing=False) + [models.text_classifier(4)]).fit(train)
    base = scratch_path(spark, f"stream-score-{uuid.uuid4().hex}")
    m.write().overwrite().save(base + "/model")
    loaded = PipelineModel.load(base + "/model")
    s = _read(spark, sf, "documents", "doc_id long, text string, lang string, source string, n_chars long")
    scored = sc.stream_score(s, loaded).select("doc_id", "lang", F.col("prediction").cast("int").alias("prediction"))
    sc.run_available(scored, base + "/out", base + "/ckpt")
    return spark.read.schema("doc_id long, lang string, prediction int").parquet(base + "/out")


def _share_sql():
    from .text_plans import _history_sql, route_sql
    c, r = route_sql("text", HEALTH_RULES)
    fn, _ = REGISTRY["stream_safety_route"]
    REGISTRY["stream_safety_route"] = (fn, f"SELECT conv_id, turn, {c} AS category, {r} AS canned_reply "
                                           f"FROM conversations WHERE role = 'user'")
    fn, _ = REGISTRY["stream_chat_state"]
    REGISTRY["stream_chat_state"] = (fn, _history_sql(None))
    fn, _ = REGISTRY["stream_safety_route_derived"]
    REGISTRY["stream_safety_route_derived"] = (fn, REGISTRY["safety_route_derived"][1])
    fn, _ = REGISTRY["stream_chat_state_derived"]
    REGISTRY["stream_chat_state_derived"] = (fn, REGISTRY["conversation_history_derived"][1])


_share_sql()
