"""§2.14 text, JSON and prompt work: keyword routing, prompts, reply parsing,
tag results, dialogue pairs, token ids, nearest vectors.

Everything is a Catalyst expression over columns; only the MMR re-rank (a
greedy loop over at most ``fetch_k`` rows per query) runs in pandas.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .vectors import QUERY_ROWS, pivot_top_k

# ------------------------------------------------------------------ fixed values
# Safety keyword lists in priority order (emergency, self-harm,
# prescription, diagnosis), matched as lower-case substrings.
EMERGENCY_KEYWORDS = [
    "chest pain", "heart attack", "can't breathe", "cannot breathe",
    "stroke", "unconscious", "not breathing", "overdose", "poisoning",
    "severe bleeding", "choking", "seizure", "fainted", "collapsed",
]
SELF_HARM_KEYWORDS = [
    "kill myself", "suicide", "end my life", "self harm", "self-harm",
    "hurt myself", "want to die", "no reason to live",
]
PRESCRIPTION_KEYWORDS = [
    "prescribe me", "give me a prescription", "write me a prescription",
    "what dose should i take", "can you prescribe",
]
DIAGNOSIS_KEYWORDS = [
    "diagnose me", "do i have", "am i sick with", "tell me if i have",
]
# The canned reply of each category.
EMERGENCY_REPLY = (
    "🚨 This sounds like a medical emergency!\n\n"
    "Please do NOT wait for a chatbot response.\n"
    "➡  Call emergency services immediately: **1122** (Pakistan)\n"
    "➡  Or go to the nearest Emergency Room (ER) right away.\n\n"
    "Your safety comes first. Please get help now."
)
SELF_HARM_REPLY = (
    "💙 I hear you, and I'm really glad you reached out.\n\n"
    "What you're feeling matters, and you deserve support from "
    "someone trained to help.\n\n"
    "Please contact a mental health helpline right now:\n"
    "➡  Umang Pakistan: **0317-4288665** (24/7)\n"
    "➡  Rozan Counseling: **051-2890505**\n\n"
    "You are not alone. 💙"
)
PRESCRIPTION_REPLY = (
    "⚠️  I'm not able to prescribe medications — only a licensed "
    "doctor can do that.\n\n"
    "I can share general information about how medications work, "
    "but for any prescription, please visit a qualified physician or pharmacist."
)
DIAGNOSIS_REPLY = (
    "⚠️  I'm not able to diagnose medical conditions — only a "
    "qualified doctor can do that after a proper examination.\n\n"
    "I can explain what certain symptoms might generally be "
    "associated with, but for an actual diagnosis, please consult a doctor."
)
# The single crisis list and reply of the dialogue bot.
CRISIS_WORDS = ["suicide", "kill myself", "hopeless", "depressed"]
CRISIS_REPLY = ("I'm really sorry you're feeling this way. Please consider reaching out to a "
                "trusted person or a mental health professional.")
# Disclaimer appended to every model reply.
DISCLAIMER = "💡 Remember: Always consult a doctor for personal medical advice."

# (category, priority, keywords, reply)
HEALTH_RULES = [
    ("emergency", 1, EMERGENCY_KEYWORDS, EMERGENCY_REPLY),
    ("self_harm", 2, SELF_HARM_KEYWORDS, SELF_HARM_REPLY),
    ("prescription", 3, PRESCRIPTION_KEYWORDS, PRESCRIPTION_REPLY),
    ("diagnosis", 4, DIAGNOSIS_KEYWORDS, DIAGNOSIS_REPLY),
]
CRISIS_RULES = [("crisis", 1, CRISIS_WORDS, CRISIS_REPLY)]

# Ticket tag schema, in order.
TAG_SCHEMA = [
    "Billing & Payments",
    "Account & Login",
    "Technical Bug",
    "Feature Request",
    "Shipping & Delivery",
    "Refund & Returns",
    "Product Quality",
    "Security & Privacy",
    "Performance",
    "General Inquiry",
]
FALLBACK_TAG = "General Inquiry"
FALLBACK_CONF = 0.5
FALLBACK_REASON = "Parse error"

# The three prompt templates.  <<TAGS>> is the tag list (one
# "  - tag" line each), <<TICKET>> the ticket text.
ZERO_SHOT_TEMPLATE = '''You are a customer support ticket classifier.

Classify the following support ticket into the TOP 3 most relevant categories from this list:
<<TAGS>>

Return ONLY a JSON object with this exact format:
{"tags": [{"tag": "<category>", "confidence": <0.0-1.0>, "reason": "<brief reason>"}]}

Return exactly 3 tags ordered by confidence (highest first). No other text.

Support ticket:
"""<<TICKET>>"""'''

FEW_SHOT_TEMPLATE = '''You are a customer support ticket classifier.

Classify support tickets into the TOP 3 most relevant categories from this list:
<<TAGS>>

=== EXAMPLES ===

Ticket: "I was charged twice this month and need a refund for the duplicate charge."
Output: {"tags": [
  {"tag": "Billing & Payments", "confidence": 0.92, "reason": "Duplicate charge issue"},
  {"tag": "Refund & Returns",   "confidence": 0.78, "reason": "Refund requested"},
  {"tag": "Account & Login",    "confidence": 0.15, "reason": "May relate to account"}
]}

Ticket: "The app freezes when I try to open settings on my Android phone."
Output: {"tags": [
  {"tag": "Technical Bug",   "confidence": 0.95, "reason": "App freeze on specific action"},
  {"tag": "Performance",     "confidence": 0.60, "reason": "Freezing suggests performance issue"},
  {"tag": "General Inquiry", "confidence": 0.10, "reason": "Low relevance fallback"}
]}

Ticket: "My package shows delivered but I haven't received anything. Can I get a replacement or refund?"
Output: {"tags": [
  {"tag": "Shipping & Delivery", "confidence": 0.91, "reason": "Package delivery failure"},
  {"tag": "Refund & Returns",    "confidence": 0.75, "reason": "Refund/replacement requested"},
  {"tag": "Billing & Payments",  "confidence": 0.20, "reason": "Financial resolution implied"}
]}

=== NOW CLASSIFY THIS TICKET ===

Ticket: "<<TICKET>>"
Output:'''

COT_TEMPLATE = '''You are an expert customer support analyst.

Available categories:
<<TAGS>>

Step-by-step, analyse this support ticket and identify the top 3 tags:

1. Read the ticket carefully and identify the core problem
2. Consider which categories are PRIMARY matches
3. Consider which categories are SECONDARY/related matches
4. Assign confidence scores based on relevance

Return your analysis as a JSON object:
{"reasoning": "<2-3 sentence analysis>",
  "tags": [
    {"tag": "<category>", "confidence": <0.0-1.0>, "reason": "<specific reason>"},
    {"tag": "<category>", "confidence": <0.0-1.0>, "reason": "<specific reason>"},
    {"tag": "<category>", "confidence": <0.0-1.0>, "reason": "<specific reason>"}
  ]
}

Support Ticket: "<<TICKET>>"

Return ONLY the JSON. No other text.'''

STRATEGIES = {"zero_shot": ZERO_SHOT_TEMPLATE, "few_shot": FEW_SHOT_TEMPLATE,
              "chain_of_thought": COT_TEMPLATE}

REPLY_SCHEMA = T.StructType([
    T.StructField("tags", T.ArrayType(T.StructType([
        T.StructField("tag", T.StringType()),
        T.StructField("confidence", T.StringType()),
        T.StructField("reason", T.StringType())]))),
    T.StructField("reasoning", T.StringType()),
    T.StructField("_corrupt", T.StringType()),
])



# Fixed value: the ASCII whitespace set of Python's str.strip() (as in \s).
WS_CHARS = " \t\n\r\x0b\x0c"


def py_strip(c: Column) -> Column:
    """Python's str.strip() on ASCII whitespace (Spark's trim is spaces only):
    ``btrim`` with the whitespace set, no regex."""
    return F.btrim(c, F.lit(WS_CHARS))


# ------------------------------------------------------------------ routing
def keyword_hit(text: Column, keywords: list[str]) -> Column:
    low = F.lower(text)
    hit = None
    for k in keywords:
        e = low.contains(F.lit(k.lower()))
        hit = e if hit is None else (hit | e)
    return F.coalesce(hit, F.lit(False)) if hit is not None else F.lit(False)


def route_expr(text: Column, rules=HEALTH_RULES) -> tuple[Column, Column]:
    """(category, reply): first category by priority with a substring hit; else 'pass'."""
    cat, rep = None, None
    for name, _, words, reply in sorted(rules, key=lambda r: r[1]):
        h = keyword_hit(text, words)
        cat = F.when(h, F.lit(name)) if cat is None else cat.when(h, F.lit(name))
        rep = F.when(h, F.lit(reply)) if rep is None else rep.when(h, F.lit(reply))
    return cat.otherwise(F.lit("pass")), rep.otherwise(F.lit(None).cast("string"))


def safety_route(df: DataFrame, text: str = "text", rules=HEALTH_RULES) -> DataFrame:
    cat, rep = route_expr(F.col(text), rules)
    return df.withColumns({"category": cat, "canned_reply": rep})


def crisis_flag(df: DataFrame, text: str = "text") -> DataFrame:
    return safety_route(df, text, CRISIS_RULES)


def route_summary(routed: DataFrame) -> DataFrame:
    return routed.groupBy("category").agg(F.count(F.lit(1)).alias("n"))


def ensure_disclaimer(c: Column, disclaimer: str = DISCLAIMER) -> Column:
    """Append the disclaimer unless it is already there (case-insensitive)."""
    return F.when(F.lower(c).contains(F.lit(disclaimer.lower())), c) \
            .otherwise(F.concat(c, F.lit("\n\n" + disclaimer)))


# ------------------------------------------------------------------ prompts
def tags_block(tags: list[str] = TAG_SCHEMA) -> str:
    return "\n".join(f"  - {t}" for t in tags)


def render_prompt(ticket: Column, template: str, tags: list[str] = TAG_SCHEMA) -> Column:
    """Template with the tag list filled in and the ticket column spliced in."""
    filled = template.replace("<<TAGS>>", tags_block(tags))
    pre, _, post = filled.partition("<<TICKET>>")
    return F.concat(F.lit(pre), ticket, F.lit(post))


def cross_strategies(tickets: DataFrame, ticket_col: str = "ticket",
                     strategies: dict[str, str] = STRATEGIES) -> DataFrame:
    """Every ticket x every strategy with its prompt.  The strategy list is a
    handful of literals exploded per row (no join); the prompt is one CASE."""
    st = F.array(*[F.struct(F.lit(n).alias("strategy"), F.lit(i).alias("strategy_pos"))
                   for i, n in enumerate(strategies)])
    j = tickets.select("*", F.explode(st).alias("__s")).select("*", "__s.*").drop("__s")
    prompt = None
    for n, tpl in strategies.items():
        e = render_prompt(F.col(ticket_col), tpl)
        prompt = F.when(F.col("strategy") == n, e) if prompt is None else prompt.when(F.col("strategy") == n, e)
    return j.withColumn("prompt", prompt)


# ------------------------------------------------------------------ replies
def _reply_body_cols(df: DataFrame, reply: str, out: str) -> DataFrame:
    """Strip, drop a ``` fence and its 'json' marker, strip again: a chain of
    projections, so that every regex runs once per row."""
    d = df.withColumn("__raw", py_strip(F.col(reply)))
    raw = F.col("__raw")
    d = d.withColumn("__unf", F.when(raw.startswith("```"), F.coalesce(F.get(F.split(raw, "```"), 1), F.lit("")))
                     .otherwise(raw))
    unf = F.col("__unf")
    d = d.withColumn(out, py_strip(F.when(unf.startswith("json"), F.substring(unf, 5, 1 << 30)).otherwise(unf)))
    return d.drop("__raw", "__unf")


def parse_reply(df: DataFrame, reply: str = "reply") -> DataFrame:
    """Adds ``tags`` (array<struct<tag, confidence double, reason>>) and ``parse_status``.

    status 'ok' (object with a tags list), 'no_tags' (object without tags ->
    empty list) or 'fallback' (not strict JSON, not an object, null reply ->
    three times (General Inquiry, 0.5, 'Parse error')).  Spark's JSON reader is
    lenient about text after the object, so the body must also parse as the only
    element of an array.
    """
    d = _reply_body_cols(df, reply, "__b")
    # a body without the outer braces is a fallback whatever the reader makes of it
    braces = F.col("__b").startswith("{") & F.col("__b").endswith("}")
    parsed = F.from_json(F.col("__b"), REPLY_SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt",
                                                      "allowSingleQuotes": "false"})
    d = d.withColumn("__p", F.when(braces, parsed))
    # one JSON value and nothing after it: as the only element of an array
    alone = F.size(F.from_json(F.concat(F.lit("["), F.col("__b"), F.lit("]")), "array<string>",
                               {"allowSingleQuotes": "false"})) == 1
    strict = braces & F.coalesce(alone, F.lit(False))
    ok_obj = F.col("__p").isNotNull() & F.col("__p._corrupt").isNull() & strict
    tags = F.transform(F.col("__p.tags"), lambda t: F.struct(
        t["tag"].alias("tag"), t["confidence"].try_cast("double").alias("confidence"), t["reason"].alias("reason")))
    fb = F.array_repeat(F.struct(F.lit(FALLBACK_TAG).alias("tag"), F.lit(FALLBACK_CONF).alias("confidence"),
                                 F.lit(FALLBACK_REASON).alias("reason")), 3)
    empty = F.filter(fb, lambda x: F.lit(False))
    status = F.when(~ok_obj | F.col(reply).isNull(), "fallback") \
              .when(F.col("__p.tags").isNull(), "no_tags").otherwise("ok")
    d = d.withColumn("parse_status", status)
    st = F.col("parse_status")
    out = F.when(st == "fallback", fb).when(st == "no_tags", empty).otherwise(tags)
    return d.withColumn("tags", out).drop("__p", "__b")


def tag_result(parsed: DataFrame, true_tag: str = "true_tag") -> DataFrame:
    """top-1 tag and confidence ('Unknown'/0 when empty), top-3 list, hit flag."""
    t3 = F.slice(F.col("tags"), 1, 3)
    first = F.get(t3, 0)
    top3 = F.transform(t3, lambda x: x["tag"])
    return parsed.withColumns({
        "top1_tag": F.coalesce(first["tag"], F.lit("Unknown")),
        "top1_conf": F.coalesce(first["confidence"], F.lit(0.0)),
        "top3_tags": top3,
        "hit_top3": F.array_contains(top3, F.col(true_tag)),
    })


def sample_predictions(results: DataFrame, n: int = 5, order: list[str] = ("ticket_id",)) -> DataFrame:
    return results.orderBy(*order).limit(n).select(
        *order, "true_tag", F.array_join("top3_tags", ", ").alias("predicted"),
        F.when(F.col("hit_top3"), "✓").otherwise("✗").alias("hit"))


# ------------------------------------------------------------------ dialogue
def dialogue_pairs(conv: DataFrame) -> DataFrame:
    """User turn t + assistant turn t+1 -> 'User: {prompt} \\nBot: {utterance}'.

    An equi-join on (conv_id, turn + 1): no window over the conversation."""
    u = conv.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("prompt"))
    a = conv.where(F.col("role") == "assistant").select("conv_id", (F.col("turn") - 1).alias("turn"),
                                                        F.col("text").alias("utterance"))
    j = u.join(a, ["conv_id", "turn"])
    return j.withColumn("text", F.concat(F.lit("User: "), F.col("prompt"), F.lit(" \nBot: "), F.col("utterance")))


def extract_reply(c: Column) -> Column:
    """Text after the last 'Bot:', stripped."""
    return py_strip(F.element_at(F.split(c, "Bot:"), -1))


def text_truncate(c: Column, n: int = 80) -> Column:
    return F.substring(c, 1, n)


# ------------------------------------------------------------------ tokens
TOKEN_PATTERN = "[a-z]+"
PAD_ID, UNK_ID = 0, 1


def tokens(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit(f"({TOKEN_PATTERN})"), 1)


def token_vocab(docs: DataFrame, text: str = "text") -> DataFrame:
    """Token -> id ranked by (count desc, md5 of token); ids start after PAD/UNK.

    Counts are a partial-aggregated group-by; ranking over distinct tokens uses
    the bucketed global rank (no single-task sort)."""
    from ..functions.keys import rank_by_value
    from ..session import stage_table
    cnt = docs.select(F.explode(tokens(F.col(text))).alias("token")).groupBy("token") \
              .agg(F.count(F.lit(1)).alias("count"))
    cnt = stage_table(cnt, "token-counts")   # ranking reads it 4 times; tokenise once
    r = rank_by_value(cnt.withColumn("__k", F.md5("token")), "count", "__k", "rank", descending=True)
    return r.select("token", "count", (F.col("rank") + 1).alias("id")).drop("__k")


def token_encode(docs: DataFrame, vocab: DataFrame, id_col: str = "doc_id", text: str = "text",
                 max_len: int = 128) -> DataFrame:
    """ids cut/padded to ``max_len`` and the attention mask, per document.

    The whole text is tokenised; the token array is cut to its first
    ``max_len`` entries before it is exploded (as truncation does), and those
    are looked up in the vocabulary (a hash join; AQE broadcasts it when it is
    small and splits a skewed token partition otherwise)."""
    toks = docs.select(id_col, F.posexplode(F.slice(tokens(F.col(text)), 1, max_len)).alias("pos", "token"))
    j = toks.join(vocab.select("token", "id"), "token", "left") \
            .withColumn("id", F.coalesce(F.col("id"), F.lit(UNK_ID)).cast("int"))
    g = j.groupBy(id_col).agg(F.sort_array(F.collect_list(F.struct("pos", "id"))).alias("__s"))
    ids = F.transform(F.col("__s"), lambda s: s["id"])
    n = F.size(ids)
    out = docs.select(id_col).join(g, id_col, "left")
    ids_c = F.coalesce(ids, F.array().cast("array<int>"))
    n_c = F.size(ids_c)
    return out.select(
        id_col,
        F.concat(ids_c, F.array_repeat(F.lit(PAD_ID), F.lit(max_len) - n_c)).alias("input_ids"),
        F.concat(F.array_repeat(F.lit(1), n_c), F.array_repeat(F.lit(0), F.lit(max_len) - n_c)).alias("attention_mask"),
        n_c.alias("n_tokens"))


# ------------------------------------------------------------------ vectors
def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
                       F.lit(0.0), lambda acc, x: acc + x)


def cosine(a: Column, b: Column) -> Column:
    return _dot(a, b) / (F.sqrt(_dot(a, a)) * F.sqrt(_dot(b, b)))


def vector_top_k(items: DataFrame, queries: list[tuple], k: int, item_id: str = "vec_id",
                 vec: str = "embedding", query_id: str = "query_id",
                 salt_buckets: int = 64, keep_query_vec: bool = False) -> DataFrame:
    """k nearest items per query by cosine similarity (ties -> smaller id).

    ``queries`` is a short list of (id, vector) that travels as a literal array
    with the plan; query sets in a table go to ``vector_top_k_frame``.  Top-k runs in two phases: inside (query, salt) buckets,
    then over the <= salt_buckets * k survivors, so one query never sorts the
    whole item table in one task.
    """
    qarr = F.array(*[F.struct(F.lit(qid).alias(query_id),
                              F.array(*[F.lit(x) for x in v]).alias("query_vec")) for qid, v in queries])
    j = items.select("*", F.explode(qarr).alias("__q")).select("*", "__q.*").drop("__q")
    j = j.withColumn("score", cosine(F.col(vec), F.col("query_vec")))
    salt = F.pmod(F.xxhash64(F.col(item_id)), F.lit(salt_buckets))
    w1 = Window.partitionBy(query_id, "__salt").orderBy(F.desc("score"), F.col(item_id))
    s1 = j.withColumn("__salt", salt).withColumn("__r", F.row_number().over(w1)).where(F.col("__r") <= k)
    w2 = Window.partitionBy(query_id).orderBy(F.desc("score"), F.col(item_id))
    out = s1.withColumn("rank", F.row_number().over(w2)).where(F.col("rank") <= k).drop("__salt", "__r")
    return out if keep_query_vec else out.drop("query_vec")


def vector_top_k_frame(items: DataFrame, queries: DataFrame, k: int, query_id: str = "query_id",
                       qvec: str = "query_vec", max_chunk: int = QUERY_ROWS, **kw) -> DataFrame:
    """Top-k for a query set of any size, as rows (``vectors.pivot_top_k``);
    ``max_chunk`` queries meet a part of a cell in one group."""
    return pivot_top_k(items, queries, k, query_id=query_id, qvec=qvec, query_rows=max_chunk, **kw)


def mmr_select(cands: DataFrame, k: int, lambda_mult: float = 0.5, query_id: str = "query_id",
               item_id: str = "vec_id", vec: str = "embedding", qvec: str = "query_vec") -> DataFrame:
    """Maximal marginal relevance over each query's candidates (<= fetch_k rows).

    Greedy: pick argmax of lambda*sim(q, d) - (1-lambda)*max sim(d, picked)."""
    import numpy as np
    import pandas as pd

    def pick(pdf: pd.DataFrame) -> pd.DataFrame:
        if pdf.empty:
            return pd.DataFrame({query_id: [], item_id: [], "mmr_rank": []})
        pdf = pdf.sort_values(item_id)
        m = np.vstack([np.asarray(v, dtype=float) for v in pdf[vec]])
        q = np.asarray(pdf[qvec].iloc[0], dtype=float)
        mn = m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12)
        qn = q / max(np.linalg.norm(q), 1e-12)
        rel = mn @ qn
        chosen: list[int] = []
        while len(chosen) < min(k, len(pdf)):
            if chosen:
                red = (mn @ mn[chosen].T).max(axis=1)
            else:
                red = np.zeros(len(pdf))
            score = lambda_mult * rel - (1 - lambda_mult) * red
            score[chosen] = -np.inf
            chosen.append(int(np.argmax(score)))
        ids = pdf[item_id].to_numpy()[chosen]
        return pd.DataFrame({query_id: pdf[query_id].iloc[0], item_id: ids,
                             "mmr_rank": np.arange(1, len(chosen) + 1)})

    schema = f"{query_id} {dict(cands.dtypes)[query_id]}, {item_id} {dict(cands.dtypes)[item_id]}, mmr_rank int"
    return cands.select(query_id, item_id, vec, qvec).groupBy(query_id).applyInPandas(pick, schema)
