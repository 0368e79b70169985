import pytest
import numpy as np
from pyspark.sql import functions as F

from lakelens.operators import chat, text
from lakelens.streaming import chat as sc


def test_safety_priority_case_and_substring(spark):
    rows = [("I have CHEST PAIN and want to die",), ("I feel hopelessness",), ("stroke of luck",), ("",),
            ("Can you diagnose me?",)]
    df = spark.createDataFrame(rows, "text string")
    got = [r["category"] for r in text.safety_route(df).collect()]
    assert got == ["emergency", "pass", "emergency", "pass", "diagnosis"]
    crisis = [r["category"] for r in text.crisis_flag(df).collect()]
    assert crisis == ["pass", "crisis", "pass", "pass", "pass"]


def test_disclaimer_once(spark):
    df = spark.createDataFrame([("hello",), ("ok " + text.DISCLAIMER.upper(),)], "r string")
    out = [r[0] for r in df.select(text.ensure_disclaimer(F.col("r"))).collect()]
    assert out[0].endswith("\n\n" + text.DISCLAIMER) and out[1].startswith("ok ")


REPLIES = [
    ('{"tags": [{"tag": "A", "confidence": 0.9, "reason": "x"}, {"tag": "B", "confidence": 0.5, "reason": "y"},'
     ' {"tag": "C", "confidence": 0.1, "reason": "z"}, {"tag": "D", "confidence": 0.0, "reason": "w"}]}', "ok", "A"),
    ('```{"tags": [{"tag": "A", "confidence": 0.9}]}```', "ok", "A"),
    ('```json\n{"tags": [{"tag": "B", "confidence": "0.7"}]}\n```', "ok", "B"),
    ('{"tags": [{"tag": "A", "confidence": 0.9}]} trailing', "fallback", "General Inquiry"),
    ("[1]", "fallback", "General Inquiry"),
    ('{"x": 1}', "no_tags", "Unknown"),
    ('{"tags": []}', "ok", "Unknown"),
    ("", "fallback", "General Inquiry"),
    (None, "fallback", "General Inquiry"),
]


def test_parse_reply_and_tag_result(spark):
    df = spark.createDataFrame([(i, r, "B") for i, (r, _, _) in enumerate(REPLIES)], "i int, reply string, true_tag string")
    out = text.tag_result(text.parse_reply(df)).orderBy("i").collect()
    for row, (_, status, top1) in zip(out, REPLIES):
        assert row["parse_status"] == status, row
        assert row["top1_tag"] == top1
    assert out[0]["top3_tags"] == ["A", "B", "C"] and out[0]["hit_top3"] is True
    assert out[2]["top1_conf"] == 0.7
    assert out[3]["top3_tags"] == ["General Inquiry"] * 3 and out[3]["top1_conf"] == 0.5
    assert out[5]["top1_conf"] == 0.0


def test_render_prompt_contains_tags(spark):
    df = spark.createDataFrame([("my bill",)], "t string")
    p = df.select(text.render_prompt(F.col("t"), text.FEW_SHOT_TEMPLATE)).first()[0]
    assert 'Ticket: "my bill"' in p and "  - Performance" in p and "{{" not in p


CONV = [
    (1, 0, "user", " reset "), (1, 1, "user", "hi"), (1, 2, "assistant", "hello"), (1, 3, "user", "reset"),
    (1, 4, "user", "again"), (1, 5, "assistant", "yes"),
    (2, 0, "system", "be nice"), (2, 1, "user", "q1"), (2, 2, "assistant", "a1"), (2, 3, "user", "QUIT"),
    (2, 4, "user", "late"),
    (3, 1, "user", "chest pain now"), (3, 2, "assistant", "canned"), (3, 3, "user", "ok"), (3, 4, "user", "two"),
    (3, 5, "assistant", None), (3, 6, "user", "three"), (3, 7, "assistant", "fine"), (3, 8, "user", "   "),
    (3, 9, "user", "four"),
]


def _hist(df):
    return {(r["conv_id"], r["turn"]): r["history_text"] for r in df.collect()}


def test_history_rules(spark):
    conv = spark.createDataFrame(CONV, chat_schema())
    h = _hist(chat.conversation_history(conv, 20))
    assert h[(1, 1)] == "user: hi"
    assert h[(1, 4)] == "user: again"                       # reset starts anew
    assert h[(2, 1)] == "user: q1"                          # system kept apart
    assert (2, 4) not in h                                  # after quit
    assert (3, 1) not in h                                  # blocked
    assert h[(3, 3)] == "user: ok"                          # canned reply excluded
    assert h[(3, 6)] == "user: three"                       # 'ok' (no reply) and 'two' (null reply) removed
    assert h[(3, 9)] == "user: three\nassistant: fine\nuser: four"
    small = _hist(chat.conversation_history(conv, 2))
    assert small[(3, 9)] == "assistant: fine\nuser: four"


def chat_schema():
    return "conv_id long, turn long, role string, text string"


def test_stream_equals_batch_over_two_batches(spark, tmpdir_path):
    conv = spark.createDataFrame(CONV, chat_schema())
    src = tmpdir_path + "/in"
    conv.where("turn <= 3").coalesce(1).write.parquet(src + "/a")
    conv.where("turn > 3").coalesce(1).write.parquet(src + "/b")
    # two files arrive as two micro-batches; the reset and the pending reply span them
    import glob
    import shutil
    flat = tmpdir_path + "/flat"
    import os
    os.makedirs(flat)
    for i, f in enumerate(sorted(glob.glob(src + "/a/*.parquet")) + sorted(glob.glob(src + "/b/*.parquet"))):
        shutil.copy(f, f"{flat}/part-{i}.parquet")
        os.utime(f"{flat}/part-{i}.parquet", (1000 + i, 1000 + i))
    s = sc.read_stream(spark, flat, sc.CONV_SCHEMA, max_files=1)
    out = tmpdir_path + "/out"
    sc.run_available(sc.stream_chat_history(s, 20), out, tmpdir_path + "/ckpt")
    got = _hist(spark.read.schema(sc.OUT_SCHEMA).parquet(out))
    assert got == _hist(chat.conversation_history(conv, 20))


def test_dialogue_and_extract(spark):
    conv = spark.createDataFrame(CONV, chat_schema())
    d = text.dialogue_pairs(conv).where("conv_id = 1 AND turn = 1").first()
    assert d["text"] == "User: hi \nBot: hello"
    assert spark.createDataFrame([("a Bot: b Bot:  c \n",)], "t string") \
        .select(text.extract_reply(F.col("t"))).first()[0] == "c"


def test_vector_top_k_ties(spark):
    items = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0])], "vec_id long, embedding array<float>")
    got = text.vector_top_k(items, [(0, [1.0, 0.0])], 2).orderBy("rank").collect()
    assert [r["vec_id"] for r in got] == [1, 2]


def test_vector_top_k_chunked_equals_single_plan(spark):
    from lakelens.operators import text as tx
    rng = np.random.default_rng(3)
    items = spark.createDataFrame([(i, [float(x) for x in rng.normal(size=4)]) for i in range(60)],
                                  "vec_id long, embedding array<float>")
    queries = spark.createDataFrame([(q, [float(x) for x in rng.normal(size=4)]) for q in range(7)],
                                    "query_id int, query_vec array<double>")
    one = tx.vector_top_k_frame(items, queries, 3)
    chunked = tx.vector_top_k_frame(items, queries, 3, max_chunk=2)
    cols = ["query_id", "vec_id", "rank"]
    assert sorted(one.select(cols).collect()) == sorted(chunked.select(cols).collect())
    assert chunked.count() == 21


def test_history_length_bounded_by_k(spark):
    from lakelens.operators import chat
    conv = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    for k in (1, 3):
        h = chat.conversation_history(conv, k=k)
        assert h.agg(F.max("history_len")).first()[0] <= k
        # the last history entry is the turn itself
        assert h.where(F.element_at("history", -1)["turn"] != F.col("turn")).count() == 0


def test_window_memory_is_bounded_in_a_long_session(spark, monkeypatch):
    monkeypatch.setattr(chat, "BLOCK", 8, raising=False)    # many blocks
    rows = [(9, t, "user" if t % 2 == 0 else "assistant", None if t % 14 == 5 else f"m{t}") for t in range(400)]
    conv = spark.createDataFrame(rows + [(None, 0, "user", "q"), *CONV], chat_schema())
    whole = {(r["conv_id"], r["turn"]): r["history"] for r in chat.conversation_history(conv).collect()}
    for k in (1, 2, 3, 12):
        part = chat.conversation_history(conv, k)
        assert {(r["conv_id"], r["turn"]): r["history"] for r in part.collect()} == {i: h[-k:] for i, h in whole.items()}
    plan = chat.conversation_history(conv, 3)._jdf.queryExecution().optimizedPlan().toString()
    lists = [line for line in plan.splitlines() if "collect_list" in line]
    assert lists and not any("unboundedpreceding" in line.lower() for line in lists)


def test_token_encode_cuts_after_tokenising_whole_text(spark):
    from lakelens.operators import text as tx
    long_doc = " ".join(["alpha"] * 200 + ["omega"] * 5)
    docs = spark.createDataFrame([(1, long_doc), (2, "omega beta"), (3, "")], "doc_id long, text string")
    vocab = tx.token_vocab(docs)
    ids = {r["token"]: r["id"] for r in vocab.collect()}
    assert ids["alpha"] < ids["omega"]          # counted over the whole text: 200 > 6
    enc = {r["doc_id"]: r for r in tx.token_encode(docs, vocab, "doc_id", "text", 128).collect()}
    assert enc[1]["n_tokens"] == 128 and set(enc[1]["input_ids"]) == {ids["alpha"]}
    assert enc[2]["input_ids"][:2] == [ids["omega"], ids["beta"]] and sum(enc[2]["attention_mask"]) == 2
    assert enc[3]["n_tokens"] == 0 and len(enc[3]["input_ids"]) == 128
