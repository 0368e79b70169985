"""NULLs, ties, large integers and trailing text: rows the driver tables lack."""
import json

import pytest
from pyspark.sql import functions as F

from lakelens.functions import keys
from lakelens.operators import chat, clean, metrics, sampling, tables, text


@pytest.mark.parametrize("n", [1, 3, 17])
def test_rank_keeps_nulls_and_int64_order(spark, n):
    base = 1 << 53
    rows = [(base + i * 7 % 20,) for i in range(20)] + [(None,), (None,), (5,), (5,)]
    df = spark.createDataFrame(rows, "x long").withColumn("k", F.md5(F.coalesce(F.col("x"), F.lit(-1)).cast("string")))
    got = [(r["rank"], r["x"]) for r in keys.rank_by_value(df, "x", "k", n_buckets=n).orderBy("rank").collect()]
    assert [r for r, _ in got] == list(range(1, 25))
    assert [x for _, x in got] == [None, None, 5, 5, *range(base, base + 20)]


@pytest.mark.parametrize("n", [1, 3, 17])
def test_auc_leaves_out_null_scores(spark, n):
    rows = [(1, 0.9), (0, 0.1), (1, 0.4), (0, 0.5), (1, None), (0, None), (None, 0.3)]
    df = spark.createDataFrame(rows, "y int, score double")
    assert metrics.roc_auc(df, n_buckets=n).first()["auc"] == pytest.approx(0.75)


def test_quotas_pass_int64(spark):
    big = 3_000_000_000
    cc = spark.createDataFrame([("a",), ("b",)], "label string")
    assert sampling.class_quotas(cc, "label").count() == 2
    num = f"(cast({big * 2} as decimal(19,0)) * cast({big} as decimal(19,0)))"
    assert spark.sql(f"select {num} div cast({2 * big} as decimal(19,0)) x").first()["x"] == big


def test_half_median_widens(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (4,), (None,)], "x long")
    filled, report = clean.fill_median(df, ["x"])
    assert sorted(r["x"] for r in filled.collect()) == [1.0, 2.0, 2.5, 3.0, 4.0]
    assert report.first()["median"] == 2.5


def test_argmax_ties_take_the_smallest_name(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", None)], "name string, m double")
    assert tables.argmax_group(df, "name", "m").first()["best_name"] == "a"


def test_metrics_with_nulls(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, None), (None, 1.0)], "y double, pred double")
    m = metrics.regression_metrics(df).first()
    assert m["n"] == 2 and m["mae"] == 0.5 and m["r2"] == pytest.approx(0.5)
    c = metrics.confusion_matrix(spark.createDataFrame([(0, 0), (None, 1), (1, 1)], "y int, pred int"), [0, 1])
    assert sorted((str(r["truth"]), r["0"], r["1"]) for r in c.collect()) == [("0", 1, 0), ("1", 0, 1), ("None", 0, 1)]


def test_reply_with_trailing_text(spark):
    ok = json.dumps({"tags": [{"tag": "t", "confidence": 0.9, "reason": "r"}]})
    rows = [(ok, "ok"), ("```json\n" + ok + "\n```", "ok"), (ok + '\n{"x":1}', "fallback"), (ok + " see {note}", "fallback"),
            (ok + "," + ok, "fallback"), ("{}", "no_tags"), ("[1]", "fallback"), (None, "fallback")]
    df = spark.createDataFrame(rows, "reply string, want string")
    assert all(r["parse_status"] == r["want"] for r in text.parse_reply(df).collect())


def test_history_is_whole(spark):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"m{t}") for t in range(60)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert [r["history_len"] for r in chat.conversation_history(df).orderBy("turn").collect()] == list(range(1, 61, 2))
    assert max(r["history_len"] for r in chat.conversation_history(df, 3).collect()) == 3


def test_no_size_switches_and_whole_learning_curve(spark, monkeypatch):
    import inspect

    from lakelens.operators import models, tables
    from lakelens.plans import model_plans
    assert "budget" not in inspect.signature(tables.scatter_pairs).parameters
    assert "max_size" not in inspect.signature(text.token_vocab).parameters

    class Asked(Exception):
        pass

    def fit(label, iters, **_):
        raise Asked(iters)
    monkeypatch.setattr(models, "gbt_regression", fit)
    with pytest.raises(Asked, match="^200$"):
        model_plans.q_learning_curve(spark, "/root/testdata/sf0.001")
