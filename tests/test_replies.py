"""Replies joined to their tickets and parsed."""

import pytest
from pyspark.sql import functions as F

from lakelens.operators import text
from lakelens.plans import text_plans

GOOD = '{"tags": [{"tag": "A", "confidence": 0.5, "reason": "r"}]}'


def test_tickets_that_share_a_name_keep_their_own_reply(spark, tmp_path):
    # six digits of the name: 99,999, 999,999 and 1,000,003 are all TKT-100000
    ids = [99_999, 999_999, 1_000_003, 7]
    spark.createDataFrame([(i, i % 10, "view", '{"k": 3}') for i in ids],
                          "event_id long, user_id long, event_type string, props string") \
        .write.parquet(str(tmp_path / "events.parquet"))
    got = text_plans.q_reply_provider(spark, str(tmp_path))
    status = ["ok", "ok", "ok", "fallback", "no_tags", "fallback"]
    names = {i: "TKT-" + str(i + 1).rjust(6, "0")[:6] for i in ids}
    want = [(names[i], s, status[(i + k) % 6]) for i in ids for k, s in enumerate(text.STRATEGIES)]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert got.count() == 3 * len(ids)


@pytest.mark.parametrize("reply, status", [
    (GOOD, "ok"), (f"  ```json\n{GOOD}\n```", "ok"), ("{}", "no_tags"), ('{"tags": []}', "ok"), ('{"tags": null}', "no_tags"),
    ('{"x": {"y": [1, {"z": 2}]}, "tags": []}', "ok"), (GOOD + GOOD, "fallback"), (GOOD + ", " + GOOD, "fallback"),
    (GOOD + ", 5, " + GOOD, "fallback"), (GOOD + " {", "fallback"),
    (GOOD + " Hope this helps!", "fallback"), ("{", "fallback"), ("}", "fallback"), ("{'tags': []}", "fallback"),
    ('{"tags": 5}', "fallback"), ('{"tags": [5]}', "fallback"), ("[]", "fallback"), ("", "fallback"), (None, "fallback"),
    ('{"tags": [}', "fallback"), ('{"tags": [], }', "fallback")])
def test_status_of_a_reply(spark, reply, status):
    d = spark.range(1).select(F.lit(reply).cast("string").alias("reply"))
    got = text.parse_reply(d, "reply").first()
    assert got["parse_status"] == status
    assert len(got["tags"]) == {"fallback": 3, "no_tags": 0}.get(status, GOOD.count("reason") if "reason" in str(reply) else 0)
