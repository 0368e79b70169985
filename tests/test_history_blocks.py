"""Whole histories put together from blocks: equal at every block size, no hot task."""
import random
from statistics import median

import pytest
from pyspark.sql import functions as F

from lakelens.operators import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def logs():
    rng = random.Random(2)
    rows = []
    for c in [1, 2, 3, None]:
        for t in range(rng.choice([3, 40, 90])):
            role = rng.choice(["user", "user", "assistant", "assistant", "system"])
            text = rng.choice([f"m{t}", f"m{t}", f"m{t}", "reset", " ", None, "chest pain", "quit" if t > 60 else "go"])
            rows.append((c, t, role, text))
    rows += [(9, t, "user", f"unanswered {t}") for t in range(50)]
    return rows


def test_same_at_every_block_size(spark):
    conv = spark.createDataFrame(logs(), SCHEMA)
    cols = ["conv_id", "turn", "history_len", "history_text"]
    want = sorted((tuple(r) for r in chat.conversation_history(conv, 10_000).select(*cols).collect()), key=str)
    for block in (1, 4, 1024):
        got = sorted((tuple(r) for r in chat.conversation_history(conv, block=block).select(*cols).collect()), key=str)
        assert got == want
    assert max(r[2] for r in want) > 20


@pytest.mark.parametrize("n", [3000])
def test_hot_session_spreads(spark, n):
    """A session with a third of all rows: the tasks that make the histories
    read no more than three times the median."""
    hot = [(1, t, "user" if t % 2 == 0 else "assistant", f"m{t}") for t in range(n // 3)]
    rest = [(2 + c, t, "user" if t % 2 == 0 else "assistant", "x") for c in range(n // 60) for t in range(40)]
    conv = spark.createDataFrame(hot + rest, SCHEMA)
    keys = ["conv_id", "segment", "__block"]
    h = chat._all_kept(chat.history_rows(conv), conv, 20,
                       F.struct(F.col("turn").cast("bigint").alias("turn"), F.col("role"), F.col("text")))
    per = h.groupBy(*keys).count().groupBy(F.pmod(F.xxhash64(*keys), F.lit(8)).alias("task")).agg(
        F.sum("count").alias("n"), F.max("count").alias("most")).collect()
    assert max(r["most"] for r in per) <= 20 and len(per) == 8
    assert max(r["n"] for r in per) <= 3 * median(r["n"] for r in per)
    assert chat.conversation_history(conv, block=20).where("conv_id = 1").agg(F.max("history_len")).first()[0] == n // 3 - 1
