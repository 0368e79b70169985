"""Typed-state chat stream: out-of-order turns over micro-batches, expiry, bounded state."""
import datetime as dt
import os

import pytest

from lakelens.operators import chat
from lakelens.streaming import chat as sc
from lakelens.streaming import turns

SCHEMA = sc.CONV_SCHEMA + ", ts timestamp"
T0 = dt.datetime(2024, 1, 1)


def conversation(conv_id, n):
    rows = [(conv_id, 0, "system", "be nice")]
    for t in range(1, n):
        rows.append((conv_id, t, "user" if t % 2 else "assistant", f"c{conv_id} t{t}"))
    return rows


def script():
    rows = [r for c in (1, 2, 3, 4) for r in conversation(c, 15)]
    put = {(2, 7): "  RESET ", (3, 9): "Quit", (4, 5): "chest pain now", (4, 9): " \t", (1, 11): None}
    return [(c, t, r, put.get((c, t), x)) for c, t, r, x in rows]


def feed(spark, path, batches):
    """One file per micro-batch, in this order."""
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{path}/b{i}")
        name = next(f for f in os.listdir(f"{path}/b{i}") if f.endswith(".parquet"))
        os.makedirs(f"{path}/in", exist_ok=True)
        os.link(f"{path}/b{i}/{name}", f"{path}/in/part-{i}.parquet")
        os.utime(f"{path}/in/part-{i}.parquet", (1000 + i, 1000 + i))


def run(spark, path, **kw):
    s = sc.read_stream(spark, f"{path}/in", SCHEMA, max_files=1).withWatermark("ts", "1 minute")
    with turns.rocksdb_state(spark):
        sc.run_available(turns.stream_chat_turns(s.where("ts < TIMESTAMP '2900-01-01'"), **kw),
                         path + "/out", path + "/ckpt")
    return {(r["conv_id"], r["turn"]): r["history_text"]
            for r in spark.read.schema(sc.OUT_SCHEMA).parquet(path + "/out").collect()}


def state(spark, path, name):
    return spark.read.format("statestore").option("stateVarName", name).load(path + "/ckpt").collect()


@pytest.mark.parametrize("k", [None, 4])
def test_three_batches_out_of_order_equal_batch(spark, tmpdir_path, k):
    rows = script()
    by = [[], [], []]
    for i, r in enumerate(rows):                # every conversation is torn over all batches, late parts first
        by[(2 * i + r[0]) % 3].append((*r, T0 + dt.timedelta(seconds=i % 20)))
    feed(spark, tmpdir_path, [list(reversed(b)) for b in by])
    got = run(spark, tmpdir_path, k=k)
    want = chat.conversation_history(spark.createDataFrame(rows, sc.CONV_SCHEMA), k)
    assert got == {(r["conv_id"], r["turn"]): r["history_text"] for r in want.collect()}
    assert (2, 7) not in got and (3, 11) not in got and (4, 5) not in got
    # bounded state: no turn waits, ended sessions keep no text, a window keeps k - 1 turns
    assert state(spark, tmpdir_path, "waiting") == []
    kept = state(spark, tmpdir_path, "kept")
    sizes = {c: sum(r["key"]["conv_id"] == c for r in kept) for c in (1, 2, 3, 4)}
    assert sizes[3] == 0
    if k:
        assert max(sizes.values()) <= k - 1
    else:
        assert sizes[2] == 7            # turns 8 to 14, behind the reset


def test_gap_is_waited_for_then_given_up_and_idle_state_goes(spark, tmpdir_path):
    at = lambda s: T0 + dt.timedelta(seconds=s)
    c = {t: (1, t, "user" if t % 2 == 0 else "assistant", f"t{t}") for t in range(8)}
    feed(spark, tmpdir_path, [
        [(*c[0], at(0)), (*c[1], at(1)), (*c[4], at(2)), (*c[5], at(2))],       # 2, 3 missing
        [(9, 0, "user", "x", at(30))],                                          # too early to give up
        [(9, 1, "assistant", "y", at(400))],                                    # watermark passes 2 s + 2 min
        [(9, 2, "user", "z", at(401))],
        [(*c[6], at(402)), (*c[3], at(402))],                                   # 3 comes too late
        [(7, 0, "user", "other", at(5000))],                                    # conversations 1 and 9 are idle now
        [(7, 1, "assistant", "ok", at(5001))],
        [(9, 0, "user", "new life", at(9000))],
    ])
    got = run(spark, tmpdir_path, gap_wait_ms=120_000, idle_ms=3_600_000)
    del got[(9, 0)]         # twice, see below
    assert got == {(1, 0): "user: t0", (1, 4): "user: t0\nassistant: t1\nuser: t4",
                   (1, 6): "user: t0\nassistant: t1\nuser: t4\nassistant: t5\nuser: t6",
                   (9, 2): "user: x\nassistant: y\nuser: z", (7, 0): "user: other"}
    rows = spark.read.schema(sc.OUT_SCHEMA).parquet(tmpdir_path + "/out").where("conv_id = 9 AND turn = 0").collect()
    assert sorted(r["history_text"] for r in rows) == ["user: new life", "user: x"]    # started anew after expiry
    assert {r["key"]["conv_id"] for r in state(spark, tmpdir_path, "head")} <= {7, 9}


def test_processing_time_keeps_a_time_to_live(spark, tmpdir_path):
    """On the clock every entry carries a TTL; the histories are the same."""
    rows = script()
    feed(spark, tmpdir_path, [[(*r, T0) for r in rows]])
    s = sc.read_stream(spark, tmpdir_path + "/in", SCHEMA)
    with turns.rocksdb_state(spark):
        q = (turns.stream_chat_turns(s, 5, event_time=None).writeStream.format("parquet")
             .option("path", tmpdir_path + "/out").option("checkpointLocation", tmpdir_path + "/ckpt")
             .outputMode("append").trigger(processingTime="1 second").start())
        try:
            for _ in range(120):
                if q.lastProgress and q.lastProgress["batchId"] >= 1:
                    break
                q.awaitTermination(1)
        finally:
            q.stop()
    got = {(r["conv_id"], r["turn"]): r["history_text"]
           for r in spark.read.schema(sc.OUT_SCHEMA).parquet(tmpdir_path + "/out").collect()}
    want = chat.conversation_history(spark.createDataFrame(rows, sc.CONV_SCHEMA), 5)
    assert got == {(r["conv_id"], r["turn"]): r["history_text"] for r in want.collect()}
    meta = "".join(open(os.path.join(d, f), errors="replace").read()
                   for d, _, fs in os.walk(tmpdir_path + "/ckpt/state") for f in fs if "_stateSchema" in d or "metadata" in d)
    assert "kept" in meta


def test_deadlines_are_checked():
    with pytest.raises(ValueError, match="idle_ms"):
        turns.stream_chat_turns(None, gap_wait_ms=10, idle_ms=5)
