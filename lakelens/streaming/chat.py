"""Streams: stateless safety routing, per-conversation chat state, model scoring.

``stream_chat_history`` keeps, per conversation, only what later turns need:
the kept messages (the last ``k - 1`` with a window ``k``), the user turn waiting
for its reply, the turn of the last blocked user message and whether the session
has ended.  A conversation's rows may arrive over many micro-batches (in turn
order); ``idle_timeout`` drops the state of conversations that went silent.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from ..operators.chat import QUIT_WORDS, RESET_WORDS
from ..operators.text import HEALTH_RULES, route_expr

CONV_SCHEMA = "conv_id long, turn long, role string, text string"
OUT_SCHEMA = "conv_id long, turn long, history_len long, history_text string"
STATE_SCHEMA = "hist string, pending string, last_blocked long, ended boolean"
_WS = " \t\n\r\f\x0b"


def read_stream(spark: SparkSession, path: str, schema: str, max_files: int | None = None,
                file_glob: str | None = None) -> DataFrame:
    """Parquet files arriving in directory ``path`` (optionally only names
    matching ``file_glob``)."""
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    if file_glob:
        r = r.option("pathGlobFilter", file_glob)
    return r.parquet(path)


def stream_safety_route(stream: DataFrame, rules=HEALTH_RULES, text: str = "text") -> DataFrame:
    """Stateless: the batch column expression on each arriving message."""
    cat, rep = route_expr(F.col(text), rules)
    return stream.withColumns({"category": cat, "canned_reply": rep})


def _route_words(rules):
    return [(name, [w.lower() for w in words]) for name, _, words, _ in sorted(rules, key=lambda r: r[1])]


def stream_chat_history(stream: DataFrame, k: int | None = None, rules=HEALTH_RULES,
                        idle_timeout: str | None = None) -> DataFrame:
    """Per-user-turn history, equal to ``chat.conversation_history`` on the same rows."""
    words = _route_words(rules)
    cap = None if k is None else max(k - 1, 0)

    def blocked(t: str) -> bool:
        low = t.lower()
        return any(w in low for _, ws in words for w in ws)

    def step(key, pdfs, state):
        import pandas as pd
        if state.hasTimedOut:
            state.remove()
            return
        if state.exists:
            h, p, lb, ended = state.get
            hist = json.loads(h)
            pending = json.loads(p) if p else None
            last_blocked = lb
        else:
            hist, pending, last_blocked, ended = [], None, -10, False
        out = []
        rows = pd.concat(list(pdfs)).sort_values("turn")
        for turn, role, txt in zip(rows["turn"], rows["role"], rows["text"]):
            turn = int(turn)
            if ended:
                break
            if role == "user":
                t = (txt or "").strip(_WS)
                lt = t.lower()
                if lt in QUIT_WORDS:
                    ended = True
                    break
                if lt in RESET_WORDS:
                    hist, pending, last_blocked = [], None, -10
                    continue
                if t == "":
                    continue
                pending = None                      # a user turn with no reply in between failed
                if blocked(t):
                    last_blocked = turn
                    continue
                me = [turn, "user", t]
                full = (hist if cap is None else hist[-cap:] if cap else []) + [me]
                out.append((key[0], turn, len(full), "\n".join(f"{r}: {x}" for _, r, x in full)))
                pending = me
            elif role == "assistant":
                if last_blocked == turn - 1:
                    pending = None
                    continue
                if txt is None:
                    pending = None
                    continue
                if pending is not None and pending[0] == turn - 1:
                    hist.append(pending)
                hist.append([turn, "assistant", txt])
                pending = None
                if cap is not None:
                    hist = hist[-cap:] if cap else []
        state.update((json.dumps(hist), json.dumps(pending) if pending else None, int(last_blocked), bool(ended)))
        if idle_timeout:
            state.setTimeoutDuration(idle_timeout)
        yield pd.DataFrame(out, columns=["conv_id", "turn", "history_len", "history_text"])

    timeout = GroupStateTimeout.ProcessingTimeTimeout if idle_timeout else GroupStateTimeout.NoTimeout
    return stream.groupBy("conv_id").applyInPandasWithState(step, OUT_SCHEMA, STATE_SCHEMA, "append", timeout)


def stream_score(stream: DataFrame, model) -> DataFrame:
    """A fitted PipelineModel applied to arriving rows (the model ships with the plan)."""
    return model.transform(stream)


def run_available(df: DataFrame, out_path: str, checkpoint: str, fmt: str = "parquet") -> None:
    """Process everything available now, exactly once, into files; returns when done."""
    q = (df.writeStream.format(fmt).option("path", out_path).option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
