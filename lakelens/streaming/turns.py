"""Chat history as a stateful stream with typed state (``transformWithState``).

A conversation's turns may arrive in any order and over any number of
micro-batches.  The state store holds, per conversation:

* ``head`` (value): the next turn number, whether the session ended, the last
  blocked user turn, and the timer set;
* ``open`` (value): the user turn that waits for its reply;
* ``kept`` (list): the history, one entry a turn, appended turn by turn (with a
  window ``k`` at most its last ``k - 1`` entries);
* ``waiting`` (map): turns that came before an earlier one, by turn number.

Turns are taken in number order.  A turn whose predecessors are missing waits
for them, at most ``gap_wait``; then the gap is given up and all waiting turns
are taken in order.  A conversation silent for ``idle`` loses its state, and so
does the history of a session that was reset or quit.  With event time both
deadlines are timers on the stream's watermark; with processing time they run on
the clock, and every entry also carries ``idle`` as its time to live.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.chat import QUIT_WORDS, RESET_WORDS
from ..operators.text import HEALTH_RULES
from .chat import OUT_SCHEMA, _WS, _route_words

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
NEVER = -10         # "no blocked turn yet": no turn follows it


class ChatTurns(StatefulProcessor):
    """Rows (conv_id, turn, role, text, ts) to one history per passing user turn."""

    def __init__(self, k: int | None, rules, gap_ms: int, idle_ms: int, event_time: bool, first_turn: int = 0):
        self.cap = None if k is None else max(k - 1, 0)
        self.words = [w for _, ws in _route_words(rules) for w in ws]
        self.gap_ms, self.idle_ms, self.event_time, self.first_turn = gap_ms, idle_ms, event_time, first_turn

    def init(self, handle: StatefulProcessorHandle) -> None:
        ttl = None if self.event_time else self.idle_ms
        self.handle = handle
        self.head = handle.getValueState("head", "next long, ended boolean, blocked long, timer long", ttl)
        self.open = handle.getValueState("open", "turn long, text string", ttl)
        self.kept = handle.getListState("kept", "turn long, role string, text string", ttl)
        self.waiting = handle.getMapState("waiting", "turn long", "role string, text string", ttl)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        self._read()
        held = {t[0]: v for t, v in self.waiting.iterator()} if self.old_timer_is_gap else {}
        was, seen, out = set(held), 0, []
        for pdf in rows:
            pdf = pdf[pdf["turn"].notna()]
            if self.event_time and len(pdf):
                seen = max(seen, int(pdf["ts"].max().timestamp() * 1000))
            for turn, role, text in zip(pdf["turn"], pdf["role"], pdf["text"]):
                if not self.ended and int(turn) >= self.next:
                    held.setdefault(int(turn), (role, text))
            out += self._drain(key[0], held)
        self._write(held, was, seen if self.event_time else timerValues.getCurrentProcessingTimeInMs())
        yield pd.DataFrame(out, columns=["conv_id", "turn", "history_len", "history_text"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self._read()
        self.timer = 0                                  # it just fired
        held = {t[0]: v for t, v in self.waiting.iterator()}
        if not held:
            for s in (self.head, self.open, self.kept, self.waiting):
                s.clear()
            return
        out, was = [], set(held)
        while held and not self.ended:                  # the missing turns are given up
            self.next = min(held)
            out += self._drain(key[0], held)
        now = timerValues.getCurrentWatermarkInMs() if self.event_time else timerValues.getCurrentProcessingTimeInMs()
        self._write(held, was, max(now, expiredTimerInfo.getExpiryTimeInMs()))
        yield pd.DataFrame(out, columns=["conv_id", "turn", "history_len", "history_text"])

    # -- state in and out: read once, then only what changed goes back --

    def _read(self):
        self.next, self.ended, self.blocked, self.timer = self.head.get() or (self.first_turn, False, NEVER, 0)
        self.old_timer_is_gap = self.timer < 0          # negative: the timer guards waiting turns
        self.pending = self.open.get()
        self.had_pending = self.pending is not None
        self.history = [tuple(x) for x in self.kept.get()]
        self.stored, self.cut = len(self.history), False

    def _write(self, held: dict, was: set, now: int):
        if self.ended:
            held.clear()
            self._forget()
        for turn in was - set(held):
            self.waiting.removeKey((turn,))
        for turn in set(held) - was:
            self.waiting.updateValue((turn,), held[turn])
        if self.cut:
            self.kept.clear()
            self.stored = 0
        new = self.history[self.stored:]
        if new:
            self.kept.appendList(new)
        if self.pending is not None:
            self.open.update(self.pending)
        elif self.had_pending:
            self.open.clear()
        due = now + (self.gap_ms if held else self.idle_ms)
        if abs(self.timer) != due:
            if self.timer:
                self.handle.deleteTimer(abs(self.timer))
            self.handle.registerTimer(due)
        self.head.update((self.next, self.ended, self.blocked, -due if held else due))

    def _forget(self):
        self.history, self.pending, self.blocked, self.cut = [], None, NEVER, True

    def _keep(self, *turns):
        self.history.extend(turns)
        if self.cap is not None and len(self.history) > self.cap:
            self.history = self.history[-self.cap:] if self.cap else []
            self.cut = True

    # -- the turns that stand in line, in order --

    def _drain(self, conv, held: dict) -> list:
        out = []
        while not self.ended and self.next in held:
            turn = self.next
            role, text = held.pop(turn)
            self.next += 1
            if role == "user":
                out += self._user(conv, turn, (text or "").strip(_WS))
            elif role == "assistant":
                answers, self.pending = self.pending, None
                if self.blocked != turn - 1 and text is not None:
                    asked = [(answers[0], "user", answers[1])] if answers and answers[0] == turn - 1 else []
                    self._keep(*asked, (turn, "assistant", text))
        return out

    def _user(self, conv, turn: int, text: str) -> list:
        low = text.lower()
        if low in QUIT_WORDS:
            self.ended = True
            return []
        if low in RESET_WORDS:
            self._forget()
            return []
        if not text:
            return []
        self.pending = None                             # an earlier user turn without a reply failed
        if any(w in low for w in self.words):
            self.blocked = turn
            return []
        self.pending = (turn, text)
        full = [*(self.history if self.cap is None else self.history[-self.cap:] if self.cap else []),
                (turn, "user", text)]
        return [(conv, turn, len(full), "\n".join(f"{r}: {x}" for _, r, x in full))]


def stream_chat_turns(stream: DataFrame, k: int | None = None, rules=HEALTH_RULES, gap_wait_ms: int = 600_000,
                      idle_ms: int = 86_400_000, event_time: str | None = "ts", first_turn: int = 0) -> DataFrame:
    """Per-user-turn history of a stream of (conv_id, turn, role, text[, ts]),
    equal to ``chat.conversation_history`` on the same rows whatever order they
    arrive in.

    ``event_time`` names a watermarked timestamp column; None runs the deadlines
    on the clock.  ``idle_ms`` must be at least ``gap_wait_ms``.  A turn number
    that was already taken, or given up, is ignored; so is a NULL turn.  Without
    ``k`` the history of a live session is kept whole.  Start the query under
    ``rocksdb_state``.
    """
    if idle_ms < gap_wait_ms:
        raise ValueError("idle_ms must be at least gap_wait_ms")
    cols = ["conv_id", "turn", "role", "text"] + ([event_time] if event_time else [])
    d = stream.select(*cols)
    if event_time and event_time != "ts":
        d = d.withColumnRenamed(event_time, "ts")
    return d.groupBy("conv_id").transformWithStateInPandas(
        statefulProcessor=ChatTurns(k, rules, gap_wait_ms, idle_ms, event_time is not None, first_turn),
        outputStructType=OUT_SCHEMA, outputMode="Append", timeMode="EventTime" if event_time else "ProcessingTime")


class rocksdb_state:
    """Typed state needs the RocksDB store: set for queries started inside, then put back."""

    def __init__(self, spark: SparkSession):
        self.conf = spark.conf

    def __enter__(self):
        self.was = self.conf.get(PROVIDER, None)
        self.conf.set(PROVIDER, ROCKSDB)

    def __exit__(self, *_):
        if self.was is None:
            self.conf.unset(PROVIDER)
        else:
            self.conf.set(PROVIDER, self.was)
