"""Conversation logs: commands, segments and per-turn history (batch form).

Rows are ``(conv_id, turn, role, text)``.  The quit cut is a per-conversation
min joined back, segments are bucketed prefix counts of resets, replies pair
with their user turn by an equi-join on (conv_id, turn + 1).  Histories are put
together from blocks of rows, so no window or group holds a whole session.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.common import join_null_safe
from ..functions.keys import ROWS_PER_BUCKET, grouped_prefix_sums
from ..session import stage_table
from .text import HEALTH_RULES, route_expr

# Session commands (typed alone, any case, surrounding blanks ignored).
QUIT_WORDS = ["quit", "exit"]
RESET_WORDS = ["reset"]
# The whitespace that Python's str.strip() removes (ASCII part).
STRIP_CLASS = "[ \\t\\n\\r\\f\\u000B]"

# Kept rows of a segment that one window of a bounded history takes.
BLOCK = 1024


def strip_ws(c):
    return F.regexp_replace(c, f"^{STRIP_CLASS}+|{STRIP_CLASS}+$", "")


def command_filter(conv: DataFrame) -> DataFrame:
    """Strip user text; drop empty user turns; 'quit'/'exit' ends the
    conversation (it and later turns dropped); 'reset' starts a new segment
    (the reset turn dropped).  Adds ``segment`` (resets seen so far)."""
    t = strip_ws(F.col("text"))
    is_user = F.col("role") == "user"
    d = conv.withColumns({"__t": t, "__u": is_user})
    lt = F.lower(F.col("__t"))
    d = d.withColumns({"__quit": F.col("__u") & lt.isin(QUIT_WORDS),
                       "__reset": (F.col("__u") & lt.isin(RESET_WORDS)).cast("long")})
    q = d.where("__quit").groupBy("conv_id").agg(F.min("turn").alias("__qt"))
    d = d.join(q, "conv_id", "left").where(F.col("__qt").isNull() | (F.col("turn") < F.col("__qt")))
    d = grouped_prefix_sums(d, "turn", ["__reset"], ["conv_id"], inclusive=True)
    d = d.withColumn("segment", F.col("cum___reset"))
    empty = F.col("__u") & (F.col("__t").isNull() | (F.col("__t") == ""))
    d = d.where(~((F.col("__reset") == 1) | empty))
    return d.select("conv_id", "turn", "role",
                    F.when(F.col("__u"), F.col("__t")).otherwise(F.col("text")).alias("text"), "segment")


def history_rows(conv: DataFrame, rules=HEALTH_RULES) -> DataFrame:
    """Filtered rows with flags: ``target`` (a user turn sent to the model) and
    ``kept`` (stays in later history).  A blocked user turn and its canned
    reply are never kept; a user turn without a non-null reply right after it
    is removed (the failed-call rule); system rows are kept apart."""
    f = command_filter(conv)
    cat, _ = route_expr(F.col("text"), rules)
    f = f.withColumn("__blocked", (F.col("role") == "user") & (cat != "pass"))
    nxt = f.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").isNotNull().alias("__reply_ok"))
    prv = f.where(F.col("role") == "user").select(
        "conv_id", (F.col("turn") + 1).alias("turn"), F.col("__blocked").alias("__prev_blocked"))
    g = f.join(nxt, ["conv_id", "turn"], "left").join(prv, ["conv_id", "turn"], "left")
    is_user, is_asst = F.col("role") == "user", F.col("role") == "assistant"
    target = is_user & ~F.col("__blocked")
    kept = (target & F.coalesce(F.col("__reply_ok"), F.lit(False))) | \
           (is_asst & F.col("text").isNotNull() & ~F.coalesce(F.col("__prev_blocked"), F.lit(False)))
    return g.select("conv_id", "turn", "role", "text", "segment",
                    target.alias("target"), kept.alias("kept"))


def conversation_history(conv: DataFrame, k: int | None = None, rules=HEALTH_RULES,
                         block: int = BLOCK) -> DataFrame:
    """For each passing user turn: the kept turns of its segment before it, then
    itself; with ``k``, the last ``k - 1`` of them (a window memory).  Output:
    conv_id, turn, history (array of struct(turn, role, text) in turn order),
    history_len, history_text.

    With ``k``, kept rows are numbered within their segment and cut into blocks
    of positions with a halo of the ``k - 2`` kept rows before, so no window holds
    a whole session; a turn takes the rows up to its last kept one by an equi-join.
    Without ``k``, the segment's rows are cut into blocks of ``block`` rows.  A
    block's kept rows are collected once; the rows of all earlier blocks are
    attached per block by an equi-join on the block number, and a window inside
    the block adds what precedes each turn there.  The output itself grows with
    the square of a segment's turns, the work before it by a ``block``-th of that.
    """
    if k is not None and k < 1:
        raise ValueError("k must be >= 1")
    h = history_rows(conv, rules)
    me = F.struct(F.col("turn").cast("bigint").alias("turn"), F.col("role"), F.col("text"))
    if k is None:
        h = _all_kept(h, conv, block, me)
    elif k == 1:
        h = h.where("target").withColumn("__prior", F.slice(F.array(me), 1, 0))
    else:
        h = _last_kept(h, conv, k - 1, me)
    out = h.select("conv_id", "turn", F.concat("__prior", F.array(me)).alias("history"))
    return out.withColumns({
        "history_len": F.size("history").cast("long"),
        "history_text": F.array_join(F.transform("history", lambda m: F.concat(m["role"], F.lit(": "), m["text"])), "\n"),
    })


def _all_kept(h: DataFrame, conv: DataFrame, size: int, me: Column) -> DataFrame:
    """Target rows with ``__prior``, all kept rows of the segment before each."""
    d = h.where(F.col("target") | F.col("kept")).withColumn("__one", F.lit(1).cast("long"))
    d = grouped_prefix_sums(d, "turn", ["__one"], ["conv_id", "segment"], inclusive=False,
                            n_buckets=-(-conv.count() // ROWS_PER_BUCKET) or 1)
    d = stage_table(d.withColumn("__block", F.floor(F.col("cum___one") / F.lit(size)))
                    .drop("__one", "cum___one", "total___one"), "history-blocks")
    keys = ["conv_id", "segment", "__block"]
    inside = Window.partitionBy(*keys).orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    near = d.withColumn("__near", F.collect_list(F.when(F.col("kept"), me)).over(inside)).where("target")
    # whole earlier blocks, once per later block of the segment
    blocks = d.where("kept").groupBy(*keys).agg(F.sort_array(F.collect_list(me)).alias("__rows"))
    later = (d.where(F.col("target") & (F.col("__block") > 0)).select(*keys).distinct()
             .withColumn("__early", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__block") - 1))))
    met = join_null_safe(later, blocks.withColumnRenamed("__block", "__early"), ["conv_id", "segment", "__early"])
    far = met.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("__early", "__rows"))).alias("__far"))
    far = far.withColumn("__far", F.flatten(F.transform("__far", lambda b: b["__rows"])))
    out = join_null_safe(near, far, keys, "left")
    return out.withColumn("__prior", F.concat(F.coalesce("__far", F.slice(F.array(me), 1, 0)), F.col("__near")))


def _last_kept(h: DataFrame, conv: DataFrame, n: int, me: Column) -> DataFrame:
    """Target rows with ``__prior``, the last ``n`` kept rows of the segment before each."""
    d = h.where(F.col("target") | F.col("kept")).withColumn("__kept", F.col("kept").cast("long"))
    d = grouped_prefix_sums(d, "turn", ["__kept"], ["conv_id", "segment"], inclusive=False,
                            n_buckets=-(-conv.count() // ROWS_PER_BUCKET) or 1)
    d = stage_table(d.withColumn("__pos", F.col("cum___kept")).drop("__kept", "cum___kept", "total___kept"),
                    "history-rows")
    size = max(BLOCK, n)
    block = lambda pos: F.floor(pos / F.lit(size))
    own = block(F.col("__pos"))
    halo = d.where("kept").withColumn("__block", F.explode(F.sequence(own, block(F.col("__pos") + n - 1))))
    upto = Window.partitionBy("conv_id", "segment", "__block").orderBy("__pos").rowsBetween(1 - n, 0)
    tails = (halo.withColumn("__prior", F.collect_list(me).over(upto)).where(F.col("__block") == own)
             .select("conv_id", "segment", (F.col("__pos") + 1).alias("__pos"), "__prior"))
    out = join_null_safe(d.where("target"), tails, ["conv_id", "segment", "__pos"], "left")
    return out.withColumn("__prior", F.coalesce("__prior", F.slice(F.array(me), 1, 0)))
