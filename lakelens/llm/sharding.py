"""Sharding by balanced label propagation.

A label is a shard.  Linked rows start on evenly dealt labels; in each round
every linked row asks to move to the shard that holds most of its neighbours
(rows that share a link), and the requests a shard has room for are admitted,
whole links first.  Rows without a link fill what is left, so the counts are
exact (law ``rows``: at most one apart) while few links are cut.

Links are stored as memberships (row, link), never as pairs: a row's neighbours
per shard come from the shard histogram of its links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import dense_index, staged

SHARDS = 24
ROUNDS = 16
BUCKETS = 4096


def quotas(total: int, shards: int) -> list[int]:
    return [total // shards + (j < total % shards) for j in range(shards)]


def _loads(state: DataFrame, shards: int) -> list[int]:
    """Rows per shard: at most ``shards`` rows reach the driver."""
    got = {r["_shard"]: r["n"] for r in state.groupBy("_shard").agg(F.count("*").alias("n")).collect()}
    return [got.get(j, 0) for j in range(shards)]


def _requests(state: DataFrame, members: DataFrame, free: list[int], turn: int) -> DataFrame:
    """(_row, _from, _to, _link): rows whose best shard among ``free`` beats their own."""
    at = members.join(state, "_row")
    hist = at.groupBy("_link", "_shard").agg(F.count("*").alias("_n"))
    # one row per link; its list has one entry per shard at most
    per = hist.groupBy("_link").agg(F.collect_list(F.struct("_shard", "_n")).alias("_hist"))
    cand = at.join(per, "_link").select(
        "_row", "_link", F.col("_shard").alias("_from"), F.explode("_hist").alias("_c"))
    cand = cand.filter((F.col("_c._shard") == F.col("_from")) | F.col("_c._shard").isin(free))
    score = cand.groupBy("_row", "_from", F.col("_c._shard").alias("_to")).agg(
        F.sum("_c._n").alias("_score"), F.max(F.xxhash64("_link", "_c._shard")).alias("_tie"),
        F.min("_link").alias("_link"))
    best = score.groupBy("_row", "_from").agg(
        F.max(F.struct("_score", "_tie", "_to")).alias("_best"), F.min("_link").alias("_link"))
    out = (best.filter(F.col("_best._to") != F.col("_from"))
           .select("_row", "_from", F.col("_best._to").alias("_to"), "_link"))
    if turn >= 4 and turn % 2 == 0:     # half of the rows act, so that neighbours do not swap for ever
        out = out.filter(F.pmod(F.xxhash64("_row", F.lit(turn)), F.lit(2)) == 0)
    return out


def move_quotas(asked: dict[tuple[int, int], int], room: list[int]) -> dict[tuple[int, int], int]:
    """Moves allowed from shard i to shard j: as many as go the other way, plus
    the room of j, dealt over the shards that ask for it."""
    out = {}
    for j, free in enumerate(room):
        for i in range(len(room)):
            n = asked.get((i, j), 0)
            swap = min(n, asked.get((j, i), 0))
            extra = min(n - swap, max(0, free))
            free -= extra
            out[i, j] = swap + extra
    return out


def _asked(asked: DataFrame) -> dict[tuple[int, int], int]:
    """Requests from shard to shard: a table of shards x shards reaches the driver."""
    return {(r["_from"], r["_to"]): r["n"] for r in
            asked.groupBy("_from", "_to").agg(F.count("*").alias("n")).collect()}


def _admit(asked: DataFrame, cap: dict[tuple[int, int], int], k: int) -> DataFrame:
    """(_row, _to) admitted under the move quotas of ``k`` shards, exactly as many as
    they say: links in hash order, whole ones first; at most one link per pair of
    shards is admitted in part."""
    per = asked.groupBy("_from", "_to", "_link").agg(F.count("*").alias("_n"))
    caps = F.array(*[F.lit(int(cap[i, j])) for i in range(k) for j in range(k)])
    pair = ["_from", "_to"]
    per = per.withColumn("_b", F.pmod(F.xxhash64("_link"), F.lit(BUCKETS)).cast("int"))
    part = per.groupBy(*pair, "_b").agg(F.sum("_n").alias("_s"))
    part = part.select(*pair, "_b", F.coalesce(F.sum("_s").over(
        W.partitionBy(*pair).orderBy("_b").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    run = W.partitionBy(*pair, "_b").orderBy("_link").rowsBetween(W.unboundedPreceding, -1)
    per = per.join(part, [*pair, "_b"]).withColumn(
        "_before", F.col("_off") + F.coalesce(F.sum("_n").over(run), F.lit(0)))
    most = F.element_at(caps, F.col("_from") * k + F.col("_to") + 1)
    per = per.withColumn("_take", F.least(F.col("_n"), F.greatest(F.lit(0), most - F.col("_before"))))
    got = asked.join(per.filter("_take > 0").select(*pair, "_link", "_n", "_take"), [*pair, "_link"])
    whole = got.filter("_take = _n").select("_row", "_to")
    cut = dense_index(got.filter("_take < _n"), [*pair, "_link"], ["_row"], "_i")
    return whole.unionByName(cut.filter("_i < _take").select("_row", "_to"))


def propagate(members: DataFrame, linked: DataFrame, quota: list[int],
              rounds: int = ROUNDS) -> DataFrame:
    """(_row, _shard) for the rows of ``linked``; ``members`` is (_row, _link).

    Even turns let rows ask for any shard (full shards exchange rows one for
    one), odd turns only for shards with room, so that links larger than a shard
    spill into few others.  Two turns without a move end it.
    """
    shards = len(quota)
    state = staged(dense_index(linked.withColumn("_one", F.lit(0)), ["_one"], ["_row"], "_i")
                   .select("_row", (F.col("_i") % shards).cast("int").alias("_shard")), "shards")
    quiet, loads = 0, _loads(state, shards)
    for turn in range(rounds):
        room = [q - n for q, n in zip(quota, loads)]
        free = [j for j, r in enumerate(room) if r > 0] if turn % 2 else list(range(shards))
        cap = {}
        if free:
            asked = staged(_requests(state, members, free, turn), "shard-asks")
            cap = move_quotas(_asked(asked), room)
        if not any(cap.values()):
            quiet += 1
            if quiet == 2:
                break
            continue
        quiet = 0
        state = staged(state.join(_admit(asked, cap, shards), "_row", "left").select(
            "_row", F.coalesce("_to", "_shard").alias("_shard")), "shards")
        for (i, j), n in cap.items():       # all that may move do
            loads[i] -= n
            loads[j] += n
    return state


def shard_rows(rows: DataFrame, members: DataFrame, shards: int = SHARDS,
               rounds: int = ROUNDS) -> DataFrame:
    """Adds ``shard`` and ``slot`` (gapless inside the shard) to ``rows``, which
    carry a unique ``_row``; ``members`` is (_row, _link) with links of two
    rows or more."""
    quota = quotas(rows.count(), shards)
    linked = members.select("_row").distinct()
    state = propagate(members, linked, quota, rounds)
    left = [q - n for q, n in zip(quota, _loads(state, shards))]
    alone = dense_index(rows.select("_row").join(linked, "_row", "left_anti").withColumn("_one", F.lit(0)),
                        ["_one"], ["_row"], "_i")
    edge, where = 0, F.lit(None).cast("int")
    for j, r in reversed(list(enumerate(left))):
        upto = sum(left[:j + 1])
        where = F.when(F.col("_i") < upto, F.lit(j)).otherwise(where)
    placed = state.unionByName(alone.select("_row", where.alias("_shard")))
    placed = dense_index(placed, ["_shard"], ["_row"], "slot")
    return rows.join(placed.select("_row", F.col("_shard").alias("shard"), "slot"), "_row")


def shard_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """Every row in a shard, equal texts linked: id, size (UTF-8 bytes + 8),
    text_crc32, law, shard, slot, grown_shard.

    NULL texts have size 8 and no crc32, and link to nothing; empty texts are
    equal texts.  An empty table gives an empty result.  Repeated rows are
    placed one by one.
    """
    t = F.col(text_col)
    rows = docs.select(F.col(id_col).alias("_id"),
                       (F.coalesce(F.octet_length(t), F.lit(0)) + 8).cast("long").alias("size"),
                       F.crc32(t.cast("binary")).cast("long").alias("text_crc32"),
                       F.sha2(t, 256).alias("_key"))
    rows = staged(rows, "shard-rows")
    rows = staged(dense_index(rows.withColumn("_one", F.lit(0)), ["_one"], ["_id", "_key"], "_row")
                  .drop("_one"), "shard-rows")
    many = rows.filter("_key is not null").groupBy("_key").agg(F.count("*").alias("_n")).filter("_n > 1")
    members = staged(rows.join(many, "_key").select("_row", F.xxhash64("_key").alias("_link")), "shard-links")
    out = shard_rows(rows, members, shards, rounds)
    return out.select(F.col("_id").alias(id_col), "size", "text_crc32", F.lit("rows").alias("law"),
                      "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
