import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from lakelens.llm import sharding


def check(df, shards=24):
    rows = sharding.shard_documents(df, shards=shards).collect()
    src = Counter((r["doc_id"], r["text"]) for r in df.collect())
    n = sum(src.values())
    assert len(rows) == n
    per = Counter(r["shard"] for r in rows)
    assert all(per.get(j, 0) in (n // shards, -(-n // shards)) for j in range(shards))
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    want = Counter((i, 8 + len((t or "").encode()), None if t is None else zlib.crc32(t.encode())) for i, t in src.elements())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    return rows


def test_counts_slots_and_groups(docs):
    rows = check(docs)
    where = defaultdict(set)
    for r in rows:
        where[r["text_crc32"], r["size"]].add(r["shard"])
    room = len(rows) // 24
    groups = Counter((r["text_crc32"], r["size"]) for r in rows)
    assert sum(len(where[g]) > 1 for g, c in groups.items() if 1 < c <= room) <= 2


def test_edge_rows(edge):
    check(edge)
    check(edge, shards=3)


def test_empty(empty):
    assert sharding.shard_documents(empty).count() == 0


def test_group_larger_than_a_shard(spark):
    df = spark.createDataFrame([(i, "same" if i < 70 else f"t{i}") for i in range(120)], "doc_id long, text string")
    rows = check(df, shards=4)
    assert len({r["shard"] for r in rows if r["doc_id"] < 70}) == 3      # 30 a shard: as few as can hold it


def test_propagation_cuts_fewer_edges(spark):
    # overlapping links: a ring of groups that share members
    m = [(i, i // 6) for i in range(240)] + [(i, (i // 6 + 1) % 40) for i in range(0, 240, 6)]
    members = spark.createDataFrame(m, "_row long, _link long")
    rows = members.select("_row").distinct()
    out = {r["_row"]: r["shard"] for r in sharding.shard_rows(rows, members, 8).collect()}
    assert Counter(out.values()) == Counter({j: 30 for j in range(8)})
    cut = sum(len({out[r] for r, x in m if x == g}) > 1 for g in range(40))
    dealt = sum(len({r % 8 for r, x in m if x == g}) > 1 for g in range(40))
    assert dealt == 40 and cut < dealt


def test_turns_count_the_shards_once(spark, monkeypatch):
    """Loads after a turn follow from what it admitted: no job counts the shards again."""
    m = [(i, i // 6) for i in range(240)] + [(i, (i // 6 + 1) % 40) for i in range(0, 240, 6)]
    members = spark.createDataFrame(m, "_row long, _link long")
    count, seen = sharding._loads, []
    monkeypatch.setattr(sharding, "_loads", lambda state, shards: seen.append(count(state, shards)) or seen[-1])
    state = sharding.propagate(members, members.select("_row").distinct(), [30] * 8)
    assert len(seen) == 1
    assert count(state, 8) == [30] * 8
