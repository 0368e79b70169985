import itertools
import random

import xxhash

from lakelens.llm import simhash


def brute_fp(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    sh = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [b" ".join(w)]
    hs = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hs) > len(hs))


def brute_components(ids, fps, radius=3):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, j in itertools.combinations(range(len(fps)), 2):
        if bin(fps[i] ^ fps[j]).count("1") <= radius:
            root[find(j)] = find(i)
    low = {}
    for i, x in enumerate(ids):
        if x is not None:
            low[find(i)] = min(low.get(find(i), x), x)
    return [low.get(find(i)) for i in range(len(ids))]


def check(df):
    rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    fps = [brute_fp(t) for _, t in rows]
    comp = brute_components([i for i, _ in rows], fps)
    want = sorted((str(i), f"{f:016x}", str(c)) for (i, _), f, c in zip(rows, fps, comp))
    got = sorted((str(r["doc_id"]), r["fingerprint"], str(r["component_id"]))
                 for r in simhash.near_duplicates(df).collect())
    assert got == want


def test_against_all_pairs(docs):
    check(docs)


def test_edge_rows(edge):
    check(edge)


def test_empty(empty):
    assert simhash.near_duplicates(empty).count() == 0


def test_masks_cover_every_difference():
    masks = [m & (1 << 64) - 1 for m in simhash.covering_masks(3)]
    rng = random.Random(3)
    assert len(masks) == 15
    for _ in range(4000):
        d = sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3)))
        assert any(d & m == 0 for m in masks)


def test_oversize_buckets_link_the_same(spark):
    rng = random.Random(11)
    base = rng.getrandbits(64)
    fps = {base}
    while len(fps) < 150:       # a dense cloud plus strangers
        x = rng.choice(sorted(fps))
        for b in rng.sample(range(64), rng.randint(1, 5)):
            x ^= 1 << b
        fps.add(x)
    fps = sorted(fps) + [rng.getrandbits(64) for _ in range(50)]
    signed = [f - (1 << 64) if f >= 1 << 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "_fp long")
    want = brute_components(signed, fps)
    for limit in (4096, 4):
        comp = dict(simhash.components(simhash.links(df, 3, limit)).collect())
        groups = {}
        for f in signed:
            groups.setdefault(comp.get(f, f), set()).add(f)
        expect = {}
        for f, c in zip(signed, want):
            expect.setdefault(c, set()).add(f)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expect.values()))
