import random
from collections import Counter

import numpy as np

from lakelens.llm import decontaminate as D


def brute(rows, items, least=0.8):
    """Best weighted similarity over every item-sized window."""
    out = {}
    for i, text in rows:
        w = D.tokens(text)
        for key, t in items:
            it = D.tokens(t)
            if not w or not it:
                continue
            k = min(5, len(it))
            want = Counter(zip(*[it[j:] for j in range(k)]))
            for p in range(max(1, len(w) - len(it) + 1)):
                mine = Counter(zip(*[w[p:p + len(it)][j:] for j in range(k)]))
                both = sum((mine & want).values())
                sim = both / (sum(mine.values()) + sum(want.values()) - both)
                if sim >= least and sim > out.get((str(i), key), 0):
                    out[str(i), key] = sim
    return out


def got(df, items):
    return {(str(r["doc_id"]), r["item_id"]): r["similarity"] for r in D.matches(df, items).collect()}


def test_equals_every_window(spark, docs):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").limit(60).collect()]
    it = [(r["item_id"], r["text"]) for r in items.collect()]
    body = " ".join(f"f{i}" for i in range(80))
    words = it[3][1].split()
    near = words[:len(words) - 1] + ["changed"]
    rows += [(9001, body + " " + it[0][1] + " " + body), (9002, it[1][1].upper()), (9003, body + " " + " ".join(near)),
             (9004, " ".join(words[:len(words) // 2])), (9005, None), (9006, ""), (None, it[2][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows, it)
    assert {("9001", it[0][0]), ("9002", it[1][0]), ("None", it[2][0])} <= want.keys()
    assert got(df, items) == want
    kept = D.clean(df, items)
    assert kept.columns == df.columns
    assert {str(r["doc_id"]) for r in kept.collect()} == {str(i) for i, _ in rows} - {k for k, _ in want}


def test_short_items_parts_and_empty(spark, edge, empty, monkeypatch):
    items = spark.createDataFrame([(1, "alpha beta"), (2, None), (3, ""), (4, "alpha beta")], "item_id long, text string")
    df = spark.createDataFrame([(1, "x Alpha, beta! y"), (2, "beta alpha")], "doc_id long, text string")
    assert got(df, items) == {("1", 1): 1.0, ("1", 4): 1.0}
    monkeypatch.setattr(D, "MAX_ITEM_BYTES", 8)
    assert len(D.item_slices(items, "item_id", "text", 8)) == 3
    assert got(edge, items) == {} and got(empty, items) == {}


def test_index_is_selective_and_complete():
    """Every pair within the radius is found; under 5 % of chance pairs are looked at."""
    rng = np.random.default_rng(1)
    fps = rng.integers(0, 256, (400, 8), dtype=np.uint8)
    far = rng.integers(0, 256, (300, 8), dtype=np.uint8)
    index = D.Postings(fps, D.RADIUS)
    row, item = index.candidates(far)
    assert len(set(zip(row.tolist(), item.tolist()))) == len(row) < 0.05 * 300 * 400
    near = np.unpackbits(fps, axis=1)
    for b in near:
        b[rng.permutation(64)[:rng.integers(0, D.RADIUS + 1)]] ^= 1
    got = np.packbits(near, axis=1)
    dist = np.unpackbits(got[:, None] ^ fps[None], axis=2).sum(2)
    want = {(i, j) for i, j in zip(*np.nonzero(dist <= D.RADIUS))}
    assert len(want) >= 400 and set(zip(*(x.tolist() for x in index.within(got)))) == {(int(i), int(j)) for i, j in want}


def test_recall_over_similarity_bands_and_item_lengths():
    """Items with some words changed, inside longer texts, against every window."""
    rng = random.Random(2)
    vocab = [f"v{i}" for i in range(3000)]
    items = [(i, " ".join(rng.choices(vocab, k=n))) for i, n in enumerate([10, 15, 20, 30, 45, 60, 80, 100] * 12)]
    index = D.Index(items)
    by, found = Counter(), Counter()
    for key, text in items:
        for changes in (0, 1, 1, 2, 3):
            w = text.split()
            for _ in range(changes):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            body = " ".join(rng.choices(vocab, k=30) + w + rng.choices(vocab, k=30))
            want = brute([(1, body)], [(key, text)])
            if want:
                band = (len(w) > 40, int(want["1", key] * 20))
                by[band] += 1
                got = {x[0]: x[1] for x in index.scan(body)}
                found[band] += got.get(key) == want["1", key]
    assert sum(by.values()) >= 200 and len(by) >= 6
    assert all(found[b] >= 0.9 * by[b] for b in by), (by, found)
    assert sum(found.values()) >= 0.98 * sum(by.values())


def test_very_long_text():
    item = " ".join(f"x{i}" for i in range(40))
    text = "y z " * 200_000 + item + " y" * 1000
    assert D.Index([(7, item)]).scan(text) == [(7, 1.0, 400_000, 40)]


def test_windows_with_enough_hits():
    rng = random.Random(4)
    index = D.Index([(1, "a b c d e f g h i j")])
    for _ in range(300):
        size, m = rng.randint(1, 60), rng.randint(1, 12)
        m = min(m, size)
        full = m if rng.random() < 0.7 else m + rng.randint(0, 3)
        hits = np.array(sorted(rng.sample(range(size), rng.randint(0, size))), dtype=np.int64)
        need = 0.8 * (m + full) / 1.8 - 1e-9
        want = [p for p in range(size - m + 1) if sum(p <= h < p + m for h in hits) >= need]
        assert index._starts(hits, m, full, size - m).tolist() == want
