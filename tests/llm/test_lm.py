import math
import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from lakelens.llm import lm


def toks(t):
    return [*(t or "").encode().lower().split(), None]


def check(df, **kw):
    src = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    held = lambda i: i is None or zlib.crc32(str(i).encode()) % 10 == 0
    c = Counter(w for i, t in src if not held(i) for w in toks(t))
    n, v = sum(c.values()), len(c)
    want = sorted((str(i), held(i), len(toks(t)), sum(c[w] > 0 for w in toks(t)), n,
                   round(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in toks(t)), 4)) for i, t in src)
    rows = lm.scores(df, **kw).collect()
    got = sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"],
                  round(r["base_score"], 4)) for r in rows)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert all(abs(a[5] - b[5]) < 1e-2 for a, b in zip(got, want))
    assert all(math.isfinite(r["score"]) and r["score"] <= 0 for r in rows)
    return rows


def test_base_scores_and_model(docs):
    rows = check(docs)
    held = [r for r in rows if r["held_out"]]
    # on held-out texts the model with bigrams is not far from the base, on training texts above it
    assert sum(r["score"] for r in held) > 1.1 * sum(r["base_score"] for r in held)
    seen = [r for r in rows if not r["held_out"]]
    assert sum(r["score"] for r in seen) > sum(r["base_score"] for r in seen)


def test_edge_rows_and_repeated_tables(edge):
    check(edge)
    check(edge.unionByName(edge))


def test_slices_score_the_same(docs):
    one, many = ({(r["doc_id"], round(r["score"], 9)) for r in lm.scores(docs, slice_bytes=n, bucket_bytes=50_000).collect()}
                 for n in (1 << 30, 20_000))
    assert one == many
    counted = lm.staged(lm.count(lm._rows(docs, "doc_id", "text"), 10), "t")
    assert len(lm.filter_slices(counted, 10, 20_000)) > 1


def test_empty(empty):
    assert lm.scores(empty).count() == 0


def test_filter_returns_levels():
    rng = np.random.default_rng(3)
    keys = np.unique(rng.integers(0, 1 << 63, 20_000, dtype=np.uint64))
    counts = rng.integers(1, 1000, len(keys))
    order = np.argsort(lm._bucket(keys, 4), kind="stable")
    seg = [lm.segment(k, c) for _, k, c in lm._split(keys, counts, 4)]
    f = lm.Filter(4, 0, seg)
    got = f.levels(keys)
    assert (got >= lm.quantise(counts)).all()           # never less
    assert (got == lm.quantise(counts)).mean() > 0.95
    assert (f.levels(rng.integers(0, 1 << 63, 20_000, dtype=np.uint64)) > 0).mean() < 0.03
    assert len(order) == len(keys)
    assert lm.quantise(np.array([1, 2, 3, 4, 7, 8])).tolist() == [1, 2, 2, 3, 3, 4]


def test_packed_rows_are_sent_in_bounded_batches():
    made = []

    def rows():
        for i in range(100):
            made.append(i)
            yield i, bytes([i]) * 100_000
    got, held = [], []
    for b in lm.packed(rows(), [("_b", pa.int64()), ("_k", pa.binary())]):
        held.append(len(made) - len(got))       # rows made and not yet sent
        got += list(zip(*(c.to_pylist() for c in b.columns)))
    assert got == [(i, bytes([i]) * 100_000) for i in range(100)]
    assert max(held) * 100_000 < lm.SEND_BYTES + 100_000
    assert list(lm.packed(iter([]), [("_b", pa.int64())])) == []


def test_a_segment_holds_one_probe_at_a_time():
    keys = np.unique(np.random.default_rng(5).integers(0, 1 << 63, 200_000, dtype=np.uint64))
    tracemalloc.start()
    try:
        lm.segment(keys, np.ones(len(keys), np.int64))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 80 * len(keys)


def test_totals_add_equal_keys():
    keys = [np.array([7, 1, 1 << 63], np.uint64), np.zeros(0, np.uint64), np.array([1, 9], np.uint64)]
    n = [np.array([1, 2 ** 32 - 1, 3], np.uint32), np.zeros(0, np.uint32), np.array([2 ** 32 - 1, 4], np.uint32)]
    k, c = lm._total(keys, n)
    assert k.tolist() == [1, 7, 9, 1 << 63] and c.tolist() == [2 ** 33 - 2, 1, 4, 3]
    assert [x.tolist() for x in lm._total([], [])] == [[], []]


def test_tokens_of_many_texts_are_those_of_each():
    rng = random.Random(1)
    texts = [bytes(rng.choice(b"aZ \t\x0b\xff\x00\xc3\n@[`{") for _ in range(rng.choice([0, 1, 3, 8, 9, 31, 32, 33, 64, 200])))
             for _ in range(300)] + [None, b"", b" "] + [b"Q" * n for n in range(70)]
    for part in (pa.array(texts, pa.binary()), pa.array(texts, pa.binary()).slice(7, 100), pa.array([None], pa.binary())):
        held = [lm.tokens(x.as_py()) for x in part]
        t, first = lm.gathered(part)
        assert t.tolist() == np.concatenate(held).tolist()
        assert first.tolist() == np.cumsum([0, *map(len, held)])[:-1].tolist()
        assert [at for at, _, _ in lm.chunks(part, 1)][:2] == list(range(len(part)))[:2]


def test_slices_answer_in_blocks_of_texts(docs, monkeypatch):
    """One stored answer a block and slice, not one a text."""
    stored, keep = [], lm.staged

    def staged(df, name):
        got = keep(df, name)
        stored.extend([got] if name == "lm-codes" else [])
        return got
    monkeypatch.setattr(lm, "staged", staged)
    some = docs.coalesce(1)
    assert lm.scores(some, slice_bytes=20_000, bucket_bytes=50_000).count() == some.count()
    assert len(stored) > 1 and all(s.count() < some.count() / 10 for s in stored)
