import hashlib
import random
from collections import Counter

import numpy as np

from lakelens.llm import suffix


def brute(rows, length):
    seen = Counter()
    for _, t in rows:
        b = (t or "").encode()
        seen.update(b[k:k + length] for k in range(len(b) - length + 1))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        cover = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if seen[b[k:k + length]] > 1:
                cover[k:k + length] = b"\1" * length
        kept = bytes(x for x, c in zip(b, cover) if not c)
        runs = sum(c and (k == 0 or not cover[k - 1]) for k, c in enumerate(cover))
        out.append((str(i), len(b), sum(cover), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def got(df, length=suffix.LENGTH):
    return sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
                  for r in suffix.repeats(df, length=length).collect())


def test_equals_brute_force(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    want = brute(rows, 200)
    assert sum(w[2] for w in want) > 0 and got(docs) == want


def test_edge_rows(spark, edge):
    rows = [(r["doc_id"], r["text"]) for r in edge.select("doc_id", "text").collect() if len(r["text"] or "") < 9000]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(df) == brute(rows, 200)


def test_shared_passages_and_periods(spark, monkeypatch):
    rng = random.Random(9)
    word = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    p, q = word(260), word(201)
    rows = [(1, word(500) + p + word(300)), (2, p), (3, word(90) + p[:199] + word(200)), (4, word(10) + q + word(10) + q),
            (5, "ab" * 300), (6, "a" * 199), (7, "z" * 201), (8, p[30:240] + word(5)), (9, word(700)), (10, None)]
    rows += [(20 + i, word(40 + i) + q[:200] + word(30)) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows, 200)
    assert got(df) == want
    for hot in (12, 6, 1):      # anchors with many contexts fall apart into parts, groups into strings
        monkeypatch.setattr(suffix, "HOT", hot)
        assert got(df) == want


def test_hot_groups_equal_brute_force(spark, monkeypatch):
    """A passage in many documents, byte-equal parts, near copies, edges of every kind."""
    rng = random.Random(11)
    word = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    p, long = word(420), word(900)
    rows = [(i, word(rng.randint(0, 60)) + p[rng.randint(0, 20):rng.randint(330, 420)] + word(rng.randint(0, 60))) for i in range(60)]
    for i in range(40):         # near copies: one byte differs
        k = rng.randrange(900)
        rows.append((100 + i, long[:k] + "X" + long[k + 1:]))
    rows += [(200, "q" * 2000), (201, "q" * 1999 + "r"), (202, "pq" * 700)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows, 200)
    for hot in (512, 20, 3):
        monkeypatch.setattr(suffix, "HOT", hot)
        assert got(df) == want


def test_hot_anchors_give_one_span_a_place(spark, monkeypatch):
    """A passage in many documents with different bytes about it: the joins make at
    most one row for each place of a common anchor, however many strings repeat there."""
    rng = random.Random(13)
    word = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    p = word(300)
    df = spark.createDataFrame([(i, word(30 + i) + p + word(80)) for i in range(40)], "doc_id long, text string")
    for hot in (12, 1):
        monkeypatch.setattr(suffix, "HOT", hot)
        texts = suffix.keyed_texts(df, "doc_id", "text")
        per, any_hot = suffix.repeated_anchors(texts, 200)
        places = per.selectExpr("sum(size(filter(_anchors, a -> a._hot)))").first()[0]
        spans = suffix._hot_spans(suffix.distinct_texts(texts).join(per, "_key"), 200)
        assert any_hot and 0 < spans.count() <= places
        assert spans.select("_key").distinct().count() == 40


def test_parts_cover_each_string_once():
    rng = random.Random(5)
    for _ in range(300):
        off = rng.randint(0, 168)
        place = rng.randint(off, 168)
        first = rng.randint(0, 5)
        text = bytes(first + off + 200 + rng.randint(0, 9))
        starts = []
        for j, a, e, at, core in suffix.cut_parts(text, first << 24 | off << 12 | place, 200):
            own = range(a, e - 199)
            starts += own
            assert a + at == first + place and all((first + place - x) // suffix.RANGE == j for x in own)
            assert all(x <= a + core and a + core + 200 - suffix.RANGE + 1 <= x + 200 for x in own)
        assert sorted(starts) == list(range(first, first + off + 1))


def test_very_long_text(spark):
    rng = random.Random(8)
    body = "".join(rng.choice("abcdefgh ") for _ in range(150_000))
    rows = [(1, body), (2, body[70_000:70_500]), (3, body[:100] + "!" + body[101:400])]
    out = {r["doc_id"]: r for r in suffix.repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[1]["n_removed"] == 500 + 299 and out[1]["n_spans"] == 2
    assert (out[2]["n_removed"], out[3]["n_removed"]) == (500, 299)


def test_suffix_array():
    rng = random.Random(2)
    for _ in range(500):
        t = bytes(rng.randrange(rng.choice([1, 2, 4])) for _ in range(rng.randint(0, 60)))
        assert suffix.suffix_array(t) == sorted(range(len(t)), key=lambda i: t[i:])
    x = np.array([rng.randrange(300) for _ in range(400)] * 2)
    assert suffix.suffix_array(x) == sorted(range(800), key=lambda i: x[i:].tolist())


def test_empty(empty):
    assert suffix.repeats(empty).count() == 0
