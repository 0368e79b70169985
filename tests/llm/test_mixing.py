from collections import Counter, defaultdict

from lakelens.llm import mixing


def brute_targets(total):
    order = sorted(total, key=lambda s: (s is None, (s or "").encode()))
    w = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}
    want, left, open_ = dict.fromkeys(order, 0.0), 1.5 * sum(total.values()), set(order)
    while left > 1e-9 and open_:
        per = left / sum(w[s] for s in open_)
        left = 0.0
        for s in sorted(open_, key=order.index):
            want[s] += per * w[s]
        for s in list(open_):
            if want[s] >= 2 * total[s]:
                left += want[s] - 2 * total[s]
                want[s] = 2.0 * total[s]
                open_.discard(s)
    return want


def check(df):
    rows = mixing.mix(df).collect()
    texts = Counter((r["doc_id"], len((r["text"] or "").encode().split())) for r in df.collect())
    assert Counter((r["doc_id"], r["size"]) for r in rows) == texts
    total, taken, big = Counter(), Counter(), defaultdict(int)
    for r in rows:
        total[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        big[r["source"]] = max(big[r["source"]], r["size"])
        assert r["taken"] == r["copies"] * r["size"] <= 2 * r["size"]
    want = brute_targets(total)
    for r in rows:
        assert r["source_size"] == total[r["source"]]
        assert abs(r["target"] - want[r["source"]]) < 1e-6 * max(1, want[r["source"]])
    for s in total:     # within half of the document at the cut
        assert abs(taken[s] - want[s]) <= big[s] / 2 + 1e-6
    return rows


def test_targets_and_fill(docs):
    a = check(docs)
    b = mixing.mix(docs.repartition(5)).collect()
    assert sorted(map(str, a)) == sorted(map(str, b))       # reruns agree


def test_edge_rows(edge):
    check(edge)


def test_empty(empty):
    assert mixing.mix(empty).count() == 0


def test_larger_documents_are_likelier(spark):
    df = spark.createDataFrame([(i, "w " * (400 if i % 2 else 100), "a" if i < 2000 else "b") for i in range(2600)],
                               "doc_id long, text string, source string")
    rows = [r for r in mixing.mix(df).collect() if r["source"] == "a"]
    more = [sum(r["copies"] for r in rows if (r["size"] == s)) / sum(r["size"] == s for r in rows) for s in (100, 400)]
    assert more[1] > more[0]
