import random
import zlib

from lakelens.llm import toxicity


def corpus(n=900):
    rng = random.Random(4)
    vocab = [f"word{i}" for i in range(300)]
    bad = ["scoundrel", "rotter", "blackguard"]
    docs, labels = [], []
    for i in range(n):
        w = [rng.choice(vocab) for _ in range(rng.randint(10, 80))]
        y = i % 5 == 0
        for _ in range(rng.randint(1, 3) if y else 0):
            w.insert(rng.randrange(len(w)), rng.choice(bad))
        docs.append((i, " ".join(w)))
        labels.append((i, int(y)))
    return docs, labels


def test_held_out_accuracy(spark):
    d, y = corpus()
    out = toxicity.toxicity(spark.createDataFrame(d, "doc_id long, text string"),
                            spark.createDataFrame(y, "doc_id long, toxic int")).collect()
    truth = dict(y)
    held = [r for r in out if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i, _ in d if zlib.crc32(str(i).encode()) % 5 == 0}
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in out)


def test_pairs_count(spark):
    rows = []       # either word alone is clean, both together are not
    rng = random.Random(1)
    for i in range(1200):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        words = [f"n{rng.randrange(40)}" for _ in range(8)] + ["insult"] * a + ["group"] * b
        rows.append((toxicity.terms(" ".join(words)), int(a and b)))
    m = toxicity.train(rows, 0.25)
    score = [1 / (1 + 2.718281828 ** -m.margin(toxicity.terms(t))) for t in ("insult", "group", "insult group", "")]
    assert max(score[0], score[1], score[3]) < 0.5 < score[2]


def test_pairs_without_marginal_effect():
    """Every group word is as frequent in both labels, and so is every insult:
    only who is insulted how tells the labels apart."""
    rng = random.Random(7)
    rows = []
    for i in range(1200):
        a, b = rng.randrange(2), rng.randrange(2)
        words = [f"n{rng.randrange(40)}" for _ in range(8)] + [("rotter", "cad")[a], ("north", "south")[b]]
        rows.append((toxicity.terms(" ".join(words)), int(a == b)))
    m = toxicity.train(rows, 0.5)
    held = [(a, b, m.margin(toxicity.terms(f"n1 n2 {a} {b}")))
            for a in ("rotter", "cad") for b in ("north", "south")]
    assert all((x > 0) == ((a, b) in (("rotter", "north"), ("cad", "south"))) for a, b, x in held)


def test_rare_terms_of_one_label_are_learnt():
    """Eight toxic texts and no clean one hold each of these words."""
    rng = random.Random(3)
    vocab = [f"word{i}" for i in range(2000)]
    rows = []
    for i in range(480):
        rows.append((toxicity.terms(" ".join(rng.choices(vocab, k=60) + [f"{i % 60}slur"])), 1))
        rows.append((toxicity.terms(" ".join(rng.choices(vocab, k=60))), 0))
    m = toxicity.train(rows, 0.5)
    assert all(m.margin(toxicity.terms(f"word1 word2 word3 {i}slur")) > 0 for i in range(60))
    assert m.margin(toxicity.terms("word5 word6 word7")) < 0


def test_edge_rows_and_empty(spark, edge, empty):
    labels = spark.createDataFrame([(5, 1), (5, 0), (6, None), (None, 1), (8, 0), (9, 0)], "doc_id long, toxic int")
    assert toxicity.toxicity(edge, labels).count() == edge.count()
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert all(r["predicted"] == 0 for r in toxicity.toxicity(edge, none).collect())
    assert toxicity.toxicity(empty, none).count() == 0


def sampled(sf):
    import pyarrow.parquet as pq
    docs = pq.read_table(f"/root/testdata/{sf}/documents.parquet", columns=["doc_id", "text"]).to_pydict()
    text = dict(zip(docs["doc_id"], docs["text"]))
    labels = pq.read_table(f"/root/testdata/{sf}/labels.parquet").to_pydict()
    y = {i: t for i, t in zip(labels["doc_id"], labels["toxic"]) if i in text}
    out = [[], []]
    for i in sorted(y):
        out[zlib.crc32(str(i).encode()) % 5 == 0].append((toxicity.terms(text[i]), y[i]))
    return out[0], out[1], sum(y.values()) / len(y)


def test_vectors_are_trained_on_the_tables():
    """The pairs take part: no vector table of zeros, other scores without them,
    and no worse than the weights alone."""
    import numpy as np
    for sf in ("sf0.01", "sf0.1"):
        rows, held, share = sampled(sf)
        m = toxicity.train(rows, share)
        assert np.abs(m.factors).max() > 0.05
        found, y = [t for t, _ in held], np.array([k for _, k in held])
        plain = toxicity.Model(m.keys, m.bias, m.linear, np.zeros_like(m.factors))
        mixed = toxicity.Model(m.keys, m.bias, m.linear, np.random.default_rng(1).permutation(m.factors))
        full = m.margins(found)
        assert np.abs(full - plain.margins(found)).max() > 1e-3 and np.abs(full - mixed.margins(found)).max() > 1e-3
        loss = lambda x: np.logaddexp(0, np.where(y == 1, -x, x)).mean()
        assert ((full >= 0) == y).mean() >= ((plain.margins(found) >= 0) == y).mean() and loss(full) <= loss(plain.margins(found)) * 1.02
        assert ((full >= 0) == y).mean() > 0.95


def test_at_least_one_epoch(monkeypatch):
    import numpy as np
    rows = [(toxicity.terms(f"a b c {i % 7}" + " bad" * (i % 2)), i % 2) for i in range(60)]
    keys = np.unique(np.concatenate([r for r, _ in rows]))
    docs = [np.searchsorted(keys, r) for r, _ in rows]
    y = np.array([k for _, k in rows], dtype=float)
    assert toxicity._best_epochs(docs, y, len(keys), 4, 6, 1) >= 1
    assert toxicity._best_epochs(docs[:2], y[:2], len(keys), 4, 6, 1) == 6


def test_batches_score_as_single_texts():
    rows, _, share = sampled("sf0.001")
    m = toxicity.train(rows, share)
    texts = ["", None, "some words", "x" * 50_000, "some words", "word " * 3000]
    assert m.scores(texts).tolist() == [m.score(t) for t in texts]
    assert m.scores([]).tolist() == []
