"""Ranked search: equal to scoring every document, stopping rule, edge rows."""
import duckdb
import numpy as np
import pytest

from lakelens.llm import ranked

DOCS = "doc_id long, text string, lang string, _id string, _text string, _n string, _t string, item_id long, score string"
ITEMS = "item_id long, text string, _no string, _item string, doc_id long"


def both(spark, docs, items, top=50, **kw):
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.execute("create table benchmark (item_id bigint, text varchar)")
    if docs:
        con.executemany("insert into documents values (?, ?)", docs)
    if items:
        con.executemany("insert into benchmark values (?, ?)", items)
    want = con.execute(ranked.oracle_sql(top)).fetchall()
    d = spark.createDataFrame([(i, t, "en", "a", "b", "c", "d", 9, "e") for i, t in docs], DOCS)
    i = spark.createDataFrame([(i, t, "a", "b", 3) for i, t in items], ITEMS)
    got = [tuple(r) for r in ranked.search(d.repartition(5), i, top=top, **kw).collect()]
    return sorted(got, key=str), sorted(want, key=str)


@pytest.mark.parametrize("top, passes", [(50, 2000), (3, 4)])
def test_equals_scoring_everything(spark, top, passes):
    rng = np.random.default_rng(1)
    vocab = [f"w{i}" for i in range(60)] + ["Été", "東京", "naïve", "A1"]
    zipf = 1 / np.arange(1, len(vocab) + 1)
    text = lambda n: " ".join(rng.choice(vocab, size=n, p=zipf / zipf.sum()))
    docs = [(i, text(int(rng.choice([1, 3, 20, 200])))) for i in range(400)]
    docs += [(7, docs[3][1])] * 3 + [(500 + i, "w1 w2") for i in range(120)]               # repeats, ties
    docs += [(None, "w1 W2 w3"), (None, None), (900, None), (901, ""), (902, " .,;\t\n"), (903, text(50_000)),
             (904, "été,東京;W1-w2_w3\x00w4\x7fw5 ÉTÉ")]
    items = [(i, text(int(rng.choice([1, 4, 30])))) for i in range(12)]
    items += [(20, None), (21, ""), (22, "... !"), (23, "unknownterm"), (None, "w3 w4"), (5, "w5 W5 w5"), (5, "w5 W5 w5")]
    got, want = both(spark, docs, items, top=top, items_per_pass=passes)
    assert got == want
    assert {r[0] for r in got} >= {None, 5} and not {r[0] for r in got} & {20, 21, 22, 23}


def test_empty_tables(spark):
    assert both(spark, [], [(1, "a b")]) == ([], [])
    assert both(spark, [(1, "a b")], []) == ([], [])
    assert both(spark, [(1, None), (2, "!")], [(1, "a b")]) == ([], [])


def test_stops_early_and_only_below_kth():
    """Documents that lead every list end the reading; equal scores do not."""
    rng = np.random.default_rng(2)
    n_docs, n_terms = 20_000, 4
    f = rng.integers(1, 3, size=(n_docs, n_terms))
    f[:10] = 400
    row, t = np.repeat(np.arange(n_docs), n_terms), np.tile(np.arange(n_terms), n_docs)
    n = f.sum(1) + 50
    n[:10] = 1600
    lists = ranked.Lists(n, t, f.ravel(), row, np.full(n_terms, 7), n_docs, int(n.sum()))
    rows, scores, read = ranked.best_positions(lists, list(range(n_terms)), n_docs, 5)
    m = 50 + (50 * n * n_docs) // int(n.sum())
    whole = (7 * ((1_000_000_000 * f) // (1000 * f + 20 * m[:, None]))).sum(1)
    assert read < n_docs * n_terms / 20
    assert set(range(10)) <= set(rows.tolist()) and (whole[rows] == scores).all()
    # all documents equal: the kth score is never strictly above the bound, so every tie is found
    same = ranked.Lists(np.full(300, 9), t[:1200], np.full(1200, 2), row[:1200], np.full(n_terms, 7), 300, 2700)
    rows, _, _ = ranked.best_positions(same, list(range(n_terms)), 300, 5)
    assert sorted(rows.tolist()) == list(range(300))


def test_best_positions_pass_last_read_ones():
    """A direct access that closes a gap moves the best position beyond what was read."""
    f = np.array([[9, 1], [8, 9], [7, 8], [1, 7]])
    row, t = np.repeat(np.arange(4), 2), np.tile(np.arange(2), 4)
    lists = ranked.Lists(np.full(4, 20), t, f.ravel(), row, np.array([5, 5]), 4, 80)
    _, _, read = ranked.best_positions(lists, [0, 1], 4, 2, step=1)
    assert read <= 4            # two turns: rows 0, 1 read, row 2 last; last-read positions would need a third
