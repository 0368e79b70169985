import re

from lakelens.llm import licenses as L


def words(t):
    return [w for w in re.split(r"[^\w]+|_", (t or "").lower()) if w]


def shingles(w, k):
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))}


def brute(rows, templates, share=L.CONTAINMENT):
    """Exact containment of every template in every window of every text."""
    out = {}
    for i, text in rows:
        w = words(text)
        for name, t in templates.items():
            tw = words(t)
            n, k = len(tw), min(L.SHINGLE, len(tw))
            ts = shingles(tw, k)
            got = [(len(ts & shingles(w[j:j + 2 * n], k)) / len(ts), j) for j in range(0, len(w), n)]
            hit = [(c, j) for c, j in got if c >= share]
            if hit:
                out[str(i), name] = (round(max(c for c, _ in hit), 9), min(j for _, j in hit), len(hit))
    return out


def got(spark, df, templates=L.TEMPLATES):
    rows = L.scan(df, L.template_table(spark, templates)).collect()
    return {(str(r["doc_id"]), r["license"]): (round(r["containment"], 9), r["first_word"], r["n_windows"]) for r in rows}


def test_equals_brute_force(spark, docs):
    want = brute([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()], L.TEMPLATES)
    assert want and got(spark, docs) == want


def test_edits_edges_and_whole_texts(spark, edge):
    mit = L.TEMPLATES["mit-grant"]
    filler = " ".join(f"x{i}" for i in range(3000))
    rows = [(1, mit), (2, filler + " " + mit.upper() + " " + filler), (3, mit.replace("free of charge", "at no cost")),
            (4, " ".join(mit.split()[:12])), (5, "all RIGHTS\n reserved"), (6, None), (7, ""), (8, mit + " " + mit), (None, mit)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows, L.TEMPLATES)
    assert {k for k in want if k[1] == "mit-grant"} == {(x, "mit-grant") for x in ("1", "2", "3", "8", "None")} - {
        k for k in {("3", "mit-grant")} if k not in want}
    assert got(spark, df) == want
    assert got(spark, edge) == {}


def test_short_templates(spark):
    df = spark.createDataFrame([(1, "the word copyleft stands here"), (2, "nothing")], "doc_id long, text string")
    assert set(got(spark, df, {"one": "Copyleft"})) == {("1", "one")}


def test_bands_guarantee_collision():
    for n in (3, 5, 7, 12, 30):
        b, r = L.band_settings(n)
        k = min(L.SHINGLE, n)
        j = 0.8 * (n - k + 1) / (2 * n - k + 1 + 0.2 * (n - k + 1))
        assert (1 - j ** r) ** b <= L.MISS and (b <= L.MAX_BANDS or r == 1)


def test_native_plan_and_empty(spark, docs, empty):
    df = L.scan(docs, L.template_table(spark))
    assert not any(x in df._jdf.queryExecution().executedPlan().toString() for x in ("Python", "Arrow", "Cartesian"))
    assert L.scan(empty, L.template_table(spark)).count() == 0
