from collections import Counter

import corpus_pipeline as P

from .test_decontaminate import brute
from .test_simhash import brute_components, brute_fp

SF = "/root/testdata/sf0.001"


def test_stages_keep_what_they_should(spark, docs):
    assert [n for n, _ in P.STAGES] == ["toxicity", "near_duplicates", "decontamination", "source_mix", "sharding"]
    small = docs.filter("doc_id < 90")
    toxic = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").filter("toxic = 1").collect()}
    kept = P.drop_toxic(spark, docs, SF)
    assert kept.columns == docs.columns
    left = {r["doc_id"] for r in kept.collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    assert left == {r["doc_id"] for r in P.toxicity.toxicity(docs, labels).filter("predicted = 0").collect()}
    clean = {r["doc_id"] for r in labels.filter("toxic = 0").collect()} & {r["doc_id"] for r in docs.collect()}
    assert clean <= left and len(toxic & left) < len(toxic) / 2     # ten toxic texts to learn from

    rows = [(r["doc_id"], r["text"]) for r in small.collect()]
    comp = brute_components([i for i, _ in rows], [brute_fp(t) for _, t in rows])
    out = P.drop_near_duplicates(spark, small, SF)
    assert out.columns == docs.columns
    assert {r["doc_id"] for r in out.collect()} == {i for (i, _), c in zip(rows, comp) if i == c}

    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaks = {k for k, _ in brute(rows[:40], items)}
    out = P.drop_benchmark(spark, docs.filter(docs.doc_id.isin([i for i, _ in rows[:40]])), SF)
    assert {str(r["doc_id"]) for r in out.collect()} == {str(i) for i, _ in rows[:40]} - leaks

    mixed = P.mix_sources(spark, small, SF)
    assert mixed.columns == docs.columns
    want = {r["doc_id"]: r["copies"] for r in P.mixing.mix(small).collect() if r["copies"]}
    assert Counter(r["doc_id"] for r in mixed.collect()) == Counter(want)


CLASH = ("doc_id long, text string, lang string, source string, n_chars long, _copies int, _time string, _rows int, "
         "_mix_id long, _id string, _text string, _row long, _doc string, component_id long, `a.b` int, size long, shard int")


def test_clashing_columns_and_rows_one_by_one(spark):
    text = "the same words stand in this text and in its copy too"
    rows = [(1, text), (1, text), (None, text), (None, "a text of its own without any id"), (None, None), (2, None), (2, "other words, same id"),
            (3, "long " + "word run " * 30_000), (4, ""), (5, text)]
    extra = (7, "t", 8, 9, "i", "x", 10, "d", 11, 12, 13, 14)
    df = spark.createDataFrame([(i, t, "en", "s", 1, *extra) for i, t in rows], CLASH)
    out = P.drop_near_duplicates(spark, df, SF)
    assert out.columns == df.columns
    # one of the four copies (the smallest id), one of the three wordless texts, and the rest
    left = sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str)
    assert left == sorted([(1, text), (None, rows[3][1]), (2, None), (2, rows[6][1]), (3, rows[7][1])], key=str)
    mixed = P.mix_sources(spark, df, SF)
    assert mixed.columns == df.columns and {tuple(r)[5:] for r in mixed.collect()} == {extra}
    assert mixed.count() > 0
    for _, stage in P.STAGES[:3]:
        assert stage(spark, df, SF).columns == df.columns
    sharded = P.assign_shards(spark, df, SF)
    assert sharded.count() == len(rows)


def test_empty_and_edge(spark, empty, edge):
    for df in (empty, edge):
        n = df.count()
        every = [tuple(r) for r in df.collect()]
        for name, stage in P.STAGES:
            out = stage(spark, df, SF)
            rows = [tuple(r) for r in out.collect()]
            assert (len(rows) == 0) == (n == 0)
            if name != "sharding":
                assert out.columns == df.columns and set(rows) <= set(every)
            if name in ("toxicity", "decontamination"):
                assert not Counter(rows) - Counter(every)
            if name == "near_duplicates":
                comp = brute_components(list(range(n)), [brute_fp(r[1]) for r in every])
                assert len(rows) == len(set(comp))
