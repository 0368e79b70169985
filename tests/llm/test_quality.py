import duckdb

from lakelens.llm import quality


def rows_of(df):
    cols = sorted(df.columns)
    return sorted(str(tuple(r[c] for c in cols)) for r in df.collect())


def test_equals_sql(spark, edge, docs):
    for df in (edge.drop("_id", "_text"), docs):
        documents = df.toPandas()  # noqa: F841  (DuckDB reads it by name)
        cur = duckdb.sql(quality.oracle_sql())
        cols = cur.columns
        order = sorted(range(len(cols)), key=lambda i: cols[i])

        def norm(v):
            return None if isinstance(v, float) and v != v else int(v) if isinstance(v, float) else v
        want = sorted(str(tuple(norm(r[i]) for i in order)) for r in cur.fetchall())
        assert rows_of(quality.quality(df)) == want


def test_repeated_windows_cover_words(spark):
    def n(text):
        return quality.quality(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    a = "a b c d e x a b c d e y"
    assert n(a)["n_repeat_words"] == 10
    assert n("a a a a a a a")["n_repeat_words"] == 7      # overlapping windows count once
    assert n("a b c d e f g h i j")["n_repeat_words"] == 0
    assert n(a)["base_failed"] and not n(a)["kept"]


def test_native_plan(docs):
    plan = quality.quality(docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Exchange", "Generate"))


def test_empty(empty):
    assert quality.quality(empty).count() == 0
