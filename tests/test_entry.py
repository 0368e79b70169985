import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and set(df.columns) == {"n", "mae", "rmse", "r2"}


def test_registry_consistent():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    assert len(q) >= 140


def test_small_queries_run(spark):
    q = E.queries()
    for name in ["profile_describe", "hist_by_group", "stratified_split", "roc_curve", "conversation_history",
                 "parse_reply", "vector_top_k"]:
        assert q[name](spark, "/root/testdata/sf0.001").count() >= 0
