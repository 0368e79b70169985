"""Exact quantiles by bracket and count: equal to numpy where brackets are in use."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from lakelens.functions import keys
from lakelens.functions.keys import exact_quantiles


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_bracketed_groups_equal_numpy(spark, monkeypatch, limit):
    monkeypatch.setattr(keys, "SKETCH_ROWS", 200)
    monkeypatch.setattr(keys, "SKETCH", 500)
    monkeypatch.setattr(keys, "BRACKET_ROWS", limit)
    rng = np.random.default_rng(1)
    data = {"normal": rng.normal(size=30_000), "ties": rng.integers(0, 5, 20_000).astype(float),
            "hot": np.concatenate([np.full(15_000, 7.0), rng.normal(7, 1, 5_000)]),
            "skewed": np.exp(rng.normal(0, 4, 10_000)), "few": rng.normal(size=150), "one": np.array([3.0]),
            "same": np.full(4_000, -2.0), None: rng.normal(size=5_000)}
    rows = [(g, float(x)) for g, xs in data.items() for x in xs] + [("few", None), ("none", None)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(7)
    probs = [0.0, 0.001, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = {r["g"]: r for r in exact_quantiles(df, "x", probs, ["g"], names=[f"p{i}" for i in range(7)]).collect()}
    assert set(got) == set(data)
    for g, xs in data.items():
        for i, p in enumerate(probs):
            assert got[g][f"p{i}"] == pytest.approx(np.quantile(xs, p), rel=1e-12, abs=1e-12), (g, p)
    row = exact_quantiles(df.where("g = 'normal'"), "x", [0.25, 0.5]).first()
    assert row["q50"] == pytest.approx(np.median(data["normal"]))


def test_brackets_keep_few_values(spark, monkeypatch):
    """The rows that leave the second pass are far fewer than the distinct values."""
    import lakelens.session as session
    kept = []
    real = session.stage_table

    def spy(df, name):
        out = real(df, name)
        if name == "quantile-brackets":
            kept.append(out.count())
        return out
    monkeypatch.setattr(session, "stage_table", spy)
    df = spark.range(400_000).select((F.xxhash64("id") / 1e9).alias("x"))
    want = np.quantile(np.array([r[0] for r in df.collect()]), [0.25, 0.5, 0.75])
    got = exact_quantiles(df, "x", [0.25, 0.5, 0.75]).first()
    assert [got["q25"], got["q50"], got["q75"]] == pytest.approx(want.tolist(), rel=1e-12)
    assert kept and kept[0] < 4_000


def test_no_rows(spark):
    df = spark.createDataFrame([], "g string, x double")
    assert exact_quantiles(df, "x", [0.5], ["g"]).count() == 0
