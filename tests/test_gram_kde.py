"""Wide correlations against numpy, densities against the full kernel sum."""
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lakelens.operators import gram, profile, tables


def test_two_hundred_columns_with_nulls(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(500, 20))
    x = base @ rng.normal(size=(20, 200)) + rng.normal(size=(500, 200)) + 1e6     # far from 0: sums would cancel
    x[rng.uniform(size=x.shape) < 0.2] = np.nan
    x[:, 17] = np.where(np.isnan(x[:, 17]), np.nan, 0.1)
    x[:, 18] = np.nan
    cols = [f"v{i}" for i in range(200)]
    df = spark.createDataFrame(pd.DataFrame(x, columns=cols)).repartition(9)
    df = df.select(*[F.nanvl(c, F.lit(None).cast("double")).alias(c) for c in cols])
    out = profile.corr_matrix(df, cols)
    assert out._jdf.queryExecution().executedPlan().toString().count("Scan") == 1
    got = np.full((200, 200), np.nan)
    for r in out.collect():
        got[r["i"], r["j"]] = np.nan if r["r"] is None else r["r"]
        assert (r["col_a"], r["col_b"]) == (cols[r["i"]], cols[r["j"]])
    want = pd.DataFrame(x, columns=cols).corr(min_periods=1).to_numpy()
    want[17, :] = want[:, 17] = np.nan
    assert np.isnan(got[17]).all() and np.isnan(got[18]).all()
    np.testing.assert_allclose(got, want, atol=1e-9)


def test_wide_equals_narrow_and_handles_no_rows(spark):
    df = spark.createDataFrame([(1.0, 2, None), (2.0, 4, 1.0), (None, 5, 3.0), (4.0, 9, 0.5)], "a double, b int, c double")
    key = lambda r: (r["i"], r["j"])
    one = sorted(profile.corr_matrix(df).collect(), key=key)
    two = sorted(gram.corr_wide(df, ["a", "b", "c"]).collect(), key=key)
    assert [r[:4] for r in one] == [r[:4] for r in two]
    assert [r["r"] for r in two] == pytest.approx([r["r"] for r in one])
    assert gram.corr_wide(df.limit(0), ["a", "b", "c"]).count() == 0


@pytest.mark.parametrize("n", [40, 20_000])
def test_density_close_to_the_full_sum(spark, n):
    rng = np.random.default_rng(2)
    x = {"a": np.exp(rng.normal(size=n)), "b": rng.normal(1000, 1e-3, n)}
    df = spark.createDataFrame([(g, float(v)) for g, vs in x.items() for v in vs] + [("one", 1.0), ("same", 2.0), ("same", 2.0)],
                               "g string, x double")
    got = {}
    for r in tables.kde(df, "x", ["g"]).collect():
        got.setdefault(r["g"], {})[r["point"]] = (r["grid_x"], r["density"])
    for g, v in x.items():
        assert len(got[g]) == 1000
        h = v.std(ddof=1) * n ** -0.2
        grid = np.linspace(v.min() - np.ptp(v) / 2, v.max() + np.ptp(v) / 2, 1000)
        full = np.array([np.exp(-0.5 * ((p - v) / h) ** 2).sum() for p in grid]) / (n * h * np.sqrt(2 * np.pi))
        d = np.array([got[g][i][1] for i in range(1000)])
        np.testing.assert_allclose([got[g][i][0] for i in range(1000)], grid, rtol=1e-9)
        assert np.abs(d - full).max() < 1e-6 * max(1.0, full.max())
    assert all(d is None for g in ("one", "same") for _, d in got[g].values())
