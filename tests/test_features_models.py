import struct
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from lakelens.operators import features as fx
from lakelens.operators import metrics, models, sampling
from lakelens.sources import files, generators


def test_population_scaler_and_exact_median(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (8.0,), (None,)], "x double")
    med = fx.ExactMedianImputer(inputCols=["x"], outputCols=["x"]).fit(df)
    assert med.getOrDefault(med.values) == [3.0]
    filled = med.transform(df)
    sc = fx.PopulationScaler(inputCols=["x"], outputCols=["z"]).fit(filled)
    assert sc.getOrDefault(sc.scales)[0] == pytest.approx(np.std([1, 2, 4, 8, 3]))
    const = spark.createDataFrame([(5.0,), (5.0,)], "x double")
    z = fx.PopulationScaler(inputCols=["x"], outputCols=["z"]).fit(const).transform(const)
    assert [r["z"] for r in z.collect()] == [0.0, 0.0]


def test_one_hot_unknown_and_null_all_zero(spark):
    train = spark.createDataFrame([("b",), ("a",), ("c",)], "c string")
    m = Pipeline(stages=fx.one_hot_stages(["c"])).fit(train)
    test = spark.createDataFrame([("a",), ("z",), (None,)], "c string")
    got = [r[0] for r in m.transform(test).select(vector_to_array("c_ohe")).collect()]
    assert got == [[1.0, 0.0, 0.0], [0.0, 0.0, 0.0], [0.0, 0.0, 0.0]]


def _png(path, rgb, size=4):
    raw = b"".join(b"\x00" + bytes(rgb) * size for _ in range(size))
    def chunk(t, d):
        return struct.pack(">I", len(d)) + t + d + struct.pack(">I", zlib.crc32(t + d) & 0xFFFFFFFF)
    data = (b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", size, size, 8, 2, 0, 0, 0))
            + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))
    with open(path, "wb") as f:
        f.write(data)


def test_image_features_bgr_order(spark, tmpdir_path):
    _png(f"{tmpdir_path}/house_0001.png", (255, 0, 0))      # red
    _png(f"{tmpdir_path}/house_0002.png", (128, 128, 128))  # grey
    im = files.scan_images(spark, tmpdir_path)
    f = {r["name"]: r for r in fx.image_color_features(im).withColumn("name", files.file_name(F.col("image.origin"))).collect()}
    red = f["house_0001.png"]
    assert red["mean_r"] == 1.0 and red["mean_b"] == 0.0 and red["std_r"] == 0.0
    assert f["house_0002.png"]["mean_g"] == pytest.approx(128 / 255)
    px = fx.image_normalize(im, 2).withColumn("name", files.file_name(F.col("image.origin"))) \
           .where("name = 'house_0001.png'").first()["pixels"]
    assert px[:3] == [1.0, -1.0, -1.0]
    rows = spark.createDataFrame([("images/house_0001.png",), ("images/house_0009.png",)], "img_path string")
    joined = rows.join(im.withColumn("k", files.file_name(F.col("image.origin"))),
                       files.file_name(F.col("img_path")) == F.col("k"), "left_anti")
    assert [r[0] for r in joined.collect()] == ["images/house_0009.png"]   # missing image reported


def test_ols_matches_numpy(spark):
    rng = np.random.default_rng(1)
    X = rng.normal(size=(200, 3))
    y = X @ np.array([1.5, -2.0, 0.5]) + 3.0 + rng.normal(scale=0.1, size=200)
    df = spark.createDataFrame([(float(a), float(b), float(c), float(t)) for (a, b, c), t in zip(X, y)],
                               "a double, b double, c double, y double")
    m = Pipeline(stages=[fx.assemble_features(["a", "b", "c"]), models.linear_regression("y")]).fit(df)
    coef = np.linalg.lstsq(np.c_[X, np.ones(200)], y, rcond=None)[0]
    lr = m.stages[-1]
    assert np.allclose(lr.coefficients.toArray(), coef[:3], atol=1e-6)
    assert lr.intercept == pytest.approx(coef[3], abs=1e-6)


def test_housing_signal_recovered(spark):
    h = generators.gen_housing(spark.range(3000))
    feats = list(generators.HOUSE_COEFS)
    m = Pipeline(stages=[fx.assemble_features(feats), models.linear_regression("price")]).fit(h)
    coef = dict(zip(feats, m.stages[-1].coefficients.toArray()))
    assert coef["sqft"] == pytest.approx(110, rel=0.1)
    assert coef["has_garage"] == pytest.approx(20000, rel=0.25)


def test_churn_labels_carry_no_signal_and_model_roundtrip(spark, tmpdir_path):
    c = generators.gen_churn(spark.range(2000))
    assert c.where("TotalCharges IS NULL").count() == generators.CHURN_NULLS
    c = c.withColumn("label", (F.col("Churn") == "Yes").cast("int"))
    s = sampling.stratified_split(c, "label", ["customerID"])
    tr, te = s.where("part = 'train'"), s.where("part = 'test'")
    stages = fx.column_transformer(["tenure", "MonthlyCharges", "TotalCharges"], ["Contract", "gender"])
    m = Pipeline(stages=stages + [models.logistic_regression(tr.count())]).fit(tr)
    auc = metrics.roc_auc(models.predict_proba(m.transform(te)), "label", "p1").first()["auc"]
    assert 0.35 < auc < 0.65                                   # leak detector
    files.sink_model(m, tmpdir_path + "/m")
    back = files.source_model(tmpdir_path + "/m")
    a = [r["p1"] for r in models.predict_proba(m.transform(te)).orderBy("customerID").collect()]
    b = [r["p1"] for r in models.predict_proba(back.transform(te)).orderBy("customerID").collect()]
    assert a == b


def test_csv_roundtrip_blank_lines(spark, tmpdir_path):
    p = tmpdir_path + "/h.csv"
    with open(p, "w") as f:
        f.write("a,b\n1,x\n2,y\n\n\n\n")
    assert files.scan_csv(spark, p, "a int, b string").count() == 2
    df, src = files.scan_or_generate(spark, tmpdir_path + "/absent.csv", lambda: spark.range(3))
    assert src == "generated" and df.count() == 3


def test_house_tiles_colour_tiers_and_missing_report(spark):
    from lakelens.sources import files, generators
    houses = spark.createDataFrame(
        [(1, 100.0, "images/house_0001.jpg"), (2, 300.0, "images/house_0002.jpg"),
         (3, 200.0, "a/b/HOUSE_0003.JPG")], "house_id long, price double, img_path string")
    t = generators.house_tiles(houses, size=4)
    f = {r["house_id"]: r for r in fx.image_color_features(t, bins=4).collect()}
    # cheapest: t=0 -> (r, g, b) = (30, 50, 230); dearest: t~1 -> (229, 50, 30); mid: t just under 0.5 -> (129, 229, 130)
    assert (round(f[1]["mean_r"] * 255), round(f[1]["mean_g"] * 255), round(f[1]["mean_b"] * 255)) == (30, 50, 230)
    assert (round(f[2]["mean_r"] * 255), round(f[2]["mean_b"] * 255)) == (229, 30)
    assert (round(f[3]["mean_r"] * 255), round(f[3]["mean_g"] * 255)) == (129, 229)
    assert all(f[k]["std_r"] == 0.0 for k in f)
    rows = houses.select("house_id", files.file_name("img_path").alias("file"))
    imgs = t.where("house_id != 2").select(files.file_name("image.origin").alias("file"))
    joined, missing = files.join_images(rows, imgs, "file")
    assert sorted(r["house_id"] for r in joined.collect()) == [1, 3]
    assert [r["house_id"] for r in missing.collect()] == [2]


def test_grid_search_by_fold_equals_cross_validator(spark):
    rng = np.random.default_rng(11)
    rows = []
    for i in range(240):
        x1, x2 = float(rng.normal()), float(rng.normal())
        y = int(x1 + 0.5 * x2 + rng.normal() * 0.8 > 0)
        rows.append((i, x1 if i % 17 else None, x2, ["a", "b", "c"][i % 3], y, i % 3))
    df = spark.createDataFrame(rows, "id int, x1 double, x2 double, cat string, label int, fold int")
    stages = fx.column_transformer(["x1", "x2"], ["cat"])
    lr = models.logistic_regression(160)
    maps = models.grid_maps(lr, 160, [0.1, 10.0], penalties=["l2"])
    res = models.grid_search_by_fold(stages, lr, maps, df, n_folds=3)
    from pyspark.ml.tuning import CrossValidator
    cv = CrossValidator(estimator=Pipeline(stages=stages + [lr]), estimatorParamMaps=maps,
                        evaluator=models.auc_evaluator("label"), foldCol="fold", numFolds=3).fit(df)
    assert res["avg"] == pytest.approx(list(cv.avgMetrics), abs=1e-9)
    assert res["std"] == pytest.approx(list(cv.stdMetrics), abs=1e-9)


def test_softmax_binds_what_elements_share(spark):
    """The exponentials occur once in the plan: inside a lambda they would be
    computed again for every class."""
    df = spark.createDataFrame([(1, [1.0, 3.0, 2.0]), (2, None), (3, []), (4, [0.5, None])], "id int, z array<double>")
    probs, best, conf = models.softmax_argmax(F.col("z"))
    out = df.select("id", probs.alias("p"), best.alias("b"), conf.alias("c"))
    plan = df.select(probs.alias("p"))._jdf.queryExecution().analyzed().toString().lower()
    assert plan.count("exp(") == 1 and plan.count("array_max(") == 1
    got = {r["id"]: r for r in out.collect()}
    e = np.exp(np.array([1.0, 3.0, 2.0]) - 3.0)
    assert np.allclose(got[1]["p"], e / e.sum()) and got[1]["b"] == 1 and np.isclose(got[1]["c"], 1 / e.sum())
    assert got[2]["p"] is None and got[2]["b"] is None and got[3]["p"] == [] and got[4]["p"] == [None, None]


def test_images_of_mixed_shapes_in_one_batch(spark, monkeypatch):
    """Images are worked on by shape, many a call; each comes out at its own row."""
    rng = np.random.default_rng(3)
    shapes = [(4, 6, 3), (16, 16, 3), (4, 6, 3), (5, 7, 1), (9, 3, 4), (16, 16, 3), (2, 2, 3)]
    pics = [rng.integers(0, 256, s, dtype=np.uint8) for s in shapes]
    rows = [(i, ("", *p.shape[:2], p.shape[2], 16, bytearray(p.tobytes()))) for i, p in enumerate(pics)]
    im = spark.createDataFrame(rows, "id int, image struct<origin:string,height:int,width:int,nChannels:int,mode:int,data:binary>").coalesce(1)
    f = {r["id"]: r for r in fx.image_color_features(im, bins=3).collect()}
    px = {r["id"]: r["pixels"] for r in fx.image_normalize(im, 4).collect()}
    for i, p in enumerate(pics):
        a = p.reshape(-1, p.shape[2])[:, :3].astype(float) if p.shape[2] >= 3 else np.repeat(p.reshape(-1, 1), 3, 1).astype(float)
        for ch, name in enumerate("bgr"):
            assert np.isclose(f[i][f"mean_{name}"], a[:, ch].mean() / 255) and np.isclose(f[i][f"std_{name}"], a[:, ch].std() / 255)
            want = np.histogram(a[:, ch], bins=3, range=(0, 256))[0] / len(a)
            assert np.allclose([f[i][f"hist_{name}_{k}"] for k in range(3)], want)
        h, w = p.shape[:2]
        ys, xs = np.linspace(0, h, 5).astype(int), np.linspace(0, w, 5).astype(int)
        rgb = p[:, :, :3][:, :, ::-1] if p.shape[2] >= 3 else np.repeat(p, 3, 2)
        want = [[rgb[ys[y]:max(ys[y + 1], ys[y] + 1), xs[x]:max(xs[x + 1], xs[x] + 1)].reshape(-1, 3).mean(0) for x in range(4)]
                for y in range(4)]
        assert np.allclose(px[i], (np.array(want).ravel() / 255 - 0.5) / 0.5, atol=1e-6)
    hh, ww, cc, dd = (pd.Series(x) for x in zip(*[(*p.shape, p.tobytes()) for p in pics]))
    monkeypatch.setattr(fx, "PIXEL_BYTES", 100)
    parts = [at for at, *_ in fx._same_shape(hh, ww, cc, dd)]
    assert sorted(i for at in parts for i in at) == list(range(7)) and max(map(len, parts)) == 1
    monkeypatch.setattr(fx, "PIXEL_BYTES", 1 << 22)
    assert [0, 2] in [at for at, *_ in fx._same_shape(hh, ww, cc, dd)]


def test_house_rows_are_dealt_over_all_cores(spark):
    """``part`` is one row group: without dealing its keys out one task makes every house."""
    from lakelens.plans.source_plans import housing_frame
    df = housing_frame(spark, "/root/testdata/sf0.01")
    counts = df.groupBy(F.spark_partition_id()).count().collect()
    n = sum(r["count"] for r in counts)
    assert len(counts) >= spark.sparkContext.defaultParallelism and max(r["count"] for r in counts) < 0.5 * n
