"""§2.11 feature work: scaling, imputing and one-hot inside Spark ML pipelines,
feature names, text features and image colour features.

Two small pure-Python pipeline stages fill gaps in Spark ML with exact
statistics: ``ExactMedianImputer`` (Spark's Imputer median is approximate)
and ``PopulationScaler`` (Spark's StandardScaler divides by the sample std).
Both fit with one distributed aggregate and apply as column expressions;
both save and load inside a PipelineModel.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import (IDF, CountVectorizer, HashingTF, OneHotEncoder, RegexTokenizer,
                                StringIndexer, VectorAssembler)
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.common import FLOAT_TYPES
from ..session import stage_table


class _HasValues(Params):
    values = Param(Params._dummy(), "values", "fitted statistics, one per input column",
                   typeConverter=TypeConverters.toListFloat)
    scales = Param(Params._dummy(), "scales", "fitted scales, one per input column",
                   typeConverter=TypeConverters.toListFloat)


class ExactMedianImputerModel(Model, HasInputCols, HasOutputCols, _HasValues,
                              DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, inputCols=None, outputCols=None, values=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        fl = {f.name for f in df.schema.fields if isinstance(f.dataType, FLOAT_TYPES)}
        exprs = {}
        for c, o, v in zip(self.getInputCols(), self.getOutputCols(), self.getOrDefault(self.values)):
            x = F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) if c in fl else F.col(c).cast("double")
            exprs[o] = F.coalesce(x, F.lit(v))
        return df.withColumns(exprs)


class ExactMedianImputer(Estimator, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Numeric NULL/NaN -> exact median learned on the fitting frame."""
    @keyword_only
    def __init__(self, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> ExactMedianImputerModel:
        from .clean import median_stats
        cols = self.getInputCols()
        rows = {r["column"]: r["median"] for r in median_stats(df, cols).collect()}
        vals = [float(rows.get(c)) if rows.get(c) is not None else 0.0 for c in cols]
        return ExactMedianImputerModel(inputCols=cols, outputCols=self.getOutputCols(), values=vals)


class PopulationScalerModel(Model, HasInputCols, HasOutputCols, _HasValues,
                            DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, inputCols=None, outputCols=None, values=None, scales=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        exprs = {}
        for c, o, m, s in zip(self.getInputCols(), self.getOutputCols(), self.getOrDefault(self.values),
                              self.getOrDefault(self.scales)):
            exprs[o] = (F.col(c).cast("double") - F.lit(m)) / F.lit(s if s > 0 else 1.0)
        return df.withColumns(exprs)


class PopulationScaler(Estimator, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """(x - mean) / population std, fitted on the fitting frame; constant -> 0."""
    @keyword_only
    def __init__(self, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> PopulationScalerModel:
        cols = self.getInputCols()
        row = df.agg(*[x for c in cols for x in (F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}"))]).first()
        return PopulationScalerModel(inputCols=cols, outputCols=self.getOutputCols(),
                                     values=[float(row[f"m_{c}"] or 0.0) for c in cols],
                                     scales=[float(row[f"s_{c}"] or 0.0) for c in cols])


class ModeImputerModel(Model, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    fills = Param(Params._dummy(), "fills", "most frequent value per column", typeConverter=TypeConverters.toListString)

    @keyword_only
    def __init__(self, inputCols=None, fills=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: F.coalesce(F.col(c), F.lit(v))
                               for c, v in zip(self.getInputCols(), self.getOrDefault(self.fills))})


class ModeImputer(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """String NULL -> most frequent value of the fitting frame (ties -> smallest)."""
    @keyword_only
    def __init__(self, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> ModeImputerModel:
        from .clean import most_frequent
        cols = self.getInputCols()
        got = {r["column"]: r["value"] for r in most_frequent(df, cols).collect()}
        return ModeImputerModel(inputCols=cols, fills=[got.get(c) or "" for c in cols])


def standard_scale(train: DataFrame, cols: list[str], *frames: DataFrame) -> list[DataFrame]:
    """Fit a population scaler on ``train`` and apply it to train and each frame."""
    m = PopulationScaler(inputCols=cols, outputCols=cols).fit(train)
    return [m.transform(train)] + [m.transform(f) for f in frames]


def one_hot_stages(cat_cols: list[str], suffix_idx: str = "_idx", suffix_ohe: str = "_ohe"):
    """One column per training category in alphabetical order; unseen and NULL
    categories give all zeros (the 'keep' bucket is the dropped last slot)."""
    idx = StringIndexer(inputCols=cat_cols, outputCols=[c + suffix_idx for c in cat_cols],
                        handleInvalid="keep", stringOrderType="alphabetAsc")
    ohe = OneHotEncoder(inputCols=[c + suffix_idx for c in cat_cols],
                        outputCols=[c + suffix_ohe for c in cat_cols], dropLast=True)
    return [idx, ohe]


def column_transformer(num_cols: list[str], cat_cols: list[str], out: str = "features"):
    """numeric: exact median impute -> population scale; categorical: most
    frequent impute -> one-hot; then one assembled vector."""
    num_out = [c + "_num" for c in num_cols]
    stages = [ExactMedianImputer(inputCols=num_cols, outputCols=num_out),
              PopulationScaler(inputCols=num_out, outputCols=num_out)]
    if cat_cols:
        stages.append(ModeImputer(inputCols=cat_cols))
        stages += one_hot_stages(cat_cols)
    stages.append(VectorAssembler(inputCols=num_out + [c + "_ohe" for c in cat_cols], outputCol=out,
                                  handleInvalid="keep"))
    return stages


def assemble_features(cols: list[str], out: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="keep")


def feature_names(df: DataFrame, features: str = "features") -> list[str]:
    """Names after one-hot, from the assembled column's ML attribute metadata."""
    meta = df.schema[features].metadata.get("ml_attr", {})
    attrs = []
    for kind in ("numeric", "binary", "nominal"):
        attrs += meta.get("attrs", {}).get(kind, [])
    names = [None] * meta.get("num_attrs", len(attrs))
    for a in attrs:
        names[a["idx"]] = a.get("name", f"f{a['idx']}")
    return [n.replace("_num", "").replace("_ohe_", "_") if n else n for n in names]


def text_tfidf_stages(text: str = "text", out: str = "features", vocab_size: int | None = 1 << 18,
                      hashing: bool = True):
    tok = RegexTokenizer(inputCol=text, outputCol="__tokens", pattern="[a-z]+", gaps=False, toLowercase=True)
    tf = (HashingTF(inputCol="__tokens", outputCol="__tf", numFeatures=vocab_size) if hashing
          else CountVectorizer(inputCol="__tokens", outputCol="__tf", vocabSize=vocab_size))
    return [tok, tf, IDF(inputCol="__tf", outputCol=out)]


def tfidf_vocabulary(train: DataFrame, text: str = "text") -> DataFrame:
    """Every token of the training texts: token, idx (0-based, by document count
    descending, then md5), docs, idf = ln((n + 1) / (docs + 1)).

    Ranks come from the bucketed global rank, so no task sorts the vocabulary
    and no token is hashed away or cut."""
    from ..functions.keys import rank_by_value
    from .text import tokens
    n = train.count()
    df = train.select(F.explode(F.array_distinct(tokens(F.col(text)))).alias("token")).groupBy("token") \
        .agg(F.count(F.lit(1)).alias("docs"))
    df = stage_table(df, "tfidf-docs")
    r = rank_by_value(df.withColumn("__k", F.md5("token")), "docs", "__k", "rank", descending=True)
    idf = F.log(F.lit(float(n + 1)) / (F.col("docs") + 1))
    return stage_table(r.select("token", (F.col("rank") - 1).cast("int").alias("idx"), "docs", idf.alias("idf")),
                       "tfidf-vocabulary")


def tfidf_weights(docs: DataFrame, vocab: DataFrame, row: str, text: str = "text") -> DataFrame:
    """One row per (``row``, known token): token, idx, tf, weight = tf * idf.
    Tokens are counted per row before they meet the vocabulary."""
    from .text import tokens
    tf = docs.select(row, F.explode(tokens(F.col(text))).alias("token")).groupBy(row, "token") \
        .agg(F.count(F.lit(1)).alias("tf"))
    return tf.join(vocab.select("token", "idx", "idf"), "token") \
        .select(row, "token", "idx", "tf", (F.col("tf") * F.col("idf")).alias("weight"))


def tfidf_vectors(docs: DataFrame, vocab: DataFrame, text: str = "text", out: str = "features") -> DataFrame:
    """``docs`` with a sparse vector of all its known tokens (empty text: no entry).

    The parts of each vector are collected per row in index order and stored as
    the vector type's own struct; reading the file back with the vector type in
    the schema makes them vectors, without Python."""
    from pyspark.ml.linalg import VectorUDT

    from ..session import scratch_path
    spark = docs.sparkSession
    rows = stage_table(docs.withColumn("__row", F.monotonically_increasing_id()), "tfidf-rows")
    parts = tfidf_weights(rows, vocab, "__row", text).groupBy("__row") \
        .agg(F.sort_array(F.collect_list(F.struct("idx", "weight"))).alias("__e"))
    size = vocab.count()
    none = F.array().cast("array<struct<idx:int,weight:double>>")
    e = F.coalesce(F.col("__e"), none)
    vector = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(size).alias("size"),
                      F.transform(e, lambda x: x["idx"]).alias("indices"), F.transform(e, lambda x: x["weight"]).alias("values"))
    path = scratch_path(spark, f"tfidf-vectors-{uuid.uuid4().hex}")
    rows.join(parts, "__row", "left").select(*docs.columns, vector.alias(out)).write.parquet(path)
    return spark.read.schema(T.StructType([*docs.schema.fields, T.StructField(out, VectorUDT())])).parquet(path)


# ------------------------------------------------------------------ images
IMAGE_FEATURES = ["mean_b", "mean_g", "mean_r", "std_b", "std_g", "std_r"]


PIXEL_BYTES = 1 << 22   # bytes of images worked on at once; a larger image is worked on alone


def _same_shape(h: pd.Series, w: pd.Series, c: pd.Series, data: pd.Series):
    """(places, height, width, channels, bytes as images x values) of images of one
    shape, at most PIXEL_BYTES at a time, so that numpy works on many small images
    in one call."""
    by: dict[tuple, list[int]] = {}
    for i, shape in enumerate(zip(h, w, c, data)):
        hh, ww, cc, dd = int(shape[0]), int(shape[1]), int(shape[2]), shape[3]
        if cc >= 3 and len(dd) != hh * ww * cc:
            raise ValueError(f"image of {hh} x {ww} x {cc} holds {len(dd)} bytes")
        by.setdefault((hh, ww, cc, len(dd)), []).append(i)
    for (hh, ww, cc, size), rows in by.items():
        step = max(1, PIXEL_BYTES // max(size, 1))
        for k in range(0, len(rows), step):
            at = rows[k:k + step]
            yield at, hh, ww, cc, np.frombuffer(b"".join([data.iat[i] for i in at]), dtype=np.uint8).reshape(len(at), size)


def image_color_features(images: DataFrame, image_col: str = "image", bins: int = 4) -> DataFrame:
    """Per image: mean and std of each channel and a ``bins``-bucket histogram
    per channel (B, G, R order, as the image source stores pixels)."""
    fields = ", ".join(f"{n} double" for n in IMAGE_FEATURES)
    hist_fields = ", ".join(f"hist_{ch}_{i} double" for ch in "bgr" for i in range(bins))
    schema = f"{fields}, {hist_fields}"
    levels = np.arange(256)
    starts = np.concatenate([[0], np.cumsum(np.histogram(levels, bins=bins, range=(0, 256))[0])])

    def channel(v: np.ndarray) -> tuple:
        """mean, std and histogram of every row, from counts by pixel value."""
        n, px = v.shape
        counts = np.bincount((v + 256 * np.arange(n)[:, None]).ravel(), minlength=256 * n).reshape(n, 256)
        mean = counts @ levels / px
        std = np.sqrt((counts * (levels - mean[:, None]) ** 2).sum(axis=1) / px)
        run = np.concatenate([np.zeros((n, 1), counts.dtype), counts.cumsum(axis=1)], axis=1)
        return mean, std, np.diff(run[:, starts], axis=1) / px

    @F.pandas_udf(schema)
    def feats(h: pd.Series, w: pd.Series, c: pd.Series, data: pd.Series) -> pd.DataFrame:
        out = np.empty((len(data), 6 + 3 * bins))
        for at, hh, ww, cc, a in _same_shape(h, w, c, data):
            of = [channel(a.reshape(len(at), -1, cc)[:, :, ch]) for ch in range(3)] if cc >= 3 else [channel(a)] * 3
            for ch, (mean, std, hist) in enumerate(of):
                out[at, ch], out[at, 3 + ch] = mean / 255.0, std / 255.0
                out[at, 6 + ch * bins:6 + (ch + 1) * bins] = hist
        cols = IMAGE_FEATURES + [f"hist_{ch}_{i}" for ch in "bgr" for i in range(bins)]
        return pd.DataFrame(out, columns=cols)

    im = F.col(image_col)
    return images.withColumn("__f", feats(im.height, im.width, im.nChannels, im.data)).select("*", "__f.*").drop("__f")


def image_normalize(images: DataFrame, size: int = 8, image_col: str = "image", out: str = "pixels") -> DataFrame:
    """Block-mean resize to size x size, scale to [0, 1], then (x - 0.5) / 0.5;
    RGB order, flattened."""
    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def norm(h: pd.Series, w: pd.Series, c: pd.Series, data: pd.Series) -> pd.Series:
        out_rows = [None] * len(data)
        for at, hh, ww, cc, a in _same_shape(h, w, c, data):
            a = a.reshape(len(at), hh, ww, cc)
            a = a[..., 2::-1] if cc >= 3 else a.sum(axis=3, dtype=np.int64, keepdims=True)
            per = 1 if cc >= 3 else cc
            ys = np.linspace(0, hh, size + 1).astype(int)
            xs = np.linspace(0, ww, size + 1).astype(int)
            res = np.zeros((len(at), size, size, 3), dtype=np.float32)
            for i in range(size):
                y0, y1 = ys[i], max(ys[i + 1], ys[i] + 1)
                band = a[:, y0:y1].sum(axis=1, dtype=np.int64)
                for j in range(size):
                    x0, x1 = xs[j], max(xs[j + 1], xs[j] + 1)
                    res[:, i, j] = band[:, x0:x1].sum(axis=1) / ((y1 - y0) * (x1 - x0) * per)
            for i, x in zip(at, ((res / 255.0 - 0.5) / 0.5).reshape(len(at), -1)):
                out_rows[i] = x
        return pd.Series(out_rows)

    im = F.col(image_col)
    return images.withColumn(out, norm(im.height, im.width, im.nChannels, im.data))
