"""Toxicity: a factorization machine over hashed terms.

Features are the distinct lower-case words of a text and their four-letter
prefixes, hashed to 32 bits; every term of two sampled texts is fitted, whatever
its rates.  The machine adds a weight per term and an interaction per pair of
terms (the product of two small vectors), so that a pair such as an insult with a
group name can count more than the sum of its parts.  A text's n terms enter the
pairs with 1 / sqrt(n) each, so long texts, with their many pairs, are not all
noise.  Noise is further held down by a soft threshold on the weights, a ridge on
the vectors, and by stopping at the epoch, one at least, that serves sampled
texts kept out best.

The fit uses a bounded sample of the labelled rows (``per_class`` rows of each
label, the first in hash order); scoring covers every row and whole texts.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold

WORD = re.compile(r"\w+")
PER_CLASS = 5000        # bound of the fitting sample, rows per label
MIN_DOCS = 2            # a term must occur in so many sampled texts
FACTORS = 8
EPOCHS = 24
PATIENCE = 4            # epochs without a better one after which the vectors are not trained on
RATE = 0.2              # AdaGrad's step of the vectors
BATCH = 32              # texts a step
AT_ONCE = 100_000       # terms whose vectors are looked up together
PREFIX = 4
L1 = 1.5                # soft threshold of the weights, in deviations of a term's gradient
RIDGE = 0.2
PAIR_RIDGE = 1e-3       # of the vectors, a text and step


def terms(text: str | None) -> np.ndarray:
    """Distinct hashed terms of one text, ascending."""
    found = set(WORD.findall((text or "").lower()))
    found |= {"^" + w[:PREFIX] for w in found if len(w) > PREFIX}
    return np.sort(np.fromiter(map(xxhash.xxh32_intdigest, found), dtype=np.uint32, count=len(found)))


@dataclass
class Model:
    keys: np.ndarray        # hashed terms, ascending
    bias: float
    linear: np.ndarray
    factors: np.ndarray     # terms x factors

    def margins(self, found: list[np.ndarray]) -> np.ndarray:
        """Log odds of texts given by their terms, all looked up at once."""
        size = np.array([len(f) for f in found], dtype=np.int64)
        if not len(self.keys) or not size.sum():
            return np.full(len(found), self.bias)
        term, row = np.concatenate(found), np.repeat(np.arange(len(found)), size)
        at = np.minimum(np.searchsorted(self.keys, term), len(self.keys) - 1)
        own = self.keys[at] == term
        at, row = at[own], row[own]
        known = np.bincount(row, minlength=len(found))
        linear = np.bincount(row, weights=self.linear[at], minlength=len(found))
        return self.bias + linear + _pair_sums(self.factors[at], row, known)

    def margin(self, found: np.ndarray) -> float:
        return float(self.margins([found])[0])

    def scores(self, texts) -> np.ndarray:
        out, held, size = [], [], 0
        for t in texts:
            held.append(terms(t))
            size += len(held[-1])
            if size > AT_ONCE:          # bounded memory: a part of the texts at a time
                out.append(self.margins(held))
                held, size = [], 0
        out.append(self.margins(held))
        return _sigmoid(np.concatenate(out))

    def score(self, text: str | None) -> float:
        return float(self.scores([text])[0])


def _pair_sums(v: np.ndarray, row: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Per text: the sum of its terms' pairwise products, divided by its terms."""
    n = len(known)
    s = np.stack([np.bincount(row, weights=v[:, f], minlength=n) for f in range(v.shape[1])], axis=1)
    q = np.bincount(row, weights=(v * v).sum(axis=1), minlength=n)
    return 0.5 * ((s * s).sum(axis=1) - q) / np.maximum(known, 1)


def _sigmoid(m):
    return 1.0 / (1.0 + np.exp(-np.clip(m, -30, 30)))


def _descend(docs: list[np.ndarray], y: np.ndarray, w: np.ndarray, l1: np.ndarray, ridge: float,
             steps: int = 200) -> tuple[np.ndarray, float]:
    """Accelerated proximal descent on the logistic loss, a step size per term."""
    at, row, size = _flat(docs)
    p = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    b, t = np.log(p / (1 - p)), 1.0
    curve = np.bincount(at, weights=0.25 * (size[row] + 1), minlength=len(w)) + ridge + 1e-9
    curve_b = 0.25 * (size + 1).sum()
    u, ub = w, b
    for _ in range(steps):
        g = _sigmoid(ub + np.bincount(row, weights=u[at], minlength=len(docs))) - y
        x = u - (np.bincount(at, weights=g[row], minlength=len(w)) + ridge * u) / curve
        nw, nb = np.sign(x) * np.maximum(np.abs(x) - l1 / curve, 0), ub - g.sum() / curve_b
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        u, ub = nw + (t - 1) / nt * (nw - w), nb + (t - 1) / nt * (nb - b)
        w, b, t = nw, nb, nt
    return w, b


def _linear(docs: list[np.ndarray], y: np.ndarray, size: int) -> tuple[np.ndarray, float]:
    """A weight per term: a soft threshold in units of the gradient's deviation
    under no effect sets the weights of noise to 0, then a ridge fit of the rest."""
    n = np.bincount(np.concatenate(docs), minlength=size)
    p = y.mean()
    w, _ = _descend(docs, y, np.zeros(size), L1 * np.sqrt(p * (1 - p) * n), 0.0)
    on = w != 0
    return _descend([d[on[d]] for d in docs], y, w, np.zeros(size), RIDGE)


def _flat(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    size = np.array([len(d) for d in docs], dtype=np.int64)
    return np.concatenate(docs), np.repeat(np.arange(len(docs), dtype=np.int32), size), size


def _pairs(docs: list[np.ndarray], y: np.ndarray, w: np.ndarray, b: float, factors: int, epochs: int, seed: int):
    """AdaGrad on the vectors of all terms over the residual of the linear part;
    yields them after every epoch."""
    rng = np.random.default_rng(seed)
    base = np.array([b + w[d].sum() for d in docs])
    v = rng.normal(0, 0.02, (len(w), factors))
    gv = np.full(v.shape, 1e-2)
    for _ in range(epochs):
        order = rng.permutation(len(docs))
        for start in range(0, len(order), BATCH):
            part = order[start:start + BATCH]
            at, row, size = _flat([docs[i] for i in part])
            if not len(at):
                continue
            va = v[at]
            s = np.stack([np.bincount(row, weights=va[:, f], minlength=len(part)) for f in range(factors)], axis=1)
            g = (_sigmoid(base[part] + _pair_sums(va, row, size)) - y[part]) / np.maximum(size, 1)
            step = g[row][:, None] * (s[row] - va) + PAIR_RIDGE * va
            on, inv = np.unique(at, return_inverse=True)
            step = np.stack([np.bincount(inv, weights=step[:, f], minlength=len(on)) for f in range(factors)], axis=1)
            gv[on] += step * step
            v[on] -= RATE * step / np.sqrt(gv[on])
        yield v


def _best_epochs(docs: list[np.ndarray], y: np.ndarray, size: int, factors: int, epochs: int, seed: int) -> int:
    """How many epochs the vectors are trained, at least one: the best on every
    fifth sampled text of each label, kept out of this fit.  All epochs if there
    are too few texts to keep any out."""
    held = np.zeros(len(docs), dtype=bool)
    for k in (0, 1):
        held[np.random.default_rng(seed).permutation(np.flatnonzero(y == k))[::5]] = True
    train_docs = [d for d, h in zip(docs, held) if not h]
    test, ty = [d for d, h in zip(docs, held) if h], y[held]
    if len(set(y[~held])) < 2 or len(set(ty)) < 2:
        return epochs
    w, b = _linear(train_docs, y[~held], size)
    base = np.array([b + w[d].sum() for d in test])
    parts = [test[i:i + 256] for i in range(0, len(test), 256)]
    best, least = 1, np.inf
    for e, v in enumerate(_pairs(train_docs, y[~held], w, b, factors, epochs, seed), 1):
        flat = (_flat(part) for part in parts)
        m = base + np.concatenate([_pair_sums(v[at], row, known) for at, row, known in flat])
        loss = np.logaddexp(0, np.where(ty == 1, -m, m)).mean()
        if loss < least:
            best, least = e, loss
        elif e >= best + PATIENCE:
            break
    return best


def train(rows: list[tuple[np.ndarray, int]], share: float, factors: int = FACTORS,
          epochs: int = EPOCHS, seed: int = 1) -> Model:
    """Every term of MIN_DOCS or more rows takes part, in the linear part and in
    the pairs.  ``share`` is the share of label 1 among all labelled rows, to
    which the bias is set back after the fit."""
    if not rows:
        return Model(np.zeros(0, np.uint32), -30.0, np.zeros(0), np.zeros((0, factors)))
    keys, n = np.unique(np.concatenate([r for r, _ in rows]), return_counts=True)
    keys = keys[n >= MIN_DOCS]
    docs = [(np.flatnonzero(np.isin(keys, r, assume_unique=True)) if len(keys) < len(r) else
             (lambda at: at[keys[at] == r])(np.minimum(np.searchsorted(keys, r), len(keys) - 1))).astype(np.int32)
            for r, _ in rows]
    y = np.array([label for _, label in rows], dtype=float)
    odds = lambda p: np.log(np.clip(p, 1e-6, 1 - 1e-6) / (1 - np.clip(p, 1e-6, 1 - 1e-6)))
    w, b, v = np.zeros(len(keys)), odds(y.mean()), np.zeros((len(keys), factors))
    if len(keys) and 0 < y.mean() < 1:
        w, b = _linear(docs, y, len(keys))
        for v in _pairs(docs, y, w, b, factors, _best_epochs(docs, y, len(keys), factors, epochs, seed), seed):
            pass
    return Model(keys, float(b + odds(share) - odds(y.mean())), w, v)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", folds: int = 5, per_class: int = PER_CLASS) -> Model:
    """Fit on labelled rows whose crc32(id as text) mod ``folds`` is not 0.
    NULL labels and NULL ids are left out; a text labelled twice counts as 1 if
    any label is 1.  Of rows that repeat an id, the smallest text is fitted.  Without labelled rows every score is near 0."""
    own = (labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y"))
           .filter((fold(F.col("_id"), folds) != 0) & F.col("_y").isin(0, 1) & F.col("_id").isNotNull())
           .groupBy("_id").agg(F.max("_y").alias("_y")))
    n = {r["_y"]: r["n"] for r in own.groupBy("_y").agg(F.count("*").alias("n")).collect()}
    picked = None
    for y in (0, 1):
        part = own.filter(F.col("_y") == y).orderBy(F.xxhash64("_id"), "_id").limit(per_class)
        picked = part if picked is None else picked.unionByName(part)
    text = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))

    @F.pandas_udf("array<long>")
    def hashed(t: pd.Series) -> pd.Series:
        return t.map(lambda x: terms(x).astype(np.int64))

    # at most 2 * per_class ids are broadcast, and one text of each comes back
    sample = (text.join(F.broadcast(picked), "_id").groupBy("_id", "_y").agg(F.min("_text").alias("_text"))
              .select("_id", "_y", hashed("_text").alias("_terms")))
    got = sorted(((r["_id"], r["_y"], np.array(r["_terms"], dtype=np.uint32)) for r in sample.toLocalIterator()),
                 key=lambda r: r[0])
    rows = [(t, y) for _, y, t in got]
    return train(rows, n.get(1, 0) / max(1, sum(n.values())))


def scorer(docs: DataFrame, model: Model):
    """Column function: text -> score in [0, 1].  The broadcast model holds terms
    of the bounded sample only."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(t: pd.Series) -> pd.Series:
        m = shared.value
        return pd.Series(m.scores(t), dtype="float64")

    def apply(text: Column) -> Column:
        return score(F.coalesce(text, F.lit("")))
    return apply


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             folds: int = 5, per_class: int = PER_CLASS) -> DataFrame:
    """Every row's id, held_out, score (0 to 1) and predicted (score >= 0.5).

    NULL and empty texts score the bias alone.  Scores read the text only, as a
    whole, in time proportional to its length; equal texts score alike.
    """
    score = scorer(docs, fit(docs, labels, id_col, text_col, "toxic", folds, per_class))
    out = docs.select(F.col(id_col).alias("_id"), score(F.col(text_col)).alias("score"))
    return out.select(F.col("_id").alias(id_col), (fold(F.col("_id"), folds) == 0).alias("held_out"),
                      "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
