"""Quality scores by naive Bayes support vectors.

A text is the set of its token n-grams (words and runs of signs, one and two long;
a token that equals the one before is the bigram "same as before").  Every indicator
is scaled by the log ratio of its smoothed counts in both classes, and a linear
hinge-loss model is fitted on the scaled rows by dual coordinate descent.  The final
weights lie between the fitted ones and their mean size, and a sigmoid fitted on
out-of-fold margins maps margins to probabilities.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import linear
from .rows import free_name, map_slices

FIT_ROWS = 6_000     # labelled rows the model is fitted on, those with the smallest hash of the id
BLEND = 0.25         # 0: fitted weights only; 1: naive Bayes only


@dataclass
class Model:
    weights: np.ndarray      # float32, one per hashed feature, already scaled by the ratios
    scale: np.ndarray
    bias: float
    slope: float
    offset: float

    def score(self, features: np.ndarray) -> float:
        s = self.scale[features]
        size = max(float(np.sqrt(s @ s)), 1e-9)
        margin = float(self.weights[features].sum()) / size + self.bias
        return float(linear.sigmoid(self.slope * margin + self.offset))


def features(text: str | None, memo: dict | None = None) -> np.ndarray:
    """Distinct hashed uni- and bigram indicators of a whole text; none for null or empty."""
    memo = {} if memo is None else memo
    tokens = linear.TOKENS.findall(text or "")
    grams: set = set(tokens)
    grams.update(pairwise(tokens))
    found = set()
    for g in grams:
        i = memo.get(g)
        if i is None:
            if len(memo) > 60_000:
                memo.clear()
            same = isinstance(g, tuple) and g[0] == g[1]
            name = "\t=" if same else "\t".join(g) if isinstance(g, tuple) else g
            i = memo[g] = linear.bucket(name)
        found.add(i)
    return np.fromiter(found, np.int64, len(found))


def labelled_sample(docs: DataFrame, labels: DataFrame, usable: Column, key: str, text: str,
                    columns: list[str], fit_rows: int) -> DataFrame:
    """``k``, ``t`` and the label columns of at most ``fit_rows`` usable labelled rows.

    Labels of a key that occurs more than once count once (the largest); rows with a
    null key or label are not used.  The choice is made on the narrow label table and
    is small by its bound, so the texts need no shuffle.
    """
    chosen = labels.where(usable & F.col(key).isNotNull()).groupBy(F.col(key).alias("k")) \
        .agg(*[F.max(c).cast("int").alias(f"y_{c}") for c in columns])
    for c in columns:
        chosen = chosen.where(F.col(f"y_{c}").isNotNull())
    chosen = chosen.orderBy(F.xxhash64("k"), "k").limit(fit_rows)
    return docs.where(F.col(text).isNotNull()).select(F.col(key).alias("k"), F.col(text).alias("t")) \
        .join(F.broadcast(chosen), "k")


def train(docs: DataFrame, labels: DataFrame, usable: Column, key: str = "doc_id", text: str = "text",
          label: str = "quality", fit_rows: int = FIT_ROWS) -> Model:
    """Fit on at most ``fit_rows`` labelled rows; features are taken on Spark.

    With rows of one class only (or none) every score is that class's smoothed share
    (or one half).
    """
    sample = labelled_sample(docs, labels, usable, key, text, [label], fit_rows)

    def make() -> Callable[[dict], dict]:
        memo: dict = {}
        return lambda part: {"k": part["k"], "y": part[f"y_{label}"],
                             "f": [features(t, memo).tolist() for t in part["t"]]}

    kind = sample.schema["k"].dataType.simpleString()
    rows = map_slices(sample, make, f"k {kind}, y INT, f ARRAY<INT>").toPandas()
    rows = rows.sort_values("k", kind="stable")
    y = (rows["y"].to_numpy(dtype=float) > 0).astype(int)
    x = linear.Rows([np.asarray(f, dtype=np.int32) for f in rows.pop("f")])
    if len(set(y.tolist())) < 2:
        share = (y.sum() + 0.5) / (len(y) + 1)
        zero = np.zeros(linear.WIDTH, np.float32)
        return Model(zero, zero, 0.0, 1.0, float(np.log(share / (1 - share))))
    folds = np.arange(len(y)) % 3
    margins = np.zeros(len(y))
    for fold in range(3):
        part = np.flatnonzero(folds != fold)
        if len(set(y[part].tolist())) == 2:
            model = _fit(x.pick(part), y[part])
            rest = np.flatnonzero(folds == fold)
            margins[rest] = _margins(model, x.pick(rest))
    model = _fit(x, y)
    slope, offset = linear.calibrate(margins, y)
    return Model(model.weights.astype(np.float32), model.scale.astype(np.float32), model.bias, slope, offset)


def _fit(x: linear.Rows, y: np.ndarray) -> Model:
    ratio = linear.log_count_ratio(x, y, linear.WIDTH)
    w, _, bias = linear.hinge(x, y, ratio)
    used = np.abs(w[w != 0])
    w = (1 - BLEND) * w + BLEND * (used.mean() if len(used) else 0.0) * np.sign(ratio) * np.sign(np.abs(w))
    return Model(w * ratio, ratio, bias, 1.0, 0.0)


def _margins(model: Model, x: linear.Rows) -> np.ndarray:
    size = np.sqrt(np.maximum(x.times(model.scale ** 2), 1e-18))
    return x.times(model.weights) / size + model.bias


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text",
          keep: tuple[str, ...] = ()) -> DataFrame:
    """``key``, the columns ``keep`` and ``score`` (0 to 1, higher: class 1 likelier) per row.

    Null and empty texts have no features and get the score of the constant alone.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)     # two arrays of WIDTH floats
    name = free_name(docs.select(*keep), "text_of_row")
    rows = docs.select(F.col(key), *[F.col(c) for c in keep], F.col(text).alias(name))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != name)

    def make() -> Callable[[dict], dict]:
        known, memo = shared.value, {}
        return lambda part: {c: v for c, v in part.items() if c != name} | {
            "score": [known.score(features(t, memo)) for t in part[name]]}

    return map_slices(rows, make, f"{ddl}, score DOUBLE")
