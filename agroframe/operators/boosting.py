"""M2: one boosted-tree regressor per series, all series in one grouped job.

A series has at most one row per calendar week, so its model is fitted inside one
task from a few hundred rows; the job spreads the series.  The fitted models are a table
(one row per series: the nodes of all trees as arrays), written like any other and
joined back for scoring.

Trees are grown depth by depth on exact splits of the squared loss.  Missing
values go to the right of every split.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agroframe.operators.panel import BASE_FEATS

SERIES = ("crop", "location", "pest")
MODEL_SCHEMA = ("n_train long, base double, rate double, roots array<int>, feature array<int>, threshold array<double>, "
                "child array<int>, value array<double>, importance array<double>")


def _best_splits(x: np.ndarray, by_feature: np.ndarray, node: np.ndarray, r: np.ndarray, features: np.ndarray):
    """(nodes, gain, feature, threshold) of the best split of every open node, all at once.

    ``node[row]`` is a row's open node, or -1; *by_feature* sorts the rows by each feature, missing (infinite) last.
    """
    order = by_feature[features]
    order = order[node[order] >= 0].reshape(len(features), -1)  # every feature keeps the same rows
    order = np.take_along_axis(order, np.argsort(node[order], axis=1, kind="stable"), axis=1)
    of = node[order[0]]
    starts = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
    sizes = np.diff(np.r_[starts, len(of)])
    nodes, first = of[starts], np.repeat(starts, sizes)
    xs, rs = x[order, features[:, None]], r[order]
    sums = np.cumsum(rs, axis=1)
    before = (sums - rs)[:, first]
    total = np.add.reduceat(rs[0], starts)[np.searchsorted(nodes, of)]
    left, nl = sums - before, np.arange(1, len(of) + 1) - first
    n = np.repeat(sizes, sizes)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = left ** 2 / nl + (total - left) ** 2 / (n - nl) - total ** 2 / n
        parted = np.zeros(gain.shape, dtype=bool)
        parted[:, :-1] = (xs[:, 1:] > xs[:, :-1]) & (of[1:] == of[:-1])
    gain = np.where(parted, gain, -1.0)
    feature = np.argmax(gain, axis=0)
    best = gain[feature, np.arange(len(of))]
    top = np.array([s + int(np.argmax(best[s:s + k])) for s, k in zip(starts, sizes)])
    lo = xs[feature[top], top]
    hi = xs[feature[top], np.minimum(top + 1, len(of) - 1)]
    return nodes, best[top], features[feature[top]], np.where(np.isinf(hi), lo, (lo + hi) / 2)


def boost(x: np.ndarray, y: np.ndarray, max_iter: int, depth: int, rate: float, subsample: float = 1.0,
          colsample: float = 1.0, seed: int = 42) -> dict:
    """Boosted regression trees of the squared loss; see MODEL_SCHEMA for the result (``child`` is the left one, -1 for a leaf)."""
    rng = np.random.default_rng(seed)
    x = np.where(np.isnan(x), np.inf, x)
    n, width = x.shape
    base = float(y.mean())
    guess = np.full(n, base)
    roots, feature, threshold, child, value = [], [], [], [], []
    importance = np.zeros(width)
    pick, use = max(1, round(subsample * n)), max(1, round(colsample * width))
    by_feature = np.argsort(x, axis=0, kind="stable").T

    for _ in range(max_iter):
        r = y - guess
        taken = np.zeros(n, dtype=bool)
        taken[rng.permutation(n)[:pick]] = True
        features = np.sort(rng.permutation(width)[:use])
        roots.append(len(value))
        at = np.full(n, len(value))  # every row's node
        feature.append(-1), threshold.append(0.0), child.append(-1), value.append(float(r[taken].mean()))
        opened = {len(value) - 1}
        for _ in range(depth):
            node = np.where(taken & np.isin(at, list(opened)), at, -1)
            opened = set()
            if not (node >= 0).any():
                break
            for v, gain, f, cut in zip(*_best_splits(x, by_feature, node, r, features)):
                if gain <= 1e-12:
                    continue
                importance[f] += gain
                feature[v], threshold[v], child[v] = int(f), float(cut), len(value)
                here, goes = at == v, x[:, f] <= cut
                for side in (here & goes, here & ~goes):
                    at[side] = len(value)
                    opened.add(len(value))
                    feature.append(-1), threshold.append(0.0), child.append(-1), value.append(float(r[side & taken].mean()))
        guess += rate * np.array(value)[at]
    total = importance.sum()
    return {"n_train": n, "base": base, "rate": rate, "roots": roots, "feature": feature, "threshold": threshold, "child": child,
            "value": value, "importance": (importance / total if total else importance).tolist()}


def predict(model, x: np.ndarray) -> np.ndarray:
    """Predictions of a model row for rows *x*, all trees at once."""
    feature, threshold, child, value = (np.asarray(model[k]) for k in ("feature", "threshold", "child", "value"))
    x = np.where(np.isnan(x), np.inf, x)
    at = np.tile(np.asarray(model["roots"], dtype=np.int64), (len(x), 1))
    rows = np.arange(len(x))[:, None]
    while (inner := child[at] >= 0).any():
        right = x[rows, np.maximum(feature[at], 0)] > threshold[at]
        at = np.where(inner, child[at] + right, at)
    return model["base"] + model["rate"] * value[at].sum(axis=1)


def fit_series(train: DataFrame, feats=BASE_FEATS, label: str = "y", keys=SERIES, max_iter: int = 400, depth: int = 4,
               rate: float = 0.04, subsample: float = 0.9, colsample: float = 0.9, seed: int = 42) -> DataFrame:
    """One model row per series of *train*; rows without a label are not used, a series without any has no model."""
    feats, keys = [*feats, "standard_week"], list(keys)

    def fit(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["week_id"], kind="stable")
        model = boost(pdf[feats].to_numpy(dtype=np.float64), pdf[label].to_numpy(dtype=np.float64),
                      max_iter, depth, rate, subsample, colsample, seed)
        return pd.DataFrame([{**dict(zip(keys, key)), **model}])

    schema = ", ".join(f"{k} string" for k in keys) + ", " + MODEL_SCHEMA
    rows = train.where(F.col(label).isNotNull()).select(*keys, "week_id", *feats, label)
    return _dealt(rows, keys).groupBy(*keys).applyInPandas(fit, schema)


def _dealt(rows: DataFrame, keys) -> DataFrame:
    """*rows* by series over as many tasks as a shuffle has: the work per row is far above its size, by which AQE would join tasks."""
    spark = rows.sparkSession
    return rows.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism), *keys)


def score_series(rows: DataFrame, models: DataFrame, feats=BASE_FEATS, keys=SERIES, out: str = "y_log") -> DataFrame:
    """*rows* with their series' model's prediction; rows of a series without a model are left out."""
    feats, keys = [*feats, "standard_week"], list(keys)

    def score(pdf: pd.DataFrame, model: pd.DataFrame) -> pd.DataFrame:
        if not len(pdf) or not len(model):
            return pdf.iloc[:0].assign(**{out: np.empty(0)})
        return pdf.assign(**{out: predict(model.iloc[0], pdf[feats].to_numpy(dtype=np.float64))})

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + f", {out} double"
    return rows.groupBy(*keys).cogroup(models.groupBy(*keys)).applyInPandas(score, schema)


def feature_ranks(models: DataFrame, n: int, feats=BASE_FEATS, keys=SERIES) -> DataFrame:
    """T4: the *n* most important features of every series (share of all split gains; ties by name)."""
    names = F.array(*[F.lit(f) for f in [*feats, "standard_week"]])
    pairs = F.zip_with("importance", names, lambda v, f: F.struct((-v).alias("v"), f.alias("feature")))
    top = models.select(*keys, F.posexplode(F.slice(F.array_sort(pairs), 1, n)).alias("_i", "_t"))
    return top.select(*keys, (F.col("_i") + 1).alias("rank"), F.col("_t.feature").alias("feature"), (-F.col("_t.v")).alias("importance"))
