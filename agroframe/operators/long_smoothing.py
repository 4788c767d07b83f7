"""W8 + W9 for series of any length: the filter and the smoother as associative scans over blocks.

A series is cut into blocks of the calendar.  The effect of a block on a Gaussian
state is one element of 16 numbers, and elements combine associatively.  So every block is summed up in a
task of its own, a short scan over a series' block elements gives the state that enters each block,
and the blocks are then filtered in parallel.  Smoothing goes back in the same way: a block is a linear map from the state that
follows it to its own first state.  No task holds more than one block, or one element per block
of a series.  Results equal ``smoothing.kalman_smooth``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from agroframe.operators.smoothing import Q_LEVEL, Q_SLOPE, R_OBS
from agroframe.session import materialize

BLOCK_WEEKS = 4096
_I = np.eye(2)


def _step(gap: float, ql: float, qs: float) -> tuple[np.ndarray, np.ndarray]:
    """Transition and noise over a gap of weeks."""
    gap = max(1.0, gap)
    return np.array([[1.0, gap], [0.0, 1.0]]), np.diag([ql * gap, qs * gap])


def _start(z: float, r: float) -> tuple[np.ndarray, np.ndarray]:
    """State after the first reading of a series: prior level z, unit variances."""
    return np.array([z, 0.0]), np.diag([r * r / (1 + r * r), 1.0])


def _element(z: float, gap: float | None, ql: float, qs: float, r: float):
    """A reading as (A, b, C, eta, J): the state's law given the one before, and what the reading says about that."""
    if gap is None:
        m, p = _start(z, r)
        return np.zeros((2, 2)), m, p, np.zeros(2), np.zeros((2, 2))
    f, q = _step(gap, ql, qs)
    s = q[0, 0] + r * r
    k = q[:, 0] / s
    keep = _I - np.outer(k, [1.0, 0.0])
    return keep @ f, k * z, keep @ q, f[0] * (z / s), np.outer(f[0], f[0]) / s


def _combine(x, y):
    """The element of *x* followed by *y*."""
    (a1, b1, c1, e1, j1), (a2, b2, c2, e2, j2) = x, y
    mid = np.linalg.inv(_I + c1 @ j2)
    back = a1.T @ mid.T
    return (a2 @ mid @ a1, a2 @ mid @ (b1 + c1 @ e2) + b2, a2 @ mid @ c1 @ a2.T + c2,
            back @ (e2 - j2 @ b1) + e1, back @ j2 @ a1 + j1)


def _flat(parts) -> list[float]:
    return np.concatenate([np.ravel(p) for p in parts]).tolist()


def _unflat(v) -> tuple:
    v = np.asarray(v, dtype=np.float64)
    return v[0:4].reshape(2, 2), v[4:6], v[6:10].reshape(2, 2), v[10:12], v[12:16].reshape(2, 2)


def _filtered(pdf: pd.DataFrame, ql, qs, r) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Weeks, readings, filtered means and covariances of a block that its ``enter`` state (mean, covariance) precedes."""
    weeks, z = pdf["week_id"].to_numpy(dtype=float), np.log1p(pdf["value"].to_numpy(dtype=float))
    enter, before = pdf["enter"].iloc[0], pdf["before"].iloc[0]
    means, covs = np.empty((len(z), 2)), np.empty((len(z), 2, 2))
    if enter is None:
        means[0], covs[0] = _start(z[0], r)
    else:
        m, p, gap = np.asarray(enter[:2]), np.asarray(enter[2:]).reshape(2, 2), weeks[0] - before
    for i in range(0 if enter is not None else 1, len(z)):
        if i:
            m, p, gap = means[i - 1], covs[i - 1], weeks[i] - weeks[i - 1]
        f, q = _step(gap, ql, qs)
        m, p = f @ m, f @ p @ f.T + q
        k = p[:, 0] / (p[0, 0] + r * r)
        means[i], covs[i] = m + k * (z[i] - m[0]), p - np.outer(k, p[0])
    return weeks, z, means, covs


def _back(m, p, gap, ql, qs):
    """(E, g, L): a state given the next one is E next + g with covariance L; without a next one it is itself."""
    if gap is None:
        return np.zeros((2, 2)), m, p
    f, q = _step(gap, ql, qs)
    ahead = f @ p @ f.T + q
    e = np.linalg.solve(ahead, f @ p).T
    return e, m - e @ f @ m, p - e @ ahead @ e.T


def smooth_long(weekly: DataFrame, keys=("location", "pest"), value: str = "value", block_weeks: int = BLOCK_WEEKS,
                q_level: float = Q_LEVEL, q_slope: float = Q_SLOPE, r_obs: float = R_OBS) -> DataFrame:
    """``kalman_smooth`` (same columns) with no task bound to a whole series.

    A series has at most one reading per week; rows without key or value are no readings.
    """
    keys, noise = list(keys), (q_level, q_slope, r_obs)
    typed = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in weekly.schema.fields if f.name in keys)
    place = [*keys, "block"]
    rows = weekly.select(*keys, F.col("week_id").cast("long").alias("week_id"), F.col(value).cast("double").alias("value")).dropna()
    rows = rows.withColumn("block", F.floor(F.col("week_id") / block_weeks))
    ends = rows.groupBy(*place).agg(F.min("week_id").alias("first"), F.max("week_id").alias("last"))
    along = Window.partitionBy(*keys).orderBy("block")  # one row per block of a series
    ends = ends.select(*place, F.lag("last").over(along).cast("double").alias("before"), F.lead("first").over(along).cast("double").alias("after"))
    rows = materialize(rows.join(ends, place), "blocks")

    def ids(key: tuple) -> dict:
        return dict(zip(place, key))

    def summary(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("week_id")
        weeks, z, before = pdf["week_id"].to_numpy(dtype=float), np.log1p(pdf["value"].to_numpy(dtype=float)), pdf["before"].iloc[0]
        out = _element(z[0], None if np.isnan(before) else weeks[0] - before, *noise)
        for i in range(1, len(z)):
            out = _combine(out, _element(z[i], weeks[i] - weeks[i - 1], *noise))
        return pd.DataFrame([{**ids(key), "element": _flat(out)}])

    def enter(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, state, states = pdf.sort_values("block"), None, []
        for v in pdf["element"]:
            states.append(None if state is None else _flat((state[1], state[2])))
            state = _unflat(v) if state is None else _combine(state, _unflat(v))
        return pdf[place].assign(enter=states)

    elements = rows.groupBy(*place).applyInPandas(summary, f"{typed}, block long, element array<double>")
    entering = elements.groupBy(*keys).applyInPandas(enter, f"{typed}, block long, enter array<double>")
    known = materialize(rows.join(entering, place), "entered")

    def maps(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("week_id")
        weeks, _, means, covs = _filtered(pdf, *noise)
        after, out = pdf["after"].iloc[0], None
        for i in range(len(weeks) - 1, -1, -1):
            gap = weeks[i + 1] - weeks[i] if i + 1 < len(weeks) else None if np.isnan(after) else after - weeks[i]
            e, g, c = _back(means[i], covs[i], gap, *noise[:2])
            out = (e, g, c) if out is None else (e @ out[0], e @ out[1] + g, e @ out[2] @ e.T + c)
        return pd.DataFrame([{**ids(key), "element": _flat(out)}])

    def follow(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, state, states = pdf.sort_values("block", ascending=False), None, []
        for v in pdf["element"]:
            states.append(None if state is None else _flat(state))
            v = np.asarray(v)
            e, g, c = v[:4].reshape(2, 2), v[4:6], v[6:].reshape(2, 2)
            state = (g, c) if state is None else (e @ state[0] + g, e @ state[1] @ e.T + c)
        return pdf[place].assign(next=states)

    backward = known.groupBy(*place).applyInPandas(maps, f"{typed}, block long, element array<double>")
    following = backward.groupBy(*keys).applyInPandas(follow, f"{typed}, block long, next array<double>")

    def finish(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("week_id")
        weeks, z, means, covs = _filtered(pdf, *noise)
        state, after = pdf["next"].iloc[0], pdf["after"].iloc[0]
        m, p = (None, None) if state is None else (np.asarray(state[:2]), np.asarray(state[2:]).reshape(2, 2))
        smooth, var = np.empty((len(z), 2)), np.empty(len(z))
        for i in range(len(z) - 1, -1, -1):
            gap = weeks[i + 1] - weeks[i] if i + 1 < len(z) else None if m is None else after - weeks[i]
            e, g, c = _back(means[i], covs[i], gap, *noise[:2])
            m, p = (g, c) if gap is None else (e @ m + g, e @ p @ e.T + c)
            smooth[i], var[i] = m, p[0, 0]
        return pdf[keys].assign(week_id=pdf["week_id"], value=pdf["value"], level_f=means[:, 0], slope_f=means[:, 1],
                                level=smooth[:, 0], slope=smooth[:, 1], _var=var, _off=z - smooth[:, 0])

    done = known.join(following, place).groupBy(*place).applyInPandas(
        finish, f"{typed}, week_id long, value double, level_f double, slope_f double, level double, slope double, _var double, _off double")
    done = materialize(done, "smoothed")
    spread = done.groupBy(*keys).agg(F.var_pop("_off").alias("_spread"))
    std = F.sqrt(F.greatest("_var", F.lit(0.0)) + F.col("_spread"))
    return done.join(spread, keys).select(*keys, "week_id", "value", "level_f", "slope_f", "level", "slope", F.expm1("level").alias("est"),
                                          F.expm1(F.col("level") - 2 * std).alias("lo"), F.expm1(F.col("level") + 2 * std).alias("hi"))
