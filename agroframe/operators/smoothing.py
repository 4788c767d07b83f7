"""Gap-aware local-linear-trend Kalman filter and RTS smoother, per series.

State (level, slope) in log1p space; a gap of g weeks between readings
predicts level += g * slope with process noise (q_level * g, q_slope * g).
The elimination is inherently sequential inside a series, so it runs as a
grouped pandas function: Spark shuffles by series key and runs all series
in parallel.  Input is the *weekly* series (one mean per week), so a group
is bounded by the calendar span of the series, never by raw row counts.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Default noise parameters.
Q_LEVEL, Q_SLOPE, R_OBS = 0.02, 0.002, 0.35


def _inverse(a: float, b: float, d: float) -> tuple[float, float, float]:
    """Inverse of the symmetric matrix [[a, b], [b, d]]."""
    det = a * d - b * b
    return d / det, -b / det, a / det


def local_trend(weeks: np.ndarray, z: np.ndarray, ql: float, qs: float, r: float, smooth: bool = True):
    """Filtered means, smoothed means and smoothed (level variance) of one series.

    The path of states is one Gaussian whose precision matrix is block
    tridiagonal: the prior and the readings sit on the diagonal, and a step over a
    gap of g weeks adds M'WM, W and -M'W with M = [[1, g], [0, 1]] and
    W = diag(1 / (ql g), 1 / (qs g)).  Eliminating the blocks from the first to the last
    gives the filter (the precision of a state given the past); substituting
    back gives the smoother.
    """
    n, w = len(z), 1.0 / (r * r)
    gaps = np.maximum(1.0, np.diff(weeks))
    wl, ws = 1.0 / (ql * gaps), 1.0 / (qs * gaps)
    filtered = np.empty((n, 2))
    folded = []  # per step: inverse of (precision so far + M'WM), and its right-hand side
    pa, pb, pd_, ga, gb = 1.0 + w, 0.0, 1.0, z[0] + w * z[0], 0.0
    for i in range(n):
        va, vb, vd = _inverse(pa, pb, pd_)
        filtered[i] = va * ga + vb * gb, vb * ga + vd * gb
        if i == n - 1:
            break
        g, u, v = gaps[i], wl[i], ws[i]
        ia, ib, id_ = _inverse(pa + u, pb + u * g, pd_ + u * g * g + v)
        folded.append((ia, ib, id_, ga, gb))
        # rows of W M: (u, u g) and (0, v)
        la, lb = u * (ia + g * ib), u * (ib + g * id_)
        pa, pb, pd_ = u - (la * u + lb * u * g) + w, -lb * v, v - v * id_ * v
        ga, gb = la * ga + lb * gb + w * z[i + 1], v * (ib * ga + id_ * gb)
    if not smooth:
        return filtered, None, None
    means, variance = filtered.copy(), np.empty(n)
    variance[-1], (sa, sb, sd) = va, (va, vb, vd)
    for i in range(n - 2, -1, -1):
        ia, ib, id_, ga, gb = folded[i]
        g, u, v = gaps[i], wl[i], ws[i]
        nxt = means[i + 1]
        ha, hb = ga + u * nxt[0], gb + u * g * nxt[0] + v * nxt[1]
        means[i] = ia * ha + ib * hb, ib * ha + id_ * hb
        # K = inverse * M'W carries the next state's covariance back
        k00, k01, k10, k11 = u * (ia + g * ib), v * ib, u * (ib + g * id_), v * id_
        sa, sb, sd = (ia + k00 * k00 * sa + 2 * k00 * k01 * sb + k01 * k01 * sd,
                      ib + k00 * k10 * sa + (k00 * k11 + k01 * k10) * sb + k01 * k11 * sd,
                      id_ + k10 * k10 * sa + 2 * k10 * k11 * sb + k11 * k11 * sd)
        variance[i] = sa
    return filtered, means, variance


def first_state(z: float, r: float) -> tuple:
    """Precision and right-hand side of a series' state after its first reading (see ``local_trend``)."""
    w = 1.0 / (r * r)
    return 1.0 + w, 0.0, 1.0, z + w * z, 0.0


def next_state(state: tuple, gap: float, z: float, ql: float, qs: float, r: float) -> tuple:
    """The state after one more reading *gap* weeks later: one elimination step of ``local_trend``."""
    pa, pb, pd_, ga, gb = state
    g = max(1.0, gap)
    w, u, v = 1.0 / (r * r), 1.0 / (ql * g), 1.0 / (qs * g)
    ia, ib, id_ = _inverse(pa + u, pb + u * g, pd_ + u * g * g + v)
    la, lb = u * (ia + g * ib), u * (ib + g * id_)
    return (u - (la * u + lb * u * g) + w, -lb * v, v - v * id_ * v,
            la * ga + lb * gb + w * z, v * (ib * ga + id_ * gb))


def state_mean(state: tuple) -> tuple[float, float]:
    """Filtered level and slope of a state."""
    va, vb, vd = _inverse(*state[:3])
    return va * state[3] + vb * state[4], vb * state[3] + vd * state[4]


def kalman_smooth(weekly: DataFrame, keys=("location", "pest"), value: str = "value",
                  q_level: float = Q_LEVEL, q_slope: float = Q_SLOPE, r_obs: float = R_OBS) -> DataFrame:
    """W8 + W9: filtered level/slope, smoothed level and a +-2 sigma band per week.

    Output (counts): ``est = expm1(level)``, ``lo/hi = expm1(level -+ 2 std)``
    with ``std = sqrt(max(smoothed level variance, 0) + var_pop(z - level))``.
    """
    keys = list(keys)
    key_fields = [f for f in weekly.schema.fields if f.name in keys]
    schema = (", ".join(f"{f.name} {f.dataType.simpleString()}" for f in key_fields)
              + ", week_id long, value double, level_f double, slope_f double, level double, slope double, "
                "est double, lo double, hi double")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("week_id")
        weeks = pdf["week_id"].to_numpy(dtype=float)
        vals = pdf[value].to_numpy(dtype=float)
        z = np.log1p(vals)
        xf, xs, var = local_trend(weeks, z, q_level, q_slope, r_obs)
        level = xs[:, 0]
        std = np.sqrt(var.clip(0) + float(np.var(z - level)))
        out = pd.DataFrame({k: pdf[k].to_numpy() for k in keys})
        out["week_id"] = pdf["week_id"].to_numpy(dtype="int64")
        out["value"] = vals
        out["level_f"], out["slope_f"] = xf[:, 0], xf[:, 1]
        out["level"], out["slope"] = level, xs[:, 1]
        out["est"] = np.expm1(level)
        out["lo"], out["hi"] = np.expm1(level - 2 * std), np.expm1(level + 2 * std)
        return out

    src = weekly.select(*keys, F.col("week_id").cast("long"), F.col(value).cast("double").alias(value))
    return src.groupBy(*keys).applyInPandas(run, schema)
