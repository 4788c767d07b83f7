"""Registered Kalman filter / smoother queries with recursive-CTE oracles."""

from __future__ import annotations


from agroframe.operators import panel as P
from agroframe.operators import smoothing as K
from agroframe.operators.long_smoothing import smooth_long
from agroframe.plans import pest_sql as S
from agroframe.plans.pest import OBS_CTE, clean
from agroframe.plans.registry import finish, query

QL, QS, R2 = K.Q_LEVEL, K.Q_SLOPE, K.R_OBS ** 2


def _forward_step() -> list[str]:
    t = "greatest(cast(1 AS double), cast(s.week_id - f.week_id AS double))"
    xp0 = f"(f.x0 + {t} * f.x1)"
    ap = f"(f.a + 2 * {t} * f.b + {t} * {t} * f.d + {QL} * {t})"
    bp = f"(f.b + {t} * f.d)"
    dp = f"(f.d + {QS} * {t})"
    k0 = f"({ap} / ({ap} + {R2}))"
    k1 = f"({bp} / ({ap} + {R2}))"
    innov = f"(s.z - {xp0})"
    return [f"{xp0} + {k0} * {innov}", f"f.x1 + {k1} * {innov}", f"(1 - {k0}) * {ap}",
            f"(1 - {k0}) * {bp}", f"{dp} - {k1} * {bp}"]


def _backward_step() -> list[str]:
    t = "greatest(cast(1 AS double), cast(k.week_id - f.week_id AS double))"
    a, b, d = "f.a", "f.b", "f.d"
    pa = f"({a} + 2 * {t} * {b} + {t} * {t} * {d} + {QL} * {t})"
    pb = f"({b} + {t} * {d})"
    pd_ = f"({d} + {QS} * {t})"
    det = f"({pa} * {pd_} - {pb} * {pb})"
    c00 = f"((({a} + {t} * {b}) * {pd_} - {b} * {pb}) / {det})"
    c01 = f"(({b} * {pa} - ({a} + {t} * {b}) * {pb}) / {det})"
    c10 = f"((({b} + {t} * {d}) * {pd_} - {d} * {pb}) / {det})"
    c11 = f"(({d} * {pa} - ({b} + {t} * {d}) * {pb}) / {det})"
    dx0 = f"(k.xs0 - (f.x0 + {t} * f.x1))"
    dx1 = f"(k.xs1 - f.x1)"
    m00, m01, m11 = f"(k.s00 - {pa})", f"(k.s01 - {pb})", f"(k.s11 - {pd_})"
    return [f"f.x0 + {c00} * {dx0} + {c01} * {dx1}",
            f"f.x1 + {c10} * {dx0} + {c11} * {dx1}",
            f"{a} + {c00} * {c00} * {m00} + 2 * {c00} * {c01} * {m01} + {c01} * {c01} * {m11}",
            f"{b} + {c00} * {c10} * {m00} + ({c00} * {c11} + {c01} * {c10}) * {m01} + {c01} * {c11} * {m11}",
            f"{d} + {c10} * {c10} * {m00} + 2 * {c10} * {c11} * {m01} + {c11} * {c11} * {m11}"]


KF_CTES = [
    S.clean_cte(), OBS_CTE,
    "s AS (SELECT location, pest, week_id, value, ln(1 + value) AS z, "
    "row_number() OVER (PARTITION BY location, pest ORDER BY week_id) AS rn, "
    "count(*) OVER (PARTITION BY location, pest) AS n FROM obs)",
    "kf(location, pest, rn, week_id, z, x0, x1, a, b, d) AS ("
    f"SELECT location, pest, rn, week_id, z, cast(z AS double), cast(0 AS double), "
    f"cast(1 - 1 / (1 + {R2}) AS double), cast(0 AS double), cast(1 AS double) FROM s WHERE rn = 1 "
    "UNION ALL SELECT s.location, s.pest, s.rn, s.week_id, s.z, " + ", ".join(_forward_step())
    + " FROM kf f JOIN s ON s.location = f.location AND s.pest = f.pest AND s.rn = f.rn + 1)",
]
KS_CTES = KF_CTES + [
    "ks(location, pest, rn, week_id, xs0, xs1, s00, s01, s11) AS ("
    "SELECT f.location, f.pest, f.rn, f.week_id, f.x0, f.x1, f.a, f.b, f.d FROM kf f JOIN s "
    "ON s.location = f.location AND s.pest = f.pest AND s.rn = f.rn WHERE f.rn = s.n "
    "UNION ALL SELECT f.location, f.pest, f.rn, f.week_id, " + ", ".join(_backward_step())
    + " FROM ks k JOIN kf f ON f.location = k.location AND f.pest = k.pest AND f.rn = k.rn - 1)",
    "band AS (SELECT k.location, k.pest, k.week_id, s.value, k.xs0 AS level, "
    "sqrt(greatest(k.s00, 0) + var_pop(s.z - k.xs0) OVER (PARTITION BY k.location, k.pest)) AS sd "
    "FROM ks k JOIN s ON s.location = k.location AND s.pest = k.pest AND s.rn = k.rn)",
]


def weekly_obs(spark, sf):
    return P.weekly_target(clean(spark, sf)).withColumnRenamed("pest_value", "value")


@query("kalman_filter", "SELECT location, pest, week_id, round(round(x0, 9), 6) AS level_f, "
       "round(round(x1, 9), 6) AS slope_f FROM kf", ("fx_panel",), KF_CTES, recursive=True)
def kalman_filter(spark, sf):
    """Forward (filtered) level and slope of every series."""
    return finish(K.kalman_smooth(weekly_obs(spark, sf)).select("location", "pest", "week_id", "level_f",
                                                                "slope_f"))


SMOOTH_SQL = ("SELECT location, pest, week_id, round(round(level, 9), 6) AS level, "
              "round(round(exp(level) - 1, 9), 6) AS est, round(round(exp(level - 2 * sd) - 1, 9), 6) AS lo, "
              "round(round(exp(level + 2 * sd) - 1, 9), 6) AS hi FROM band")


@query("kalman_smooth", SMOOTH_SQL, ("fx_panel",), KS_CTES, recursive=True)
def kalman_smooth(spark, sf):
    """RTS-smoothed level with the +-2 sigma predictive band, in counts."""
    return finish(K.kalman_smooth(weekly_obs(spark, sf)).select("location", "pest", "week_id", "level",
                                                                "est", "lo", "hi"))


@query("kalman_smooth_blocks", SMOOTH_SQL, ("fx_panel",), KS_CTES, recursive=True)
def kalman_smooth_blocks(spark, sf):
    """W8 + W9 by scans over blocks, here of a year, so that a series spans several."""
    return finish(smooth_long(weekly_obs(spark, sf), block_weeks=52).select("location", "pest", "week_id", "level", "est", "lo", "hi"))


@query("history_chart", "SELECT location, pest, round(round(week_id / 52.0, 9), 6) AS year_frac, "
       "round(round(value, 9), 6) AS observed, round(round(exp(level) - 1, 9), 6) AS est, "
       "round(round(exp(level - 2 * sd) - 1, 9), 6) AS lo, round(round(exp(level + 2 * sd) - 1, 9), 6) AS hi "
       "FROM (SELECT *, row_number() OVER (PARTITION BY location, pest ORDER BY week_id DESC) AS rn, "
       "count(*) OVER (PARTITION BY location, pest) AS n FROM band) b WHERE n >= 10 AND rn <= 120",
       ("fx_panel",), KS_CTES, recursive=True)
def history_chart(spark, sf):
    """W7 + W9: smoothed history of every series with >= 10 readings, last 120
    readings, on a fractional calendar-year axis (the history chart's data)."""
    from pyspark.sql import functions as F
    sm = K.kalman_smooth(weekly_obs(spark, sf))
    recent = P.recent_history(sm.select("location", "pest", "week_id", "value"))
    out = sm.join(recent.select("location", "pest", "week_id", "year_frac"), ["location", "pest", "week_id"])
    return finish(out.select("location", "pest", "year_frac", F.col("value").alias("observed"), "est", "lo", "hi"))
