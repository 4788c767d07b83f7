"""Registered evaluation / forecast queries of the pest track.

Metrics are checked on the deterministic baseline predictions (seasonal
climatology and flat mean), which SQL can reproduce exactly; the boosted
tree models are registered separately (rows-only).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agroframe.operators import baseline as B
from agroframe.operators import forecast as FC
from agroframe.operators import metrics as M
from agroframe.operators import panel as P
from agroframe.plans import pest_sql as S
from agroframe.plans.pest import AW_CTE, FCLIM_CTES, SPLIT, panel, split_panel
from agroframe.plans.registry import finish, query
from agroframe.session import materialize

FX = ("fx_panel",)
MODELS = ["seas", "flat"]
# Fixed scenario inputs for the what-if checks (user parameters, not data).
SCENARIOS = [(0, 0.0, 1.0, 0.0), (1, 2.0, 1.0, 0.0), (2, -3.0, 0.5, -10.0), (3, 5.0, 3.0, 20.0),
             (4, -5.0, 0.0, -20.0)]

EVAL_CTES = SPLIT + [
    "ev AS (SELECT s.*, coalesce(e.endemic, false) AS endemic FROM seas s LEFT JOIN endem e "
    "ON s.location = e.location AND s.pest = e.pest)",
    f"te AS (SELECT * FROM ev WHERE year >= {S.SPLIT_YEAR_Q})",
    "lg AS (SELECT 'seas' AS model, y, seas AS p, endemic, pest_value, location, pest FROM te "
    "UNION ALL SELECT 'flat', y, flat, endemic, pest_value, location, pest FROM te)",
    "trc AS (SELECT location, pest, quantile_cont(pest_value, 1/3) AS q1, quantile_cont(pest_value, 2/3) AS q2 "
    "FROM tr GROUP BY location, pest)",
    f"bd AS (SELECT l.model, {S.band_sql('round(exp(l.y) - 1, 9)')} AS true_band, "
    f"{S.band_sql('round(exp(l.p) - 1, 9)')} AS pred_band FROM lg l LEFT JOIN trc c "
    "ON l.location = c.location AND l.pest = c.pest)",
]


def evaluated(spark, sf, p: DataFrame | None = None) -> DataFrame:
    """Test rows with both baseline predictions and the endemic block."""
    p = split_panel(spark, sf) if p is None else p
    tr = p.filter("is_train")
    e = B.with_endemic(B.with_seasonal_baseline(p, tr).crossJoin(F.broadcast(B.flat_baseline(tr).select("flat"))),
                       B.endemic_series(tr, S.ENDEMIC_Q))
    return (e.filter(~F.col("is_train"))
            .withColumn("block", F.when(F.col("endemic"), "ENDEMIC").otherwise("EPISODIC")))


def banded(spark, sf) -> DataFrame:
    p = split_panel(spark, sf)
    cut = B.band_cutoffs_all(p.filter("is_train"))
    t = evaluated(spark, sf, p).join(cut, ["location", "pest"], "left")
    return t.withColumns({"true_band": B.band_of(F.round(F.expm1("y"), 9)),
                          "seas_band": B.band_of(F.round(F.expm1("seas"), 9)),
                          "flat_band": B.band_of(F.round(F.expm1("flat"), 9))})


@query("error_blocks",
       "SELECT block, model, count(*) AS n, round(round(avg(abs(y - p)), 9), 6) AS mae, "
       "round(round(CASE WHEN var_pop(y) > 0 THEN 1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) "
       "WHEN sum((y - p) * (y - p)) = 0 THEN 1.0 ELSE 0.0 END, 9), 6) AS r2 FROM ("
       "SELECT 'ALL' AS block, model, y, p FROM lg UNION ALL "
       "SELECT CASE WHEN endemic THEN 'ENDEMIC' ELSE 'EPISODIC' END, model, y, p FROM lg) b GROUP BY block, model",
       FX, EVAL_CTES)
def error_blocks(spark, sf):
    """MAE and R^2 on test rows per block (ALL / ENDEMIC / EPISODIC) and model."""
    return finish(M.regression_report(evaluated(spark, sf), "y", MODELS, block="block"))


@query("median_abs_error", "SELECT model, count(*) AS n, round(round(quantile_cont(abs((exp(p) - 1) - (exp(y) - 1)), "
       "0.5), 9), 6) AS median_abs_err FROM lg GROUP BY model", FX, EVAL_CTES)
def median_abs_error(spark, sf):
    """Exact median absolute error in counts per model."""
    return finish(M.median_abs_error(evaluated(spark, sf), "y", MODELS))


@query("median_abs_error_sketched", "SELECT model, count(*) AS n, round(round(quantile_cont(abs((exp(p) - 1) - (exp(y) - 1)), "
       "0.5), 9), 6) AS median_abs_err FROM lg GROUP BY model", FX, EVAL_CTES)
def median_abs_error_sketched(spark, sf):
    """A29 on unbounded models: a sketch per model and year, merged, and one counting pass."""
    return finish(M.median_abs_error_sketched(materialize(evaluated(spark, sf)), "y", MODELS, batch="year", k=200))


@query("band_accuracy", "SELECT model, round(round(avg(CASE WHEN true_band = pred_band THEN 1.0 ELSE 0.0 END), 9), 6) "
       "AS accuracy, count(*) AS n FROM bd GROUP BY model", FX, EVAL_CTES)
def band_accuracy(spark, sf):
    """Share of test rows whose predicted band equals the true band."""
    b = banded(spark, sf)
    long = b.select("true_band", "seas_band", "flat_band").unpivot(
        ["true_band"], ["seas_band", "flat_band"], "model", "pred_band")
    long = long.withColumn("model", F.regexp_replace("model", "_band$", ""))
    return finish(M.accuracy(long, "true_band", "pred_band", keys=["model"]))


@query("band_confusion", "SELECT l.label, "
       + ", ".join(f"cast(coalesce(sum(CASE WHEN bd.pred_band = {k} THEN 1 END), 0) AS bigint) AS pred_{k}"
                   for k in range(3))
       + " FROM (SELECT 0 AS label UNION ALL SELECT 1 UNION ALL SELECT 2) l LEFT JOIN bd "
         "ON bd.true_band = l.label AND bd.model = 'seas' GROUP BY l.label", FX, EVAL_CTES)
def band_confusion(spark, sf):
    """Complete 3 x 3 band confusion (seasonal model), missing cells 0."""
    out = M.confusion_matrix(banded(spark, sf), "true_band", "seas_band", [0, 1, 2])
    return out.withColumn("label", F.col("label").cast("int"))


def _scen_sql() -> str:
    vals = ", ".join(f"({i}, {t}, {r}, {h})" for i, t, r, h in SCENARIOS)
    cols = []
    for c in P.WEATHER:
        for kind in P.FEATURE_KINDS:
            f = f"c.{c}_{kind}"
            if kind == "trend":
                e = f
            elif c in FC.TEMP_VARS:
                e = f"{f} + s.temp_off"
            elif c in FC.RAIN_VARS:
                e = f"greatest(0.0, {f} * s.rain_mult)"
            elif c in FC.HUMID_VARS:
                e = f"CASE WHEN {f} IS NULL THEN NULL ELSE least(greatest({f} + s.humid_off, 0.0), 100.0) END"
            else:
                e = f
            cols.append(f"round(round({e}, 9), 6) AS {c}_{kind}")
    return (f"SELECT c.location, c.standard_week, s.scenario_id, {', '.join(cols)} FROM fclim c CROSS JOIN "
            f"(SELECT * FROM (VALUES {vals}) v(scenario_id, temp_off, rain_mult, humid_off)) s")


@query("scenario_features", _scen_sql(), FX, S.panel_ctes() + FCLIM_CTES)
def scenario_features(spark, sf):
    """Every (location, week) climatology row under every what-if scenario."""
    by_week, _ = B.feature_climatology(panel(spark, sf))
    scen = FC.checked_scenarios(FC.scenarios(spark, SCENARIOS))
    out = FC.apply_scenarios(by_week, scen)
    return finish(out.select("location", "standard_week", "scenario_id", *P.BASE_FEATS))


@query("season_profile",
       "SELECT sw.location, sw.pest, cast(sw.standard_week AS int) AS standard_week, "
       "list_contains(sw.weeks, sw.standard_week) AS is_active, "
       "CASE WHEN list_contains(sw.weeks, sw.standard_week) THEN "
       "round(round(greatest(0.0, round(exp(coalesce(c.clim, f.flat)) - 1, 9)), 9), 6) END AS predicted, "
       "round(round(k.q1, 9), 6) AS q1, round(round(k.q2, 9), 6) AS q2 "
       "FROM (SELECT location, pest, weeks, unnest(generate_series(list_min(weeks), list_max(weeks))) "
       "AS standard_week FROM aw) sw LEFT JOIN clim c ON c.location = sw.location AND c.pest = sw.pest "
       "AND c.standard_week = sw.standard_week CROSS JOIN flat f LEFT JOIN cuts k ON k.location = sw.location "
       "AND k.pest = sw.pest", FX, SPLIT + [AW_CTE])
def season_profile(spark, sf):
    """A whole season per series; gap weeks NULL; cut-offs repeated.

    The predictor here is the seasonal climatology (deterministic); the
    model-based profile uses the same spine with ``forecast`` predictions.
    """
    p = split_panel(spark, sf)
    tr = p.filter("is_train")
    spine = FC.season_weeks(P.active_weeks(p))
    clim = B.seasonal_climatology(tr).select("location", "pest", "standard_week", "clim")
    pred = (spine.select("location", "pest", "standard_week").join(clim, ["location", "pest", "standard_week"], "left")
            .crossJoin(F.broadcast(B.flat_baseline(tr).select("flat")))
            .withColumn("y_log", F.coalesce("clim", "flat")))
    pred = FC.banded_forecast(pred, B.band_cutoffs(p)).select("location", "pest", "standard_week", "count")
    out = FC.season_profile(spine, pred, B.band_cutoffs(p))
    return finish(out.select("location", "pest", "standard_week", "is_active", "predicted", "q1", "q2"))
