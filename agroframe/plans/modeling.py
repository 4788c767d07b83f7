"""Registered model queries (rows-only: boosted trees have no SQL twin).

The reports are checked in the tests by SQL over the stored predictions and
the stored trees.  The pooled model's queries fit fewer rounds at a higher rate
(``POOLED_ROUNDS``) than the reference settings, which stay the operator's defaults:
a round is several Spark jobs, whatever the size of the data.
"""

from __future__ import annotations

import hashlib

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from agroframe.operators import baseline as B
from agroframe.operators import boosting as BO
from agroframe.operators import forecast as FC
from agroframe.operators import metrics as M
from agroframe.operators import models as MD
from agroframe.operators import panel as P
from agroframe.operators import splits as SP
from agroframe.plans import evaluation as EV
from agroframe.plans import pest_sql as S
from agroframe.plans import sensor as SN
from agroframe.plans.pest import PANEL, split_panel
from agroframe.plans.registry import finish, query
from agroframe.session import kept, materialize

HEALTH_FEATURES = ["temperature_c", "humidity_pct", "soil_moisture_raw", "nitrogen", "phosphorus", "potassium",
                   "days_planted"]
POOLED_ROUNDS = dict(max_iter=60, rate=0.12)


def _saved(name: str, spark, sf: str, fit) -> PipelineModel:
    """The pipeline that *fit* returns, fitted and saved once per session and table folder (several reports read one fit)."""
    key = f"{name}-{hashlib.md5(sf.encode()).hexdigest()}"
    return PipelineModel.load(kept(spark, key, lambda path: fit().write().save(path)))


def _health_split(spark, sf):
    return SP.stratified_split(SN.labelled(spark, sf), "health_label", "row_id", 0.2, seed=42)


def _health(spark, sf):
    """The fitted health classifier and its test rows."""
    split = _health_split(spark, sf)
    model = _saved("health", spark, sf, lambda: MD.fit_compact(
        MD.health_pipeline(HEALTH_FEATURES, **MD.HEALTH_GBT), split.filter(F.col("split") == "train"), "health_label"))
    return model, split.filter(F.col("split") == "test")


def health_predictions(spark, sf):
    """The classifier's stored predictions on the test rows."""
    model, test = _health(spark, sf)
    return materialize(model.transform(test).select("row_id", "health_label", F.col("prediction").cast("int").alias("prediction")),
                       "health-pred")


def _importance(spark, model, rows, n):
    top = MD.top_features(model, rows, n)
    return finish(spark.createDataFrame([(i + 1, k, v) for i, (k, v) in enumerate(top)],
                                        "rank int, feature string, importance double"))


@query("health_model")
def health_model(spark, sf):
    """M1 + A27: 80/20 stratified split, GBT classifier, test classification report."""
    return finish(M.classification_report(health_predictions(spark, sf), "health_label", "prediction"))


@query("health_confusion")
def health_confusion(spark, sf):
    """M1 + A27: confusion matrix of the fitted classifier on the test rows."""
    return M.confusion_matrix(health_predictions(spark, sf), "health_label", "prediction", [0, 1])


@query("health_importance")
def health_importance(spark, sf):
    """M1 + T4: the ten most important features."""
    model, test = _health(spark, sf)
    return _importance(spark, model, test, 10)


def _pooled(spark, sf):
    """The split panel and the pooled severity model fitted on its training rows."""
    p = split_panel(spark, sf)
    return p, _saved("pooled", spark, sf, lambda: MD.fit_severity(p.filter("is_train"), **{**MD.POOLED_GBT, **POOLED_ROUNDS}))


def pooled_predictions(spark, sf):
    """The stored test rows with the pooled model's and both baselines' predictions and their block."""
    p, model = _pooled(spark, sf)
    tr = p.filter("is_train")
    test = B.with_seasonal_baseline(MD.predict_severity(model, p.filter("not is_train")), tr)
    test = B.with_endemic(test, B.endemic_series(tr, S.ENDEMIC_Q))
    test = test.withColumn("block", F.when(F.col("endemic"), "ENDEMIC").otherwise("EPISODIC")) \
        .crossJoin(F.broadcast(B.flat_baseline(tr).select(F.col("flat").alias("flat_mean"))))  # one row
    return materialize(test, "pooled-pred")


@query("pooled_evaluation")
def pooled_evaluation(spark, sf):
    """M3 + A28: pooled model against the seasonal and flat baselines on the test rows, per block."""
    return finish(M.regression_report(pooled_predictions(spark, sf), "y", ["y_log", "seas", "flat_mean"], block="block"))


@query("severity_forecast")
def severity_forecast(spark, sf):
    """M3 + M4 + M5 + J5 + P24 + P25: pooled model, then every active week of
    every series under every scenario, banded against the series cut-offs."""
    p, model = _pooled(spark, sf)
    by_week, glob = B.feature_climatology(p)
    series = p.select("crop", "location", "pest").distinct()
    weeks = P.active_weeks(p).select("location", "pest", F.explode("weeks").alias("standard_week"))
    req = series.join(weeks, ["location", "pest"])
    out = FC.forecast_batch(model, req, by_week, glob, FC.scenarios(spark, EV.SCENARIOS), B.band_cutoffs(p))
    return finish(out.select("crop", "location", "pest", "standard_week", "scenario_id", "y_log", "count", "band"))


BASELINES = ("flat", "seasonal")
FLAGSHIP_MODELS = (*BASELINES, "y_log")


def _series_split(spark, sf):
    """The panel with the first 75 % of every series' weeks as training rows, written once."""
    return materialize(B.time_fraction_split(split_panel(spark, sf).drop("is_train"), frac=0.75), "series-split")


def _series_scored(rows, models=None):
    """The test rows of every series with its flat mean, week-of-year mean and model, and their risk bands."""
    tr, te = rows.filter("is_train"), rows.filter("not is_train")
    keys = list(BO.SERIES)
    seas = tr.groupBy(*keys, "standard_week").agg(F.avg("y").alias("clim"))
    flat = tr.groupBy(*keys).agg(F.avg("y").alias("flat"))
    scored = te if models is None else BO.score_series(te, models)
    scored = (scored.join(seas, [*keys, "standard_week"], "left").join(flat, keys)
              .withColumn("seasonal", F.coalesce("clim", "flat"))
              .join(B.band_cutoffs_all(tr, keys), keys, "left"))
    for y in ("y", *(BASELINES if models is None else FLAGSHIP_MODELS)):
        scored = scored.withColumn(f"band_{y}", B.band_of(F.round(F.expm1(y), 9)))
    return scored


def _series_models(spark, sf):
    """The split rows and the stored model table: every series fitted in one grouped job."""
    rows = _series_split(spark, sf)
    key = f"series-models-{hashlib.md5(sf.encode()).hexdigest()}"
    path = kept(spark, key, lambda to: BO.fit_series(rows.filter("is_train"), **MD.FLAGSHIP_GBT).write.parquet(to))
    return rows, spark.read.parquet(path)


def series_predictions(spark, sf):
    """The stored test rows of every series with all predictions and bands."""
    return materialize(_series_scored(*_series_models(spark, sf)), "series-pred")


@query("flagship_model")
def flagship_model(spark, sf):
    """M2 + A28-A30 for every viable series: MAE and R2 on the log scale, median absolute error in counts and band
    accuracy of its flat mean, week-of-year mean and own model on the last 25 % of its weeks."""
    return finish(M.series_report(series_predictions(spark, sf), BO.SERIES, "y", FLAGSHIP_MODELS))


_BANDS = ", ".join(f"{S.band_sql(f'round(exp({m}) - 1, 9)')} AS band_{m}" for m in ("y", *BASELINES))


@query("series_baselines", " UNION ALL ".join(
    f"SELECT crop, location, pest, '{m}' AS model, count(*) AS n, round(round(avg(abs(y - {m})), 9), 6) AS mae, "
    f"round(round(CASE WHEN var_pop(y) > 1e-12 THEN 1 - sum((y - {m}) * (y - {m})) / (var_pop(y) * count(*)) "
    f"WHEN sum((y - {m}) * (y - {m})) <= 1e-12 THEN 1 ELSE 0 END, 9), 6) AS r2, "
    f"round(round(quantile_cont(abs(exp({m}) - exp(y)), 0.5), 9), 6) AS median_abs_err, "
    f"round(round(avg(CASE WHEN band_y = band_{m} THEN 1.0 ELSE 0.0 END), 9), 6) AS band_accuracy "
    f"FROM banded GROUP BY crop, location, pest" for m in BASELINES), ("fx_panel",), [
    *PANEL,
    "numbered AS (SELECT *, row_number() OVER (PARTITION BY crop, location, pest ORDER BY week_id) <= "
    "floor(count(*) OVER (PARTITION BY crop, location, pest) * 0.75) AS is_train FROM panel)",
    "strain AS (SELECT * FROM numbered WHERE is_train)",
    "sclim AS (SELECT crop, location, pest, standard_week, avg(y) AS clim FROM strain GROUP BY ALL)",
    "sflat AS (SELECT crop, location, pest, avg(y) AS flat, quantile_cont(pest_value, 1/3) AS q1, "
    "quantile_cont(pest_value, 2/3) AS q2 FROM strain GROUP BY ALL)",
    "sbase AS (SELECT n.crop, n.location, n.pest, n.y, f.flat, coalesce(c.clim, f.flat) AS seasonal, q1, q2 FROM numbered n "
    "JOIN sflat f USING (crop, location, pest) LEFT JOIN sclim c USING (crop, location, pest, standard_week) WHERE NOT is_train)",
    f"banded AS (SELECT *, {_BANDS} FROM sbase)"])
def series_baselines(spark, sf):
    """A28-A30 for every viable series: the baselines' part of ``flagship_model``'s report."""
    return finish(M.series_report(_series_scored(_series_split(spark, sf)), BO.SERIES, "y", BASELINES))


@query("flagship_confusion")
def flagship_confusion(spark, sf):
    """M2 + A30: 3 x 3 confusion of the risk bands on the test weeks of all series."""
    return M.confusion_matrix(series_predictions(spark, sf), "band_y", "band_y_log", [0, 1, 2])


@query("flagship_importance")
def flagship_importance(spark, sf):
    """M2 + T4: the eight most important features of every series' model."""
    return finish(BO.feature_ranks(_series_models(spark, sf)[1], 8))
