"""What-if scenarios, batch forecasts and season profiles.

The reference answers one request at a time; here every (series, week,
scenario) request is a row, so a whole season for every series and every
scenario is one Spark job.  Scenario tables are DataFrames given by the
user, of any length; climatology rows are a (location x week) dimension.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agroframe.operators.baseline import band_names, band_of
from agroframe.operators.panel import WEATHER
from agroframe.operators.ranking import rank_within

TEMP_VARS = ("maxt_c", "mint_c")
RAIN_VARS = ("rf_mm",)
HUMID_VARS = ("rh1_pct", "rh2_pct")
# Slider bounds of the scenario inputs.
TEMP_RANGE, RAIN_RANGE, HUMID_RANGE = (-5.0, 5.0), (0.0, 3.0), (-20.0, 20.0)


def scenarios(spark, rows) -> DataFrame:
    """Scenario table (scenario_id, temp_off, rain_mult, humid_off), inputs range-checked."""
    rows = list(rows)
    for _, t, r, h in rows:
        if not (TEMP_RANGE[0] <= t <= TEMP_RANGE[1] and RAIN_RANGE[0] <= r <= RAIN_RANGE[1]
                and HUMID_RANGE[0] <= h <= HUMID_RANGE[1]):
            raise ValueError(f"scenario out of range: {(t, r, h)}")
    return spark.createDataFrame([(int(i), float(t), float(r), float(h)) for i, t, r, h in rows],
                                 "scenario_id int, temp_off double, rain_mult double, humid_off double")


def checked_scenarios(table: DataFrame) -> DataFrame:
    """A table (scenario_id, temp_off, rain_mult, humid_off) of any length, whose inputs are range-checked where they lie."""
    inside = (F.col("temp_off").between(*TEMP_RANGE) & F.col("rain_mult").between(*RAIN_RANGE) & F.col("humid_off").between(*HUMID_RANGE))
    wrong = table.where(~F.coalesce(inside, F.lit(False))).select("scenario_id").limit(3).collect()
    if wrong:
        raise ValueError(f"scenarios out of range: {[r.scenario_id for r in wrong]}")
    return table.select("scenario_id", *[F.col(c).cast("double").alias(c) for c in ("temp_off", "rain_mult", "humid_off")])


def apply_scenarios(features: DataFrame, scen: DataFrame) -> DataFrame:
    """Shift lag1/roll4 weather features by each scenario (trend untouched).

    temperature + offset; rainfall x multiplier floored at 0 (a missing value
    becomes 0, as max(0, NaN) does); humidity + offset clipped to 0..100 and
    kept missing when missing.
    """
    j = features.crossJoin(scen)  # every request under every scenario; the measured sizes decide the join
    cols = {}
    for c in WEATHER:
        for kind in ("lag1", "roll4"):
            f = f"{c}_{kind}"
            if f not in features.columns:
                continue
            x = F.col(f)
            if c in TEMP_VARS:
                cols[f] = x + F.col("temp_off")
            elif c in RAIN_VARS:
                cols[f] = F.greatest(F.lit(0.0), x * F.col("rain_mult"))
            elif c in HUMID_VARS:
                cols[f] = F.when(x.isNotNull(), F.least(F.greatest(x + F.col("humid_off"), F.lit(0.0)),
                                                        F.lit(100.0)))
    return j.withColumns(cols)


def banded_forecast(pred: DataFrame, cutoffs: DataFrame, y_log: str = "y_log") -> DataFrame:
    """M4 tail: expm1, clamp at 0 for display, band on the unclamped count."""
    j = pred.join(cutoffs, ["location", "pest"], "left")
    cnt = F.round(F.expm1(F.col(y_log)), 9)
    return j.withColumns({"count": F.greatest(F.lit(0.0), cnt), "band": band_names()[band_of(cnt)]})


def season_weeks(active: DataFrame) -> DataFrame:
    """J12 spine: every week between the first and last active week of a series.

    ``is_active`` marks monitored weeks; the rest are gap weeks whose
    prediction is left NULL (the chart breaks there).
    """
    return (active.select("location", "pest", "weeks",
                          F.explode(F.sequence(F.array_min("weeks"), F.array_max("weeks"))).alias("standard_week"))
            .withColumn("is_active", F.array_contains("weeks", F.col("standard_week")))
            .drop("weeks"))


def season_profile(spine: DataFrame, predictions: DataFrame, cutoffs: DataFrame,
                   keys=("location", "pest", "standard_week")) -> DataFrame:
    """Predicted count for active weeks, NULL for gaps, cut-offs repeated."""
    j = (spine.join(predictions, list(keys), "left")
         .join(cutoffs, ["location", "pest"], "left"))
    return j.withColumn("predicted", F.when(F.col("is_active"), F.col("count")))


def forecast_batch(model, requests: DataFrame, by_week: DataFrame, glob: DataFrame, scen: DataFrame,
                   cutoffs: DataFrame) -> DataFrame:
    """M4: every (series, week) request under every scenario in one job.

    requests (crop, location, pest, standard_week) -> climatology row of the
    week at the location, else the global row (J5) -> scenario offsets (P24)
    -> the fitted pipeline -> expm1, clamp, band (P25).
    """
    from agroframe.operators.baseline import climatology_lookup
    from agroframe.operators.models import predict_severity

    rows = apply_scenarios(climatology_lookup(requests, by_week, glob), scen)
    return banded_forecast(predict_severity(model, rows), cutoffs)


def feature_cols(panel: DataFrame, feats) -> DataFrame:
    """(position, column) of the pooled model's inputs: features, week, then one column per crop, location and pest, sorted."""
    spark = panel.sparkSession
    first = spark.createDataFrame([(0, i, c) for i, c in enumerate([*feats, "standard_week"])], "part int, place int, column string")
    levels = F.explode(F.array(*[F.struct(F.lit(k + 1).alias("part"), F.concat(F.lit(f"{c}_"), F.col(c)).alias("column"))
                                 for k, c in enumerate(("crop", "location", "pest"))]))
    hot = panel.select(levels.alias("l")).select("l.part", F.lit(0).alias("place"), "l.column").distinct()
    ranked = rank_within(first.unionByName(hot), [], ["part", "place", "column"], out="position")
    return ranked.select((F.col("position") - 1).cast("int").alias("position"), "column")


BUNDLE = ("feature_cols", "features", "feat_clim", "feat_clim_global", "band_cutoffs", "endemic", "series_list", "active_weeks", "units",
          "obs_series")


def build_bundle(panel: DataFrame, clean: DataFrame, endemic_thr: float | None = None) -> dict[str, DataFrame]:
    """The forecast lookup tables from one panel (with ``is_train``) and the cleaned readings.

    The panel is read by most entries: pass a materialized one.
    """
    from agroframe.operators import baseline as B
    from agroframe.operators import panel as P

    by_week, glob = B.feature_climatology(panel)
    train = panel.filter("is_train")
    names = panel.sparkSession.createDataFrame([(i, c) for i, c in enumerate(P.BASE_FEATS)], "position int, feature string")
    return {
        "feature_cols": feature_cols(panel, P.BASE_FEATS),
        "features": names,
        "feat_clim": by_week,
        "feat_clim_global": glob,
        "band_cutoffs": B.band_cutoffs(panel),
        "endemic": B.endemic_series(train) if endemic_thr is None else B.endemic_series(train, endemic_thr),
        "series_list": panel.select("crop", "location", "pest").distinct(),
        "active_weeks": P.active_weeks(panel),
        "units": P.series_units(clean),
        "obs_series": P.observed_series(clean),
    }


def forecast_from_saved(spark, model_path: str, bundle_root: str, requests: DataFrame, scen: DataFrame) -> DataFrame:
    """M4 from artefacts: the saved pipeline and bundle answer (crop, location, pest, standard_week) requests."""
    from pyspark.ml import PipelineModel

    from agroframe.sources.files import read_bundle

    b = read_bundle(spark, bundle_root, BUNDLE)
    return forecast_batch(PipelineModel.load(model_path), requests, b["feat_clim"], b["feat_clim_global"], scen,
                          b["band_cutoffs"])
