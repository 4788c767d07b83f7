"""Stream = batch, model pipelines, and the driver entry points."""

import numpy as np
from pyspark.sql import functions as F

from conftest import SF_CHECK, SF_SMALL

import __spark_entry__ as E
import pytest

from agroframe.operators import metrics as M
from agroframe.operators import models as MD
from agroframe.operators import ood as O
from agroframe.operators import panel as P
from agroframe.operators.smoothing import kalman_smooth
from agroframe.plans import pest as PP
from agroframe.plans import sensor as PS
from agroframe.plans.registry import fx
from agroframe.streaming.live import live_check, run_available_now, scratch_path
from agroframe.streaming.online import latest, online_filter


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "maxt_c_roll4" in df.columns and "y" in df.columns


def test_live_check_stream_equals_batch(spark):
    src = scratch_path(spark, "readings")
    fx(spark, SF_SMALL, "fx_readings").write.parquet(src)
    stream = spark.readStream.schema(spark.read.parquet(src).schema).parquet(src)
    out = spark.read.parquet(run_available_now(live_check(stream), "live-test"))
    batch = live_check(spark.read.parquet(src))
    cols = ["event_id", "variable", "value", "ok", "status"]
    assert sorted(map(tuple, out.select(cols).collect()), key=str) == \
        sorted(map(tuple, batch.select(cols).collect()), key=str)


def _weekly_files(spark, path, files):
    """The weekly readings, each series spread over *files* in no order of weeks."""
    weekly = P.weekly_target(PP.clean(spark, SF_SMALL)).withColumnRenamed("pest_value", "value")
    weekly.repartition(files).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("files", [1, 4])
def test_online_filter_equals_batch_filter_in_any_order(spark, tmpdir_path, files):
    src = f"{tmpdir_path}/weekly"
    weekly = _weekly_files(spark, src, files)
    stream = spark.readStream.schema(weekly.schema).option("maxFilesPerTrigger", 1).parquet(src)
    raw = spark.read.parquet(run_available_now(online_filter(stream), "online-test"))
    assert raw.agg(F.max("revision")).first()[0] == files
    got = {(r.location, r.pest, r.week_id): r for r in latest(raw).collect()}
    want = kalman_smooth(weekly).collect()
    assert len(got) == len(want) == weekly.count() > 1000  # no reading is lost
    for r in want:
        g = got[r.location, r.pest, r.week_id]
        assert abs(g.level_f - r.level_f) < 1e-9 and abs(g.slope_f - r.slope_f) < 1e-9 and g.value == r.value


def test_online_filter_late_and_repeated_weeks(spark, tmpdir_path):
    schema = "location string, pest string, week_id long, value double"
    src = f"{tmpdir_path}/late"
    parts = [[("L", "p", 10, 5.0), ("L", "p", 12, 7.0)], [("L", "p", 8, 1.0), ("L", "p", None, 1.0), ("L", "p", 9, None)],
             [("L", "p", 12, 7.0)], [("L", "p", 10, 6.0)]]
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    raw = spark.read.parquet(run_available_now(online_filter(stream), "late-test"))
    got = sorted((r.week_id, r.value, round(r.level_f, 12)) for r in latest(raw).collect())
    final = spark.createDataFrame([("L", "p", 8, 1.0), ("L", "p", 10, 6.0), ("L", "p", 12, 7.0)], schema)
    assert got == sorted((r.week_id, r.value, round(r.level_f, 12)) for r in kalman_smooth(final).collect())
    assert raw.count() == 2 + 3 + 2  # a reading that repeats itself changes nothing


def test_health_model_recovers_rule(spark):
    """The label is a rule of the features, so a boosted model must learn it
    (few trees here to keep the suite fast; the registered query uses 200)."""
    lab = PS.labelled(spark, SF_CHECK)
    from agroframe.operators.splits import stratified_split
    sp = stratified_split(lab, "health_label", "row_id")
    feats = ["temperature_c", "humidity_pct", "soil_moisture_raw", "nitrogen", "phosphorus", "potassium",
             "days_planted"]
    model = MD.health_pipeline(feats, max_iter=25, depth=4).fit(sp.filter("split = 'train'"))
    pred = model.transform(sp.filter("split = 'test'"))
    acc = M.accuracy(pred, "health_label", "prediction").first().accuracy
    flat = sp.filter("split = 'test'").agg(F.avg("health_label")).first()[0]
    assert acc >= 0.99 and acc > max(flat, 1 - flat)
    top = MD.top_features(model, sp.limit(5), 3)
    assert len(top) == 3 and all(isinstance(n, str) for n, _ in top)


def test_severity_model_beats_the_seasonal_baseline(spark, tmpdir_path):
    from pyspark.ml import PipelineModel

    from agroframe.operators import baseline as B
    p = PP.split_panel(spark, SF_CHECK)
    model = MD.fit_severity(p.filter("is_train"), max_iter=15, depth=4)
    pred = MD.predict_severity(model, B.with_seasonal_baseline(p.filter("not is_train"), p.filter("is_train")))
    rep = {r.model: r for r in M.regression_report(pred, "y", ["y_log", "seas"]).collect()}
    assert rep["y_log"].mae < rep["seas"].mae and rep["y_log"].r2 > rep["seas"].r2
    # a saved pipeline is complete: raw panel rows go in as they are
    model.write().overwrite().save(f"{tmpdir_path}/severity")
    rows = p.filter("not is_train").limit(20)
    back = PipelineModel.load(f"{tmpdir_path}/severity").transform(rows).select("prediction").collect()
    assert [r.prediction for r in back] == [r.y_log for r in MD.predict_severity(model, rows).select("y_log").collect()]
    # A request for an unseen location / pest is scored with the training columns (unknown -> extra slot)
    unseen = p.limit(3).withColumn("location", F.lit("NEW_PLACE")).withColumn("pest", F.lit("NEW_PEST"))
    got = MD.predict_severity(model, unseen).select("y_log").collect()
    assert len(got) == 3 and all(r.y_log is not None for r in got)


def test_ood_flags_by_strictness(spark):
    emb = fx(spark, SF_SMALL, "fx_emb")
    model = O.fit_ood(emb.filter("split = 'train'"))
    scored = O.score_ood(emb.filter("split = 'valid'"), model)
    thr = O.ood_threshold(scored).first().threshold
    n = {s: O.flag_ood(scored, thr, s).filter("is_ood").count() for s in O.STRICTNESS}
    assert n["Lenient"] <= n["Balanced"] <= n["Strict"]


def test_forecast_batch_covers_every_request_and_scenario(spark, tmpdir_path):
    from agroframe.operators import baseline as B
    from agroframe.operators import forecast as FC
    p = PP.split_panel(spark, SF_CHECK)
    model = MD.fit_severity(p.filter("is_train"), max_iter=5, depth=3)
    by_week, glob = B.feature_climatology(p)
    req = (p.select("crop", "location", "pest").distinct().limit(4)
           .crossJoin(spark.range(1, 54).select(F.col("id").cast("int").alias("standard_week"))))
    scen = FC.scenarios(spark, [(0, 0.0, 1.0, 0.0), (1, 3.0, 2.0, -10.0)])
    out = FC.forecast_batch(model, req, by_week, glob, scen, B.band_cutoffs(p)).cache()
    assert out.count() == 4 * 53 * 2
    assert out.filter(F.col("count") < 0).count() == 0
    assert {r.band for r in out.select("band").distinct().collect()} <= {"Low", "Medium", "High"}
    # rows without a (location, week) climatology fall back to the global row
    assert out.filter("from_global").count() > 0
    # the same answers from the saved artefacts
    from agroframe.sources import files as FS
    FS.write_bundle(FC.build_bundle(p, PP.clean(spark, SF_CHECK)), f"{tmpdir_path}/bundle")
    model.write().overwrite().save(f"{tmpdir_path}/model")
    again = FC.forecast_from_saved(spark, f"{tmpdir_path}/model", f"{tmpdir_path}/bundle", req, scen)
    key = ["location", "pest", "crop", "standard_week", "scenario_id"]
    both = out.select(*key, "count", "band").join(again.select(*key, F.col("count").alias("c2"), F.col("band").alias("b2")), key)
    assert both.count() == 4 * 53 * 2 and both.filter("count <> c2 or band <> b2").count() == 0
