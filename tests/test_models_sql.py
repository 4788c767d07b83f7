"""Model reports checked by SQL over the stored predictions and the stored trees, and the series booster by brute force."""

import duckdb
import numpy as np
import pytest
from conftest import SF_CHECK
from pyspark.sql import functions as F

from agroframe.operators import boosting as BO
from agroframe.operators import models as MD
from agroframe.plans import modeling as PM


@pytest.fixture()
def few_rounds(monkeypatch):
    monkeypatch.setattr(MD, "HEALTH_GBT", dict(max_iter=6, depth=4, rate=0.1))
    monkeypatch.setattr(MD, "FLAGSHIP_GBT", dict(max_iter=12, depth=4, rate=0.1, subsample=0.9, colsample=0.9))
    monkeypatch.setattr(PM, "POOLED_ROUNDS", dict(max_iter=6, rate=0.2))


def stored(monkeypatch, name, run):
    """Rows of *run* and the folder of the predictions it stored under *name*."""
    seen = []
    keep = PM.materialize
    monkeypatch.setattr(PM, "materialize", lambda d, n="stage": seen.append((n, keep(d, n))) or seen[-1][1])
    rows = run().collect()
    path = [t.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://").removeprefix("file:") for n, t in seen if n == name][-1]
    return rows, f"'{path}/*.parquet'"


def close(got, want):
    assert len(got) == len(want)
    for a, b in zip(sorted(map(tuple, got), key=str), sorted(want, key=str)):
        assert [v if not isinstance(v, float) else None for v in a] == [v if not isinstance(v, float) else None for v in b]
        np.testing.assert_allclose([v for v in a if isinstance(v, float)], [v for v in b if isinstance(v, float)], atol=2e-6)


def test_health_reports_and_importance(spark, few_rounds, monkeypatch, tmpdir_path):
    sf = SF_CHECK + "/"  # a folder name of its own: fits are kept by folder
    rows, table = stored(monkeypatch, "health-pred", lambda: PM.health_confusion(spark, sf))
    close(rows, duckdb.sql(f"SELECT health_label, count(*) FILTER (prediction = 0), count(*) FILTER (prediction = 1) FROM {table} GROUP BY 1").fetchall())
    rows, table = stored(monkeypatch, "health-pred", lambda: PM.health_model(spark, sf).select("label", "precision", "recall", "f1"))
    want = duckdb.sql(f"""SELECT l::VARCHAR, p::DOUBLE, r::DOUBLE, (2 * p * r / (p + r))::DOUBLE FROM (SELECT l,
        avg(CASE WHEN health_label = l THEN 1.0 ELSE 0 END) FILTER (prediction = l) AS p,
        avg(CASE WHEN prediction = l THEN 1.0 ELSE 0 END) FILTER (health_label = l) AS r
        FROM {table}, (VALUES (0), (1)) v(l) GROUP BY l)""").fetchall()
    close([r for r in rows if r.label in ("0", "1")], want)
    # importance from the saved trees: the shares of gain x rows over all trees
    model, test = PM._health(spark, sf)
    model.stages[-1].write().overwrite().save(f"{tmpdir_path}/trees")
    saved = duckdb.sql(f"""WITH n AS (SELECT treeID, nodeData.split.featureIndex AS f, nodeData.gain * nodeData.rawCount AS g
        FROM '{tmpdir_path}/trees/data/*.parquet' WHERE nodeData.leftChild >= 0),
        t AS (SELECT f, sum(g) AS g FROM n GROUP BY f)
        SELECT f, g / sum(g) OVER () FROM t""").fetchall()
    np.testing.assert_allclose([model.stages[-1].featureImportances[int(f)] for f, _ in saved], [v for _, v in saved], atol=1e-9)
    top = PM.health_importance(spark, sf).collect()
    assert [r.importance for r in top] == sorted((r.importance for r in top), reverse=True) and top[0].feature.endswith(("_imp", "_na"))


def test_pooled_report(spark, few_rounds, monkeypatch):
    sf = SF_CHECK + "/"
    rows, table = stored(monkeypatch, "pooled-pred", lambda: PM.pooled_evaluation(spark, sf))
    want = []
    for m in ("y_log", "seas", "flat_mean"):
        want += duckdb.sql(f"""SELECT block, '{m}', count(*), avg(abs(y - {m})), 1 - sum((y - {m}) ** 2) / (var_pop(y) * count(*))
            FROM (SELECT block, y, {m} FROM {table} UNION ALL SELECT 'ALL', y, {m} FROM {table}) GROUP BY block""").fetchall()
    close(rows, want)
    forecast = PM.severity_forecast(spark, sf)  # from the same saved fit
    assert forecast.groupBy("band").count().count() >= 2 and forecast.where("count < 0 OR y_log IS NULL").count() == 0


def test_series_reports(spark, few_rounds, monkeypatch):
    sf = SF_CHECK + "/"
    rows, table = stored(monkeypatch, "series-pred", lambda: PM.flagship_confusion(spark, sf))
    close(rows, duckdb.sql(f"""SELECT band_y, count(*) FILTER (band_y_log = 0), count(*) FILTER (band_y_log = 1), count(*) FILTER (band_y_log = 2)
        FROM {table} GROUP BY 1""").fetchall())
    rows, table = stored(monkeypatch, "series-pred", lambda: PM.flagship_model(spark, sf).where("model = 'y_log'").drop("r2"))
    close(rows, duckdb.sql(f"""SELECT crop, location, pest, 'y_log', count(*), avg(abs(y - y_log)),
        quantile_cont(abs(exp(y) - exp(y_log)), 0.5), avg(CASE WHEN band_y = band_y_log THEN 1.0::DOUBLE ELSE 0 END) FROM {table} GROUP BY ALL""").fetchall())
    split, models = PM._series_models(spark, sf)
    assert models.count() == split.select(*BO.SERIES).distinct().count()
    ranks = PM.flagship_importance(spark, sf)
    assert ranks.where("rank > 8").count() == 0 and ranks.groupBy(*BO.SERIES).agg(F.sum("importance").alias("s")).where("s > 1.0001").count() == 0


def test_one_split_is_the_best_one():
    rng = np.random.default_rng(4)
    for _ in range(30):
        x, y = rng.integers(0, 6, (20, 3)).astype(float), rng.normal(size=20)
        x[rng.random(x.shape) < 0.2] = np.nan
        m = BO.boost(x, y, 1, 1, 1.0)
        filled = np.where(np.isnan(x), np.inf, x)
        sse = lambda v: ((v - v.mean()) ** 2).sum()
        best = min(sse(y[filled[:, f] <= c]) + sse(y[filled[:, f] > c])
                   for f in range(3) for c in filled[:, f] if 0 < (filled[:, f] <= c).sum() < 20)
        assert abs(((y - BO.predict(m, x)) ** 2).sum() - best) < 1e-9


def test_series_model_learns_and_ignores_others(spark):
    rng = np.random.default_rng(1)
    rows = []
    for loc, sign in (("a", 1), ("b", -1)):
        for w in range(80):
            v = float(rng.normal())
            rows.append(("c", loc, "p", w, w % 52 + 1, v, float(rng.normal()) if w % 9 else None, sign * (2.0 if v > 0 else 0.0)))
    rows.append(("c", "empty", "p", 1, 2, 0.1, 0.1, None))
    df = spark.createDataFrame(rows, "crop string, location string, pest string, week_id long, standard_week int, f double, g double, y double")
    models = BO.fit_series(df, feats=["f", "g"], max_iter=60, depth=2, rate=0.2)
    assert models.count() == 2
    scored = BO.score_series(df, models, feats=["f", "g"]).collect()
    assert len(scored) == 160 and max(abs(r.y - r.y_log) for r in scored) < 0.05
    top = {r.location: r.feature for r in BO.feature_ranks(models, 1, feats=["f", "g"]).collect()}
    assert top == {"a": "f", "b": "f"}
