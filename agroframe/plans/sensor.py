"""Registered queries of the sensor-health track (track A)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agroframe.functions.columns import all_of
from agroframe.operators import metrics as M
from agroframe.operators import profile as PR
from agroframe.operators import sensor as SE
from agroframe.operators import splits as SP
from agroframe.plans.registry import finish, fx, query
from agroframe.sources import files as FS
from agroframe.streaming.live import scratch_path

FX = ("fx_sensor",)
VALUE_COLS = ["temperature_c", "humidity_pct", "soil_moisture_raw", "nitrogen", "phosphorus", "potassium",
              "days_planted", "ph"]
ALL_COLS = ["row_id", *VALUE_COLS, "growth_stage"]
R = SE.THRESHOLDS


def sensor(spark, sf) -> DataFrame:
    return fx(spark, sf, "fx_sensor")


def raw_sensor(spark, sf) -> DataFrame:
    """The sensor fixture under its raw CSV headers (with stray spaces)."""
    inverse = {v: f" {k} " for k, v in SE.RENAME.items()}
    s = sensor(spark, sf)
    return s.toDF(*[inverse.get(c, c) for c in s.columns])


def labelled(spark, sf) -> DataFrame:
    raw = raw_sensor(spark, sf)
    return SE.health_label(SE.drop_present(SE.rename_sensor(SE.trim_headers(raw)), ["ph"]))


def _ok_sql(v: str) -> str:
    lo, hi = R[v]
    return f"coalesce({v} BETWEEN {lo} AND {hi}, false)"


SCORE_SQL = " + ".join(f"cast(NOT {_ok_sql(v)} AS int)" for v in R)
LABELLED_CTE = (f"lab AS (SELECT row_id, {', '.join(c for c in VALUE_COLS if c != 'ph')}, growth_stage, "
                f"{SCORE_SQL} AS stress_score, cast(({SCORE_SQL}) = 0 AS int) AS health_label FROM fx_sensor)")
# the deterministic stand-in predictor used for the metric checks: the two climate rules only
PRED_SQL = f"cast({_ok_sql('temperature_c')} AND {_ok_sql('humidity_pct')} AS int)"


def predicted(spark, sf) -> DataFrame:
    lab = labelled(spark, sf)
    rule = all_of([F.coalesce(F.col(v).between(*R[v]), F.lit(False)) for v in ("temperature_c", "humidity_pct")])
    return lab.withColumn("prediction", rule.cast("int"))


@query("sensor_scan", "SELECT * FROM fx_sensor", FX)
def sensor_scan(spark, sf):
    """The table written as CSV under raw headers, in another order, read back and typed."""
    src = sensor(spark, sf)
    raw_names = {v: f" {k} " for k, v in SE.RENAME.items()}
    path = scratch_path(spark, "sensor-csv")
    src.select(*[F.col(c).alias(raw_names.get(c, c)) for c in reversed(src.columns)]) \
        .write.options(**FS.CSV_EXACT).csv(path)
    back = FS.read_sensor(spark, path, drop=())
    return back.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in src.schema])


@query("sensor_clean", f"SELECT {', '.join(c for c in ALL_COLS if c != 'ph')} FROM fx_sensor", FX)
def sensor_clean(spark, sf):
    raw = raw_sensor(spark, sf)
    return SE.drop_present(SE.rename_sensor(SE.trim_headers(raw)), ["ph", "no_such_column"])


@query("range_flags", "SELECT row_id, " + ", ".join(f"{_ok_sql(v)} AS {v}_ok" for v in R) + " FROM fx_sensor", FX)
def range_flags(spark, sf):
    return SE.range_flags(sensor(spark, sf)).select("row_id", *[f"{v}_ok" for v in R])


@query("health_label", "SELECT row_id, stress_score, health_label FROM lab", FX, [LABELLED_CTE])
def health_label(spark, sf):
    return labelled(spark, sf).select("row_id", "stress_score", "health_label")


@query("label_counts", "SELECT health_label, count(*) AS count, "
       "round_even(round(count(*) / sum(count(*)) OVER (), 9), 3) AS proportion FROM lab GROUP BY health_label",
       FX, [LABELLED_CTE])
def label_counts(spark, sf):
    return PR.value_counts(labelled(spark, sf), "health_label")


def _report_sql() -> str:
    parts = []
    for v, (lo, hi) in R.items():
        parts.append(f"SELECT row_id, '{v}' AS variable, '{SE.LABELS[v]}' AS label, {v} AS value, "
                     f"'{lo:g} – {hi:g}' AS healthy_range, {_ok_sql(v)} AS ok, "
                     f"CASE WHEN {_ok_sql(v)} THEN '✓ in range' ELSE '✗ out of range' END AS status "
                     f"FROM fx_sensor")
    return " UNION ALL ".join(parts)


@query("health_report", _report_sql(), FX)
def health_report(spark, sf):
    rows, _ = SE.health_report(sensor(spark, sf))
    return finish(rows)


@query("health_verdict", f"SELECT row_id, cast({SCORE_SQL} AS bigint) AS out_of_range, "
       f"CASE WHEN ({SCORE_SQL}) = 0 THEN 'Healthy' ELSE 'At risk' END AS status FROM fx_sensor", FX)
def health_verdict(spark, sf):
    _, verdict = SE.health_report(sensor(spark, sf))
    return verdict


@query("profile_nulls", " UNION ALL ".join(
    f"SELECT '{c}' AS column, count(*) - count({c}) AS n_null FROM fx_sensor" for c in ALL_COLS), FX)
def profile_nulls(spark, sf):
    return PR.profile_nulls(sensor(spark, sf))


@query("profile_shape", f"SELECT count(*) AS n_rows, {len(ALL_COLS)} AS n_cols FROM fx_sensor", FX)
def profile_shape(spark, sf):
    return PR.profile_shape(sensor(spark, sf))


def _describe_sql() -> str:
    def r2(e):
        return f"round_even(round({e}, 9), 2)"

    parts = []
    for c in VALUE_COLS:
        parts.append(
            f"SELECT '{c}' AS column, cast(count({c}) AS double) AS count, {r2(f'avg({c})')} AS mean, "
            f"{r2(f'stddev_samp({c})')} AS std, {r2(f'min({c})')} AS min, "
            f"{r2(f'quantile_cont({c}, 0.25)')} AS p25, {r2(f'quantile_cont({c}, 0.5)')} AS p50, "
            f"{r2(f'quantile_cont({c}, 0.75)')} AS p75, {r2(f'max({c})')} AS max FROM fx_sensor")
    return " UNION ALL ".join(parts)


@query("profile_describe", _describe_sql(), FX)
def profile_describe(spark, sf):
    return PR.profile_describe(sensor(spark, sf), VALUE_COLS)


@query("stratified_split", "SELECT row_id, health_label, CASE WHEN row_number() OVER (PARTITION BY health_label "
       "ORDER BY md5(concat_ws('|', '42', cast(row_id AS varchar))), row_id) <= "
       "round_even(count(*) OVER (PARTITION BY health_label) * 0.2, 0) THEN 'test' ELSE 'train' END AS split "
       "FROM lab", FX, [LABELLED_CTE])
def stratified_split(spark, sf):
    lab = labelled(spark, sf).select("row_id", "health_label")
    return SP.stratified_split(lab, "health_label", "row_id", 0.2, seed=42)


@query("one_hot_growth", "SELECT row_id, cast(growth_stage = 'O' AS int) AS growth_stage_O, "
       "cast(growth_stage = 'P' AS int) AS growth_stage_P FROM fx_sensor", FX)
def one_hot_growth(spark, sf):
    return SE.one_hot_drop_first(sensor(spark, sf).select("row_id", "growth_stage"), "growth_stage", SE.GROWTH_STAGES)


CM_CTES = [LABELLED_CTE,
           f"pr AS (SELECT health_label AS y, {PRED_SQL} AS p FROM lab)",
           "cm AS (SELECT y, p, count(*) AS n FROM pr GROUP BY y, p)",
           "cls AS (SELECT y AS label FROM cm UNION SELECT p FROM cm)",
           "per AS (SELECT c.label, coalesce((SELECT sum(n) FROM cm WHERE y = c.label), 0) AS support, "
           "coalesce((SELECT sum(n) FROM cm WHERE p = c.label), 0) AS predicted, "
           "coalesce((SELECT sum(n) FROM cm WHERE y = c.label AND p = c.label), 0) AS tp FROM cls c)",
           "met AS (SELECT label, support, tp, "
           "CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END AS precision, "
           "CASE WHEN support > 0 THEN tp / support ELSE 0 END AS recall FROM per)",
           "met2 AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) "
           "ELSE 0 END AS f1 FROM met)"]


@query("classification_report",
       "SELECT cast(label AS varchar) AS label, round(round(precision, 9), 6) AS precision, "
       "round(round(recall, 9), 6) AS recall, round(round(f1, 9), 6) AS f1, cast(support AS double) AS support "
       "FROM met2 UNION ALL SELECT 'accuracy', NULL, NULL, round(round(sum(tp) / sum(support), 9), 6), "
       "cast(sum(support) AS double) FROM met2 UNION ALL SELECT 'macro avg', round(round(avg(precision), 9), 6), "
       "round(round(avg(recall), 9), 6), round(round(avg(f1), 9), 6), cast(sum(support) AS double) FROM met2 "
       "UNION ALL SELECT 'weighted avg', round(round(sum(precision * support) / sum(support), 9), 6), "
       "round(round(sum(recall * support) / sum(support), 9), 6), round(round(sum(f1 * support) / sum(support), 9), 6), "
       "cast(sum(support) AS double) FROM met2", FX, CM_CTES)
def classification_report(spark, sf):
    return finish(M.classification_report(predicted(spark, sf), "health_label", "prediction"))


@query("confusion_matrix", "SELECT l.label, "
       "cast(coalesce(sum(CASE WHEN cm.p = 0 THEN n END), 0) AS bigint) AS pred_0, "
       "cast(coalesce(sum(CASE WHEN cm.p = 1 THEN n END), 0) AS bigint) AS pred_1 "
       "FROM (SELECT cast(0 AS bigint) AS label UNION ALL SELECT 1) l LEFT JOIN cm ON cm.y = l.label GROUP BY l.label",
       FX, CM_CTES[:3])
def confusion_matrix(spark, sf):
    return M.confusion_matrix(predicted(spark, sf), "health_label", "prediction", [0, 1])


@query("profile_head", "SELECT * FROM fx_sensor ORDER BY row_id LIMIT 5", FX)
def profile_head(spark, sf):
    """First five rows by row id (a preview report)."""
    return PR.head_rows(sensor(spark, sf), ["row_id"], 5)
