"""Registered streaming queries: each runs a Structured Streaming job with
``trigger(availableNow=True)`` into a Parquet sink under the shared
checkpoint folder and returns the sink as a batch DataFrame."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from agroframe.operators import panel as P
from agroframe.operators.sensor import LABELS, THRESHOLDS
from agroframe.plans.pest import clean
from agroframe.plans.registry import finish, fx, query
from agroframe.plans.smoothing import KF_CTES
from agroframe.sources.fixtures import with_clause
from agroframe.streaming.live import live_check, run_available_now, scratch_path
from agroframe.streaming.online import latest, online_filter
from agroframe.streaming.verdict import device_verdicts, latest_verdicts, rocksdb_state


def _rules_sql() -> str:
    vals = ", ".join(f"('{v}', '{LABELS[v]}', {lo}, {hi}, '{lo:g} – {hi:g}')" for v, (lo, hi) in THRESHOLDS.items())
    return f"(SELECT * FROM (VALUES {vals}) r(variable, label, lo, hi, healthy_range))"


@query("live_check",
       "SELECT f.event_id, f.device_id, f.variable, f.value, r.label, r.healthy_range, "
       "CASE WHEN r.lo IS NULL THEN NULL ELSE coalesce(f.value BETWEEN r.lo AND r.hi, false) END AS ok, "
       "CASE WHEN r.lo IS NULL THEN NULL WHEN coalesce(f.value BETWEEN r.lo AND r.hi, false) THEN '✓ in range' "
       f"ELSE '✗ out of range' END AS status FROM fx_readings f LEFT JOIN {_rules_sql()} r "
       "ON f.variable = r.variable", ("fx_readings",))
def live_check_q(spark, sf):
    """ST1: the events table replayed as a file stream through the live check."""
    out = run_available_now(live_check(_readings(spark, sf)), "live-check")
    return finish(spark.read.parquet(out).select("event_id", "device_id", "variable", "value", "label",
                                                 "healthy_range", "ok", "status"))


def _readings(spark, sf):
    """The events table as a file stream of sensor readings."""
    path = os.path.join(sf, "events.parquet")
    events = (spark.readStream.schema(spark.read.parquet(path).schema)
              .option("pathGlobFilter", "events.parquet").option("maxFilesPerTrigger", 1).parquet(sf))
    view = f"events_stream_{abs(hash(path)) % 10**8}"
    events.createOrReplaceTempView(view)
    return spark.sql(with_clause(["fx_readings"], lambda t: view) + "SELECT * FROM fx_readings")


_BAD = " + ".join(f"CASE WHEN coalesce(max(value) FILTER (variable = '{v}') BETWEEN {lo} AND {hi}, false) THEN 0 ELSE 1 END"
                  for v, (lo, hi) in THRESHOLDS.items())


FILE_READINGS = 250_000  # readings of one replayed file


@query("live_verdict",
       "SELECT device_id, cast(seen AS int) AS seen, cast(out_of_range AS int) AS out_of_range, "
       "CASE WHEN out_of_range = 0 THEN 'Healthy' ELSE 'At risk' END AS status, "
       f"strftime(as_of, '%Y-%m-%d %H:%M:%S.%f') AS as_of FROM (SELECT device_id, count(*) AS seen, {_BAD} AS out_of_range, "
       "max(ts) AS as_of FROM (SELECT *, row_number() OVER (PARTITION BY device_id, variable ORDER BY ts DESC, event_id DESC) AS rn "
       f"FROM fx_readings WHERE variable IN ({', '.join(repr(v) for v in THRESHOLDS)})) r WHERE rn = 1 GROUP BY device_id) v",
       ("fx_readings",))
def live_verdict(spark, sf):
    """ST1 + P23: the readings, dealt over files in no order, replayed in five batches of files through the verdict per device."""
    src = scratch_path(spark, "readings")
    readings = fx(spark, sf, "fx_readings")
    files = max(1, -(-readings.count() // (5 * FILE_READINGS)))  # of a batch
    readings.repartition(5 * files).write.parquet(src)
    stream = spark.readStream.schema(readings.schema).option("maxFilesPerTrigger", files).parquet(src)
    with rocksdb_state(spark):
        out = run_available_now(device_verdicts(stream), "live-verdict")
    return latest_verdicts(spark.read.parquet(out)).withColumn("as_of", F.date_format("as_of", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@query("online_filter", "SELECT f.location, f.pest, f.week_id, round(round(s.value, 9), 6) AS value, "
       "round(round(f.x0, 9), 6) AS level_f, round(round(f.x1, 9), 6) AS slope_f FROM kf f JOIN s "
       "ON s.location = f.location AND s.pest = f.pest AND s.rn = f.rn", ("fx_panel",), KF_CTES, recursive=True)
def online_filter_q(spark, sf):
    """ST2: weekly series written as a table of several files, replayed file by file as a
    stream through the stateful forward filter (equals W8 in any order of arrival)."""
    weekly = P.weekly_target(clean(spark, sf)).withColumnRenamed("pest_value", "value")
    src = scratch_path(spark, "weekly-obs")
    weekly.repartition(5).write.parquet(src)  # weeks of a series lie in several micro-batches
    stream = spark.readStream.schema(spark.read.parquet(src).schema).option("maxFilesPerTrigger", 1).parquet(src)
    out = run_available_now(online_filter(stream), "online-filter")
    return finish(latest(spark.read.parquet(out)))
