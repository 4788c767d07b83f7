"""Registered queries of the weekly pest-panel track (track B)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from agroframe.operators import baseline as B
from agroframe.operators import forecast as FC
from agroframe.operators import panel as P
from agroframe.operators.panel_view import PanelView
from agroframe.operators.ranking import rank_within
from agroframe.plans import pest_sql as S
from agroframe.plans.registry import finish, fx, query
from agroframe.session import materialize
from agroframe.sources import files as FS
from agroframe.sources import panel_store as PS
from agroframe.streaming.live import scratch_path

FX = ("fx_panel",)
PANEL = S.panel_ctes()
SPLIT = PANEL + S.SPLIT_CTES
WCOLS = ", ".join(P.WEATHER)


def clean(spark, sf, level: str = "nation") -> DataFrame:
    return P.clean_panel(fx(spark, sf, "fx_panel" if level == "nation" else "fx_panel_region"))


def panel(spark, sf, level: str = "nation", min_obs: int = S.MIN_OBS_Q) -> DataFrame:
    return P.feature_panel(clean(spark, sf, level), min_obs=min_obs)


def split_panel(spark, sf) -> DataFrame:
    """The panel with its train/test flag, checkpointed: baselines, endemic
    labels, cut-offs and metrics all read it several times."""
    return materialize(B.year_split(panel(spark, sf), S.SPLIT_YEAR_Q))


def train_rows(spark, sf) -> DataFrame:
    return split_panel(spark, sf).filter("is_train")


# ---------------------------------------------------------------- scans & cleaning
@query("panel_scan", "SELECT * FROM fx_panel", FX)
def panel_scan(spark, sf):
    """The panel written as CSV with its columns in another order, read back by header name."""
    src = fx(spark, sf, "fx_panel")
    path = scratch_path(spark, "panel-csv")
    src.select(*reversed(src.columns)).write.options(**FS.CSV_EXACT).csv(path)
    extra = {f.name: f.dataType for f in src.schema if f.name not in FS.PANEL_SCHEMA.names}
    back = FS.read_panel(spark, path, extra)
    return back.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in src.schema])


@query("panel_clean", f"SELECT row_id, crop, location, pest, year, standard_week, pest_value, {WCOLS}, unit "
       "FROM clean", FX, [S.clean_cte()])
def panel_clean(spark, sf):
    return finish(clean(spark, sf).select("row_id", "crop", "location", "pest", "year", "standard_week",
                                          "pest_value", *P.WEATHER, "unit"))


@query("week_index", "SELECT row_id, year, standard_week, week_id FROM clean", FX, [S.clean_cte()])
def week_index(spark, sf):
    return clean(spark, sf).select("row_id", "year", "standard_week", "week_id")


@query("week_date", "SELECT row_id, cast(make_date(year, 1, 1) + (standard_week - 1) * 7 AS varchar) AS week_date "
       "FROM fx_panel", FX)
def week_date(spark, sf):
    return P.add_week_date(fx(spark, sf, "fx_panel")).select(
        "row_id", F.col("date").cast("string").alias("week_date"))


@query("monitored_split", "SELECT crop, count(*) AS n_rows, count(pest_value) AS n_monitored, "
       "count(*) - count(pest_value) AS n_unmonitored FROM clean GROUP BY crop", FX, [S.clean_cte()])
def monitored_split(spark, sf):
    return clean(spark, sf).groupBy("crop").agg(
        F.count("*").alias("n_rows"), F.count("pest_value").alias("n_monitored"),
        F.count_if(F.col("pest_value").isNull()).alias("n_unmonitored"))


@query("presence_flag", "SELECT row_id, pest_value, cast(pest_value > 0 AS int) AS present "
       "FROM clean WHERE pest_value IS NOT NULL", FX, [S.clean_cte()])
def presence_flag(spark, sf):
    return finish(P.add_presence(P.monitored(clean(spark, sf))).select("row_id", "pest_value", "present"))


@query("log_target", "SELECT row_id, round(round(ln(1 + pest_value), 9), 6) AS y FROM clean WHERE pest_value IS NOT NULL",
       FX, [S.clean_cte()])
def log_target(spark, sf):
    return finish(P.log_target(P.monitored(clean(spark, sf))).select("row_id", "y"))


@query("week_decode", "SELECT DISTINCT week_id, cast(floor(week_id / 52) AS int) AS year, "
       "cast(week_id % 52 + 1 AS int) AS standard_week FROM clean", FX, [S.clean_cte()])
def week_decode(spark, sf):
    return P.decode_week(clean(spark, sf).select("week_id").distinct())


@query("panel_summary", "SELECT count(*) AS n_rows, count(pest_value) AS n_monitored, "
       "count(*) - count(pest_value) AS n_unmonitored, min(year) AS year_min, max(year) AS year_max, "
       "count(DISTINCT pest) AS n_pests, "
       + ", ".join(f"count(*) - count({c}) AS {c}_nulls" for c in P.WEATHER)
       + " FROM clean", FX, [S.clean_cte()])
def panel_summary(spark, sf):
    return P.panel_summary(clean(spark, sf))


# ---------------------------------------------------------------- weekly grain & features
@query("weekly_weather", "SELECT location, week_id, "
       + ", ".join(f"round(round({c}, 9), 6) AS {c}" for c in P.WEATHER) + " FROM wx", FX, [S.clean_cte(), S.WX_CTE])
def weekly_weather(spark, sf):
    return finish(P.weekly_weather(clean(spark, sf)))


@query("weekly_target", "SELECT location, pest, week_id, round(round(pest_value, 9), 6) AS pest_value FROM tgt",
       FX, [S.clean_cte(), S.TGT_CTE])
def weekly_target(spark, sf):
    return finish(P.weekly_target(clean(spark, sf)))


@query("dense_weeks", "SELECT location, week_id, " + ", ".join(f"round(round({c}, 9), 6) AS {c}" for c in P.WEATHER)
       + " FROM dense", FX, [S.clean_cte(), S.WX_CTE, *S.DENSE_CTES])
def dense_weeks(spark, sf):
    return finish(P.dense_weeks(P.weekly_weather(clean(spark, sf))))


def _feature_query(kind: str):
    cols = [f"{c}_{kind}" for c in P.WEATHER]
    sql = ("SELECT location, week_id, standard_week, " + ", ".join(f"round(round({c}, 9), 6) AS {c}" for c in cols)
           + " FROM feat")

    @query(f"{kind}_features", sql, FX, [S.clean_cte(), S.WX_CTE, *S.DENSE_CTES, S.FEAT_CTE])
    def q(spark, sf):
        dense = P.dense_weeks(P.weekly_weather(clean(spark, sf)))
        return finish(P.weather_features(dense).select("location", "week_id", "standard_week", *cols))

    return q


lag_features = _feature_query("lag1")
roll_features = _feature_query("roll4")
trend_features = _feature_query("trend")


PANEL_SQL = ("SELECT crop, location, pest, week_id, year, standard_week, "
             + ", ".join(f"round(round({c}, 9), 6) AS {c}" for c in P.BASE_FEATS)
             + ", round(round(pest_value, 9), 6) AS pest_value, round(round(y, 9), 6) AS y FROM panel")


@query("feature_panel", PANEL_SQL, FX, PANEL)
def feature_panel(spark, sf):
    return finish(panel(spark, sf))


@query("feature_panel_view", PANEL_SQL, FX, PANEL)
def feature_panel_view(spark, sf):
    """W1-W3 + J1 kept up to date: the readings arrive in three batches of mixed weeks."""
    c, view = materialize(clean(spark, sf)), PanelView()
    for part in range(3):
        view = view.apply(c.where(F.col("row_id") % 3 == part))
    return finish(view.panel(min_obs=S.MIN_OBS_Q))


@query("feature_panel_stored", PANEL_SQL, FX, PANEL)
def feature_panel_stored(spark, sf):
    """S4 + J1: the weekly tables stored by location, the panel read from them without an Exchange."""
    name = f"weekly_{uuid.uuid4().hex}"
    PS.write(materialize(clean(spark, sf)), name, scratch_path(spark, name), buckets=16)
    return finish(PS.feature_panel(spark, name, S.MIN_OBS_Q))


# ---------------------------------------------------------------- series statistics
STATS_SQL = ("SELECT crop, location, pest, count(*) AS n_obs, "
             "cast(sum(CASE WHEN pest_value > 0 THEN 1 ELSE 0 END) AS bigint) AS n_present, "
             "count(*) - cast(sum(CASE WHEN pest_value > 0 THEN 1 ELSE 0 END) AS bigint) AS n_absent, "
             "round_even(sum(CASE WHEN pest_value > 0 THEN 1 ELSE 0 END) / count(*) * 100, 1) AS pct_present "
             "FROM clean WHERE pest_value IS NOT NULL GROUP BY crop, location, pest")


@query("series_stats", STATS_SQL, FX, [S.clean_cte()])
def series_stats(spark, sf):
    return P.series_stats(clean(spark, sf))


_mo, _mp, _ma = S.MODELABLE_Q


@query("modelable_series", f"SELECT * FROM ({STATS_SQL}) s WHERE n_obs >= {_mo} AND n_present >= {_mp} "
       f"AND n_absent >= {_ma}", FX, [S.clean_cte()])
def modelable_series(spark, sf):
    return P.modelable(P.series_stats(clean(spark, sf)), *S.MODELABLE_Q)


@query("modelable_top", f"SELECT * FROM ({STATS_SQL}) s WHERE n_obs >= {_mo} AND n_present >= {_mp} "
       f"AND n_absent >= {_ma} ORDER BY n_obs DESC, crop, location, pest LIMIT 15", FX, [S.clean_cte()])
def modelable_top(spark, sf):
    """The 15 modelable series with the most readings (a top-k report)."""
    m = P.modelable(P.series_stats(clean(spark, sf)), *S.MODELABLE_Q)
    return m.orderBy(F.desc("n_obs"), "crop", "location", "pest").limit(15)


@query("viable_series", "SELECT crop, location, pest, n_obs FROM viable", FX, [S.clean_cte(), S.viable_cte()])
def viable_series(spark, sf):
    return P.viable_series(clean(spark, sf), S.MIN_OBS_Q)


@query("viable_panel", "SELECT c.row_id, c.crop, c.location, c.pest, c.week_id, c.pest_value FROM clean c "
       "WHERE EXISTS (SELECT 1 FROM viable v WHERE v.crop = c.crop AND v.location = c.location "
       "AND v.pest = c.pest)", FX, [S.clean_cte(), S.viable_cte()])
def viable_panel(spark, sf):
    return finish(P.viable_panel(clean(spark, sf), S.MIN_OBS_Q)
                  .select("row_id", "crop", "location", "pest", "week_id", "pest_value"))


# ---------------------------------------------------------------- baselines & lookups
@query("year_split", f"SELECT crop, location, pest, week_id, year < {S.SPLIT_YEAR_Q} AS is_train FROM panel",
       FX, PANEL)
def year_split(spark, sf):
    return split_panel(spark, sf).select("crop", "location", "pest", "week_id", "is_train")


@query("seasonal_climatology", "SELECT location, pest, standard_week, round(round(clim, 9), 6) AS clim, n_train FROM clim",
       FX, SPLIT)
def seasonal_climatology(spark, sf):
    return finish(B.seasonal_climatology(train_rows(spark, sf)))


@query("flat_baseline", "SELECT round(round(flat, 9), 6) AS flat, n_train FROM flat", FX, SPLIT)
def flat_baseline(spark, sf):
    return finish(B.flat_baseline(train_rows(spark, sf)))


@query("seasonal_baseline", "SELECT crop, location, pest, week_id, round(round(seas, 9), 6) AS seas FROM seas", FX, SPLIT)
def seasonal_baseline(spark, sf):
    p = split_panel(spark, sf)
    return finish(B.with_seasonal_baseline(p, p.filter("is_train"))
                  .select("crop", "location", "pest", "week_id", "seas"))


@query("endemic_series", "SELECT location, pest, round(round(train_presence, 9), 6) AS train_presence, endemic FROM endem",
       FX, SPLIT)
def endemic_series(spark, sf):
    return finish(B.endemic_series(train_rows(spark, sf), S.ENDEMIC_Q))


@query("endemic_flag", "SELECT p.crop, p.location, p.pest, p.week_id, coalesce(e.endemic, false) AS endemic "
       "FROM panel p LEFT JOIN endem e ON p.location = e.location AND p.pest = e.pest", FX, SPLIT)
def endemic_flag(spark, sf):
    p = split_panel(spark, sf)
    return (B.with_endemic(p, B.endemic_series(p.filter("is_train"), S.ENDEMIC_Q))
            .select("crop", "location", "pest", "week_id", "endemic"))


FCLIM_CTES = [
    "fclim AS (SELECT location, standard_week, " + ", ".join(f"avg({c}) AS {c}" for c in P.BASE_FEATS)
    + " FROM panel GROUP BY location, standard_week)",
    "fglob AS (SELECT " + ", ".join(f"avg({c}) AS {c}" for c in P.BASE_FEATS) + " FROM panel)",
]


@query("feature_climatology",
       "SELECT location, standard_week, " + ", ".join(f"round(round({c}, 9), 6) AS {c}" for c in P.BASE_FEATS)
       + " FROM fclim UNION ALL SELECT NULL, NULL, " + ", ".join(f"round(round({c}, 9), 6)" for c in P.BASE_FEATS)
       + " FROM fglob", FX, PANEL + FCLIM_CTES)
def feature_climatology(spark, sf):
    by_week, glob = B.feature_climatology(panel(spark, sf))
    glob = glob.select(F.lit(None).cast("string").alias("location"),
                       F.lit(None).cast("int").alias("standard_week"), *P.BASE_FEATS)
    return finish(by_week.unionByName(glob))


REQ_CTE = ("req AS (SELECT DISTINCT location, cast(unnest(generate_series(1, 53)) AS int) AS standard_week "
           "FROM panel)")


@query("climatology_lookup",
       "SELECT r.location, r.standard_week, "
       + ", ".join(f"round(round(CASE WHEN c.location IS NOT NULL THEN c.{f} ELSE g.{f} END, 9), 6) AS {f}"
                   for f in P.BASE_FEATS)
       + ", c.location IS NULL AS from_global FROM req r LEFT JOIN fclim c ON r.location = c.location "
         "AND r.standard_week = c.standard_week CROSS JOIN fglob g", FX, PANEL + FCLIM_CTES + [REQ_CTE])
def climatology_lookup(spark, sf):
    p = materialize(panel(spark, sf))  # read for the table and for the requests
    by_week, glob = B.feature_climatology(p)
    req = (p.select("location").distinct()
           .select("location", F.explode(F.sequence(F.lit(1), F.lit(53))).alias("standard_week")))
    return finish(B.climatology_lookup(req, by_week, glob))


@query("band_cutoffs", "SELECT location, pest, round(round(q1, 9), 6) AS q1, round(round(q2, 9), 6) AS q2 FROM cuts", FX, SPLIT)
def band_cutoffs(spark, sf):
    return finish(B.band_cutoffs(panel(spark, sf)))


@query("band_cutoffs_sketched", "SELECT location, pest, round(round(q1, 9), 6) AS q1, round(round(q2, 9), 6) AS q2 FROM cuts", FX, SPLIT)
def band_cutoffs_sketched(spark, sf):
    """A13 on unbounded series; k of 16, so that the series of the tables are bracketed and not taken whole."""
    return finish(B.band_cutoffs_sketched(materialize(panel(spark, sf)), k=16))


TFS_CTE = ("tfs AS (SELECT *, row_number() OVER (PARTITION BY crop, location, pest ORDER BY week_id) "
           "<= floor(count(*) OVER (PARTITION BY crop, location, pest) * 0.75) AS is_train FROM panel)")


@query("time_fraction_split", "SELECT crop, location, pest, week_id, is_train FROM tfs", FX, PANEL + [TFS_CTE])
def time_fraction_split(spark, sf):
    return B.time_fraction_split(panel(spark, sf)).select("crop", "location", "pest", "week_id", "is_train")


@query("band_cutoffs_train", "SELECT crop, location, pest, round(round(quantile_cont(pest_value, 1/3), 9), 6) AS q1, "
       "round(round(quantile_cont(pest_value, 2/3), 9), 6) AS q2 FROM tfs WHERE is_train GROUP BY crop, location, pest",
       FX, PANEL + [TFS_CTE])
def band_cutoffs_train(spark, sf):
    t = B.time_fraction_split(panel(spark, sf)).filter("is_train")
    return finish(B.band_cutoffs_all(t, keys=["crop", "location", "pest"]))


@query("risk_band", "SELECT s.crop, s.location, s.pest, s.week_id, "
       "round(round(greatest(0.0, exp(s.seas) - 1), 9), 6) AS count, "
       f"['Low', 'Medium', 'High'][{S.band_sql('round(exp(s.seas) - 1, 9)')} + 1] AS band "
       "FROM seas s LEFT JOIN cuts c ON s.location = c.location AND s.pest = c.pest", FX, SPLIT)
def risk_band(spark, sf):
    p = split_panel(spark, sf)
    seas = B.with_seasonal_baseline(p, p.filter("is_train"))
    return finish(B.risk_band(seas, B.band_cutoffs(p), y_log="seas")
                  .select("crop", "location", "pest", "week_id", "count", "band"))


# ---------------------------------------------------------------- bundle tables
@query("series_list", "SELECT DISTINCT crop, location, pest FROM panel", FX, PANEL)
def series_list(spark, sf):
    return panel(spark, sf).select("crop", "location", "pest").distinct()


@query("choices", "SELECT crop, location, pest, cast(dense_rank() OVER (ORDER BY crop) AS int) AS crop_pos, "
       "cast(dense_rank() OVER (PARTITION BY crop ORDER BY location) AS int) AS location_pos, "
       "cast(dense_rank() OVER (PARTITION BY crop, location ORDER BY pest) AS int) AS pest_pos "
       "FROM (SELECT DISTINCT crop, location, pest FROM panel) s", FX, PANEL)
def choices(spark, sf):
    """Cascading sorted choice lists (crop -> location -> pest)."""
    s = panel(spark, sf).select("crop", "location", "pest").distinct()
    crops = rank_within(s.select("crop").distinct(), [], ["crop"], out="crop_pos").withColumn(
        "crop_pos", F.col("crop_pos").cast("int"))
    return (s.join(crops, "crop")
            .withColumn("location_pos", F.dense_rank().over(Window.partitionBy("crop").orderBy("location")))
            .withColumn("pest_pos", F.dense_rank().over(Window.partitionBy("crop", "location").orderBy("pest"))))


AW_CTE = ("aw AS (SELECT location, pest, list_sort(list(DISTINCT standard_week)) AS weeks "
          "FROM panel GROUP BY location, pest)")


def _active(spark, sf):
    return P.active_weeks(panel(spark, sf))


@query("active_weeks", "SELECT location, pest, array_to_string(weeks, ',') AS weeks, cast(len(weeks) AS int) AS n_weeks "
       "FROM aw", FX, PANEL + [AW_CTE])
def active_weeks(spark, sf):
    return _active(spark, sf).select("location", "pest", F.array_join("weeks", ",").alias("weeks"),
                                     F.size("weeks").alias("n_weeks"))


@query("default_week", "SELECT location, pest, weeks[len(weeks) // 2 + 1] AS default_week FROM aw",
       FX, PANEL + [AW_CTE])
def default_week(spark, sf):
    return P.default_week(_active(spark, sf)).select("location", "pest", "default_week")


@query("week_range", "SELECT location, pest, list_min(weeks) AS wmin, list_max(weeks) AS wmax, "
       "len(weeks) <> list_max(weeks) - list_min(weeks) + 1 AS has_gaps FROM aw", FX, PANEL + [AW_CTE])
def week_range(spark, sf):
    return P.week_range(_active(spark, sf)).select("location", "pest", "wmin", "wmax", "has_gaps")


@query("series_units", "SELECT location, pest, trim(regexp_replace(arg_min(unit, week_id), '\\s+', ' ', 'g')) "
       "AS unit FROM (SELECT location, pest, week_id, unit, row_number() OVER (PARTITION BY location, pest "
       "ORDER BY week_id, unit) AS rn FROM clean WHERE pest_value IS NOT NULL) s WHERE rn = 1 "
       "GROUP BY location, pest", FX, [S.clean_cte()])
def series_units(spark, sf):
    return P.series_units(clean(spark, sf))


OBS_CTE = ("obs AS (SELECT location, pest, week_id, avg(pest_value) AS value FROM clean "
           "WHERE pest_value IS NOT NULL GROUP BY location, pest, week_id)")


@query("observed_series", "SELECT location, pest, cast(count(*) AS int) AS n_weeks, "
       "string_agg(cast(week_id AS varchar), ',' ORDER BY week_id) AS weeks, round(round(sum(value), 9), 6) AS value_sum "
       "FROM obs GROUP BY location, pest", FX, [S.clean_cte(), OBS_CTE])
def observed_series(spark, sf):
    o = P.observed_series(clean(spark, sf))
    return finish(o.select("location", "pest", F.size("history").alias("n_weeks"),
                           F.array_join(F.transform("history", lambda s: s["week_id"].cast("string")), ",")
                           .alias("weeks"),
                           F.aggregate("history", F.lit(0.0), lambda acc, s: acc + s["value"]).alias("value_sum")))


@query("obs_gaps", "SELECT location, pest, week_id, "
       "CASE WHEN lag(week_id) OVER w IS NOT NULL THEN greatest(1, week_id - lag(week_id) OVER w) END AS gap_prev, "
       "CASE WHEN lead(week_id) OVER w IS NOT NULL THEN greatest(1, lead(week_id) OVER w - week_id) END "
       "AS gap_next "
       "FROM obs WINDOW w AS (PARTITION BY location, pest ORDER BY week_id)", FX, [S.clean_cte(), OBS_CTE])
def obs_gaps(spark, sf):
    return P.obs_gaps(P.weekly_target(clean(spark, sf))).select(
        "location", "pest", "week_id", "gap_prev", "gap_next")


@query("recent_history", "SELECT location, pest, week_id, round(round(value, 9), 6) AS value, "
       "round(round(week_id / 52.0, 9), 6) AS year_frac FROM (SELECT *, row_number() OVER (PARTITION BY location, pest "
       "ORDER BY week_id DESC) AS rn, count(*) OVER (PARTITION BY location, pest) AS n FROM obs) s "
       "WHERE n >= 10 AND rn <= 120", FX, [S.clean_cte(), OBS_CTE])
def recent_history(spark, sf):
    return finish(P.recent_history(P.weekly_target(clean(spark, sf)).withColumnRenamed("pest_value", "value")))


@query("forecast_context",
       "SELECT v.crop, v.location, v.pest, round(round(c.q1, 9), 6) AS q1, round(round(c.q2, 9), 6) AS q2, "
       "coalesce(e.endemic, false) AS endemic, coalesce(u.unit, 'units') AS unit, "
       "coalesce(array_to_string(a.weeks, ','), '1,2,3,4,5,6,7,8,9,10,11,12,13,14,15,16,17,18,19,20,21,22,23,"
       "24,25,26,27,28,29,30,31,32,33,34,35,36,37,38,39,40,41,42,43,44,45,46,47,48,49,50,51,52') AS weeks, "
       "cast(coalesce(o.n_hist, 0) AS int) AS n_history "
       "FROM (SELECT DISTINCT crop, location, pest FROM panel) v "
       "LEFT JOIN cuts c ON v.location = c.location AND v.pest = c.pest "
       "LEFT JOIN endem e ON v.location = e.location AND v.pest = e.pest "
       "LEFT JOIN aw a ON v.location = a.location AND v.pest = a.pest "
       "LEFT JOIN (SELECT location, pest, count(*) AS n_hist FROM obs GROUP BY location, pest) o "
       "ON v.location = o.location AND v.pest = o.pest "
       "LEFT JOIN (SELECT location, pest, trim(regexp_replace(arg_min(unit, week_id), '\\s+', ' ', 'g')) AS unit "
       "FROM (SELECT location, pest, week_id, unit, row_number() OVER (PARTITION BY location, pest "
       "ORDER BY week_id, unit) AS rn FROM clean WHERE pest_value IS NOT NULL) s WHERE rn = 1 "
       "GROUP BY location, pest) u ON v.location = u.location AND v.pest = u.pest",
       FX, SPLIT + [AW_CTE, OBS_CTE])
def forecast_context(spark, sf):
    c = clean(spark, sf)
    p = materialize(B.year_split(P.feature_panel(c, min_obs=S.MIN_OBS_Q), S.SPLIT_YEAR_Q))
    ctx = P.forecast_context(
        series=p.select("crop", "location", "pest").distinct(),
        cutoffs=B.band_cutoffs(p),
        endemic=B.endemic_series(p.filter("is_train"), S.ENDEMIC_Q),
        units=P.series_units(c),
        active=P.active_weeks(p),
        history=P.observed_series(c))
    return finish(ctx.select("crop", "location", "pest", "q1", "q2", "endemic", "unit",
                             F.array_join("weeks", ",").alias("weeks"), "n_history"))


def _count(entry: str, table: str) -> str:
    return f"SELECT '{entry}' AS entry, count(*) AS n_rows FROM {table}"


@query("bundle_sizes", " UNION ALL ".join([
    f"SELECT 'features' AS entry, {len(P.BASE_FEATS)} AS n_rows",
    f"SELECT 'feature_cols' AS entry, {len(P.BASE_FEATS) + 1} + count(DISTINCT crop) + count(DISTINCT location) + count(DISTINCT pest) "
    "AS n_rows FROM panel", _count("feat_clim", "fclim"), _count("feat_clim_global", "fglob"),
    _count("band_cutoffs", "cuts"), _count("endemic", "endem"),
    _count("series_list", "(SELECT DISTINCT crop, location, pest FROM panel) a"), _count("active_weeks", "aw"),
    _count("units", "(SELECT DISTINCT location, pest FROM clean WHERE pest_value IS NOT NULL) u"),
    _count("obs_series", "(SELECT DISTINCT location, pest FROM obs) o")]), FX, SPLIT + FCLIM_CTES + [AW_CTE, OBS_CTE])
def bundle_sizes(spark, sf):
    """The lookup bundle built from one panel, written, read back and counted."""
    c = clean(spark, sf)
    p = materialize(B.year_split(P.feature_panel(c, min_obs=S.MIN_OBS_Q), S.SPLIT_YEAR_Q))
    root = scratch_path(spark, "bundle")
    FS.write_bundle(FC.build_bundle(p, c, S.ENDEMIC_Q), root)
    out = None
    for name, table in FS.read_bundle(spark, root, FC.BUNDLE).items():
        n = table.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("entry"), "n_rows")
        out = n if out is None else out.unionByName(n)
    return out
