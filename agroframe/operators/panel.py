"""Weekly pest panel: cleaning, weekly means, weather features, pooled panel.

Grain of the raw panel: one row per (crop, location, pest, year, week).
Everything below aggregates *before* it windows or joins, so the window
partitions (one per location) hold at most one row per calendar week no
matter how many raw rows a location has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from agroframe.functions.columns import (PEST_BAD_TOKENS, WEATHER_BAD_TOKENS, clean_number,
                                         week_date, week_id, week_of_year, year_of_week)

# The eight weather variables and the feature kinds, in order.
WEATHER = ["maxt_c", "mint_c", "rh1_pct", "rh2_pct", "rf_mm", "ws_kmph", "ssh_hrs", "evp_mm"]
FEATURE_KINDS = ("lag1", "roll4", "trend")
BASE_FEATS = [f"{c}_{k}" for c in WEATHER for k in FEATURE_KINDS]
# Reference defaults.
MIN_OBS, SPLIT_YEAR, ENDEMIC_THR = 150, 2006, 0.70

SERIES = ["crop", "location", "pest"]


def clean_panel(raw: DataFrame, bad_pest=PEST_BAD_TOKENS, bad_weather=WEATHER_BAD_TOKENS) -> DataFrame:
    """P4 + P5: dirty text -> double (NULL, never NaN) and the week index."""
    cols = {"pest_value": clean_number("pest_value", bad_pest)}
    cols.update({c: clean_number(c, bad_weather) for c in WEATHER})
    cols["week_id"] = week_id()
    return raw.withColumns(cols)


def add_week_date(df: DataFrame) -> DataFrame:
    """Approximate calendar date of the week."""
    return df.withColumn("date", week_date())


def decode_week(df: DataFrame, col: str = "week_id") -> DataFrame:
    """Year and week-of-year back from the week index."""
    return df.withColumns({"year": year_of_week(col).cast("int"),
                           "standard_week": week_of_year(col)})


def monitored(df: DataFrame) -> DataFrame:
    """Rows with a reading."""
    return df.filter(F.col("pest_value").isNotNull())


def unmonitored(df: DataFrame) -> DataFrame:
    return df.filter(F.col("pest_value").isNull())


def add_presence(df: DataFrame) -> DataFrame:
    """Presence flag (value > 0)."""
    return df.withColumn("present", (F.col("pest_value") > 0).cast("int"))


def log_target(df: DataFrame, col: str = "pest_value", out: str = "y") -> DataFrame:
    """log1p target."""
    return df.withColumn(out, F.log1p(col))


def _keyed(clean: DataFrame, *more: str) -> DataFrame:
    """Rows of a weekly group; rows without a key belong to none (pandas drops NULL keys)."""
    keep = F.col("location").isNotNull()
    for k in more:
        keep = keep & F.col(k).isNotNull()
    return clean.filter(keep)


def weekly_weather(clean: DataFrame, keys=("location",)) -> DataFrame:
    """A4: mean weather per (location, week), all pests pooled, NULLs skipped.

    One aggregation of the raw rows with map-side partial sums, over a scan of
    the key and weather columns only.
    """
    return _keyed(clean, "week_id").groupBy(*keys, "week_id").agg(*[F.avg(c).alias(c) for c in WEATHER])


def weekly_target(clean: DataFrame, by_crop: bool = False) -> DataFrame:
    """A5: mean reading per (location, pest, week) over monitored rows.

    The reference leaves crop out of this grouping (one pooled target per
    location and pest); ``by_crop=True`` keeps crops apart.
    """
    keys = (["crop"] if by_crop else []) + ["location", "pest", "week_id"]
    return monitored(_keyed(clean, *keys)).groupBy(*keys).agg(F.avg("pest_value").alias("pest_value"))


def dense_weeks(wx: DataFrame, keys=("location",)) -> DataFrame:
    """Every week between each key's first and last week, left-joined.

    The calendar is generated per key with ``sequence`` (no driver-side
    range), so its size is (#keys x span) and it joins on the same keys.
    """
    keys = list(keys)
    span = (wx.groupBy(*keys).agg(F.min("week_id").alias("_lo"), F.max("week_id").alias("_hi"))
            .select(*keys, F.explode(F.sequence("_lo", "_hi")).alias("week_id")))
    return span.join(wx, on=keys + ["week_id"], how="left")


def weather_features(wx: DataFrame, cols=WEATHER, keys=("location",)) -> DataFrame:
    """lag1, roll4 (all four prior weeks present) and trend per key.

    Frames are RANGE frames on the week index, so a missing week counts as
    missing exactly as on a densified calendar, without materialising the
    gap weeks.  All 24 expressions share one partitioning and ordering, so
    the plan has a single exchange and a single sort.
    """
    keys = list(keys)
    w = Window.partitionBy(*keys).orderBy("week_id")
    lag1 = w.rangeBetween(-1, -1)
    lag4 = w.rangeBetween(-4, -4)
    prev4 = w.rangeBetween(-4, -1)
    out = {"standard_week": week_of_year("week_id")}
    for c in cols:
        l1 = F.first(c).over(lag1)
        out[f"{c}_lag1"] = l1
        out[f"{c}_roll4"] = F.when(F.count(c).over(prev4) == 4, F.avg(c).over(prev4))
        out[f"{c}_trend"] = l1 - F.first(c).over(lag4)
    return wx.select(*keys, "week_id", *[e.alias(n) for n, e in out.items()])


def series_counts(clean: DataFrame) -> DataFrame:
    return monitored(_keyed(clean, "week_id", "crop", "pest")).groupBy(*SERIES).agg(F.count("*").alias("n_obs"))


def viable_series(clean: DataFrame, min_obs: int = MIN_OBS) -> DataFrame:
    """(crop, location, pest) with at least *min_obs* readings."""
    return series_counts(clean).filter(F.col("n_obs") >= min_obs)


def viable_panel(clean: DataFrame, min_obs: int = MIN_OBS) -> DataFrame:
    """Raw rows of viable series only (left-semi join)."""
    return clean.join(viable_series(clean, min_obs).select(*SERIES), on=SERIES, how="left_semi")


def feature_panel(clean: DataFrame, min_obs: int = MIN_OBS, gate: str = "maxt_c_roll4",
                  by_crop: bool = False) -> DataFrame:
    """J1 (flagship): pooled model panel, one row per viable series and week.

    viable series -> pooled weekly target -> weather features of the week at
    that location; rows need a target and a non-null *gate* feature.  Each
    of the three branches scans only its own columns of the raw panel and sends
    only partial aggregates over the network; nothing is written in between.
    """
    viable = viable_series(clean, min_obs).select(*SERIES)
    return pooled(viable, weekly_target(clean, by_crop), weekly_weather(clean), gate, by_crop)


def pooled(viable: DataFrame, tgt: DataFrame, wx: DataFrame, gate: str = "maxt_c_roll4", by_crop: bool = False) -> DataFrame:
    """The feature panel of viable series, weekly target and weekly weather, computed or stored (``panel_store``)."""
    feats = weather_features(wx)
    on = ["crop", "location", "pest"] if by_crop else ["location", "pest"]
    panel = (viable.join(tgt, on=on, how="inner")
             .join(feats, on=["location", "week_id"], how="inner")
             .filter(F.col("pest_value").isNotNull() & F.col(gate).isNotNull()))
    return (panel.withColumns({"year": year_of_week("week_id").cast("int"),
                               "y": F.log1p("pest_value")})
            .select("crop", "location", "pest", "week_id", "year", "standard_week",
                    *BASE_FEATS, "pest_value", "y"))


def series_stats(clean: DataFrame) -> DataFrame:
    """Per-series observation, presence and absence counts."""
    return (monitored(_keyed(clean, "week_id", "crop", "pest")).groupBy(*SERIES)
            .agg(F.count("*").alias("n_obs"), F.count_if(F.col("pest_value") > 0).alias("n_present"))
            .withColumns({"n_absent": F.col("n_obs") - F.col("n_present"),
                          "pct_present": F.bround(F.col("n_present") / F.col("n_obs") * 100, 1)}))


def modelable(stats: DataFrame, min_obs: int = 100, min_present: int = 20,
              min_absent: int = 20) -> DataFrame:
    """Enough data and both classes represented."""
    return stats.filter((F.col("n_obs") >= min_obs) & (F.col("n_present") >= min_present)
                        & (F.col("n_absent") >= min_absent))


def panel_summary(clean: DataFrame) -> DataFrame:
    """A3: total/monitored rows, year range, distinct pests, weather NULLs."""
    return clean.agg(
        F.count("*").alias("n_rows"),
        F.count("pest_value").alias("n_monitored"),
        F.count_if(F.col("pest_value").isNull()).alias("n_unmonitored"),
        F.min("year").alias("year_min"), F.max("year").alias("year_max"),
        F.countDistinct("pest").alias("n_pests"),
        *[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in WEATHER])


# ---------------------------------------------------------------- bundle tables
def active_weeks(panel: DataFrame) -> DataFrame:
    """Sorted distinct weeks of year with panel rows per (location, pest).

    ``collect_set`` is bounded: at most 53 values per series.
    """
    return (panel.groupBy("location", "pest")
            .agg(F.array_sort(F.collect_set("standard_week")).alias("weeks")))


def all_weeks():
    return F.sequence(F.lit(1), F.lit(52))


def default_week(active: DataFrame) -> DataFrame:
    """Middle active week; weeks 1..52 when a series has none."""
    weeks = F.when(F.size(F.coalesce("weeks", F.array())) > 0, F.col("weeks")).otherwise(all_weeks())
    return active.withColumn("default_week", F.element_at(weeks, (F.size(weeks) / 2).cast("int") + 1))


def week_range(active: DataFrame) -> DataFrame:
    """first/last monitored week and whether the range has gaps."""
    return active.withColumns({
        "wmin": F.array_min("weeks"), "wmax": F.array_max("weeks")}).withColumn(
        "has_gaps", F.size("weeks") != F.col("wmax") - F.col("wmin") + 1)


def series_units(clean: DataFrame) -> DataFrame:
    """Measurement unit per (location, pest), whitespace collapsed.

    Files have no row order in Spark; "first" is the unit of the earliest
    week (ties by text), taken with a map-side ``min_by``.
    """
    from agroframe.functions.columns import squash_spaces
    return (monitored(clean).groupBy("location", "pest")
            .agg(F.min_by("unit", F.struct("week_id", "unit")).alias("unit"))
            .withColumn("unit", squash_spaces("unit")))


def observed_series(clean: DataFrame) -> DataFrame:
    """Week-sorted (week_id, mean value) history per (location, pest).

    Built from the weekly means, so each array holds at most one entry per
    calendar week of the series.
    """
    wk = weekly_target(clean).withColumnRenamed("pest_value", "value")
    return (wk.groupBy("location", "pest")
            .agg(F.array_sort(F.collect_list(F.struct("week_id", "value"))).alias("history")))


def obs_gaps(weekly: DataFrame, keys=("location", "pest")) -> DataFrame:
    """Gap in weeks to the previous / next observation, at least 1."""
    w = Window.partitionBy(*keys).orderBy("week_id")
    prev, nxt = F.lag("week_id").over(w), F.lead("week_id").over(w)
    return weekly.withColumns({
        "gap_prev": F.when(prev.isNotNull(), F.greatest(F.lit(1), F.col("week_id") - prev)),
        "gap_next": F.when(nxt.isNotNull(), F.greatest(F.lit(1), nxt - F.col("week_id")))})


def recent_history(weekly: DataFrame, n: int = 120, min_obs: int = 10,
                   keys=("location", "pest")) -> DataFrame:
    """Last *n* readings of each series with at least *min_obs* readings."""
    w = Window.partitionBy(*keys)
    return (weekly.withColumn("_rn", F.row_number().over(w.orderBy(F.desc("week_id"))))
            .withColumn("_n", F.count("*").over(w))
            .filter((F.col("_n") >= min_obs) & (F.col("_rn") <= n))
            .select(*keys, "week_id", "value", (F.col("week_id") / 52.0).alias("year_frac")))


def forecast_context(series, cutoffs, endemic, units, active, history) -> DataFrame:
    """Every per-series lookup with the app's defaults for missing entries."""
    k = ["location", "pest"]
    return (series.join(cutoffs, k, "left")
            .join(endemic.select(*k, "endemic"), k, "left")
            .join(units, k, "left")
            .join(active, k, "left")
            .join(history.select(*k, F.size("history").alias("n_history")), k, "left")
            .withColumns({"endemic": F.coalesce("endemic", F.lit(False)),
                          "unit": F.coalesce("unit", F.lit("units")),
                          "weeks": F.coalesce("weeks", all_weeks()),
                          "n_history": F.coalesce("n_history", F.lit(0))}))
