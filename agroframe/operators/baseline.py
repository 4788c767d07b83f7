"""Seasonal baselines, endemic labels, climatologies and risk bands.

All lookups are (location, pest[, week]) dimension tables: they aggregate
the panel map-side first, so their size is bounded by the number of series
times 53 weeks, never by the number of raw readings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from agroframe.session import materialize
from agroframe.operators import quantile_state as QS
from agroframe.operators.panel import BASE_FEATS, ENDEMIC_THR, SPLIT_YEAR, add_presence
from agroframe.operators.ranking import join_null_safe

SERIES2 = ["location", "pest"]


def year_split(panel: DataFrame, split_year: int = SPLIT_YEAR) -> DataFrame:
    """``is_train`` = year before *split_year* (its complement is test)."""
    return panel.withColumn("is_train", F.col("year") < split_year)


def seasonal_climatology(train: DataFrame, target: str = "y") -> DataFrame:
    """Mean target per (location, pest, week of year) over training rows."""
    return (train.groupBy(*SERIES2, "standard_week")
            .agg(F.avg(target).alias("clim"), F.count("*").alias("n_train")))


def flat_baseline(train: DataFrame, target: str = "y") -> DataFrame:
    """A10: one-row table with the flat training mean."""
    return train.agg(F.avg(target).alias("flat"), F.count("*").alias("n_train"))


def with_seasonal_baseline(df: DataFrame, train: DataFrame, target: str = "y",
                           out: str = "seas") -> DataFrame:
    """Per-row seasonal baseline, falling back to the flat training mean.

    The flat mean is a single row (cross join of one row); the climatology is
    a (series x week) dimension joined on its keys.
    """
    clim = seasonal_climatology(train, target).select(*SERIES2, "standard_week", "clim")
    flat = flat_baseline(train, target).select("flat")
    return (df.join(clim, on=[*SERIES2, "standard_week"], how="left")
            .crossJoin(F.broadcast(flat))
            .withColumn(out, F.coalesce("clim", "flat"))
            .drop("clim", "flat"))


def endemic_series(train: DataFrame, threshold: float = ENDEMIC_THR) -> DataFrame:
    """Training presence rate per (location, pest) and endemic flag."""
    return (add_presence(train).groupBy(*SERIES2)
            .agg(F.avg("present").alias("train_presence"))
            .withColumn("endemic", F.col("train_presence") >= threshold))


def with_endemic(df: DataFrame, endemic: DataFrame) -> DataFrame:
    """Endemic flag per row; series without training rows are not endemic."""
    return (df.join(endemic.select(*SERIES2, F.col("endemic").alias("_e")), on=SERIES2, how="left")
            .withColumn("endemic", F.coalesce("_e", F.lit(False))).drop("_e"))


def climatology_table(panel: DataFrame, feats=BASE_FEATS) -> DataFrame:
    """A12 in one pass: mean of every feature per (location, week), and over everything (``is_global``)."""
    keys = ["location", "standard_week"]
    return (panel.groupingSets([keys, []], *keys)
            .agg(*[F.avg(c).alias(c) for c in feats], (F.grouping_id() > 0).alias("is_global")))


def feature_climatology(panel: DataFrame, feats=BASE_FEATS) -> tuple[DataFrame, DataFrame]:
    """Mean of every feature per (location, week) plus one global row, computed once.

    Grouping sets give no row for an empty panel; the global row is there all
    the same, with NULL means.
    """
    both = materialize(climatology_table(panel, feats), "climatology")
    glob = both.filter("is_global").agg(*[F.first(c).alias(c) for c in feats])
    return both.filter("not is_global").drop("is_global"), glob


def climatology_lookup(requests: DataFrame, by_week: DataFrame, glob: DataFrame,
                       feats=BASE_FEATS) -> DataFrame:
    """Climatology row per (location, standard_week) request, else the global row."""
    g = glob.select(*[F.col(c).alias(f"_g_{c}") for c in feats])
    j = (requests.join(by_week.withColumn("_hit", F.lit(True)),
                       on=["location", "standard_week"], how="left")
         .crossJoin(F.broadcast(g)))
    cols = {c: F.when(F.col("_hit"), F.col(c)).otherwise(F.col(f"_g_{c}")) for c in feats}
    cols["from_global"] = F.col("_hit").isNull()
    return j.withColumns(cols).drop("_hit", *[f"_g_{c}" for c in feats])


def band_cutoffs(panel: DataFrame, min_pos: int = 8, value: str = "pest_value") -> DataFrame:
    """A13(b): tercile cut-offs of the positive readings per (location, pest).

    >= min_pos positives -> 1/3 and 2/3 quantiles; 1..min_pos-1 -> the median
    twice; none -> (1, 1).  ``percentile`` is exact with linear interpolation
    and combines partial maps per series (bounded by the series' weeks).
    """
    pos = F.when(F.col(value) > 0, F.col(value))
    g = panel.groupBy(*SERIES2).agg(
        F.count(pos).alias("_npos"),
        F.percentile(pos, [1 / 3, 2 / 3]).alias("_t"),
        F.percentile(pos, 0.5).alias("_m"))
    return g.select(
        *SERIES2,
        F.when(F.col("_npos") >= min_pos, F.col("_t")[0])
        .when(F.col("_npos") > 0, F.col("_m")).otherwise(F.lit(1.0)).alias("q1"),
        F.when(F.col("_npos") >= min_pos, F.col("_t")[1])
        .when(F.col("_npos") > 0, F.col("_m")).otherwise(F.lit(1.0)).alias("q2"))


def band_cutoffs_sketched(panel: DataFrame, min_pos: int = 8, value: str = "pest_value", batch: str = "year", k: int = QS.K) -> DataFrame:
    """``band_cutoffs`` for series of any length: a sketch per series and *batch*, merged, and one counting pass.

    The batches' states can be kept: a new year is sketched alone.
    """
    pos = panel.filter(F.col(value) > 0)
    state = QS.merge(QS.sketch(pos, value, [*SERIES2, batch], k), SERIES2)
    q = QS.quantiles(pos, state, value, [1 / 3, 0.5, 2 / 3], SERIES2, ["_t1", "_m", "_t2"], k)
    many = F.col("n") >= min_pos
    cut = lambda tercile: F.coalesce(F.when(many, F.col(tercile)).otherwise(F.col("_m")), F.lit(1.0))
    return join_null_safe(panel.select(*SERIES2).distinct(), q, list(SERIES2), "left") \
        .select(*SERIES2, cut("_t1").alias("q1"), cut("_t2").alias("q2"))


def band_cutoffs_all(train: DataFrame, keys=SERIES2, value: str = "pest_value") -> DataFrame:
    """A13(a): terciles of all training readings (zeros included) per key."""
    return (train.groupBy(*keys).agg(F.percentile(value, [1 / 3, 2 / 3]).alias("_t"))
            .select(*keys, F.col("_t")[0].alias("q1"), F.col("_t")[1].alias("q2")))


def band_of(value, q1="q1", q2="q2"):
    """P25 band code: 0 (<= q1), 1 (<= q2), 2 otherwise; missing cut-offs -> 2."""
    v = F.col(value) if isinstance(value, str) else value
    return (F.when(F.coalesce(v <= F.col(q1), F.lit(False)), 0)
            .when(F.coalesce(v <= F.col(q2), F.lit(False)), 1).otherwise(2))


def band_names():
    return F.array(F.lit("Low"), F.lit("Medium"), F.lit("High"))


def risk_band(df: DataFrame, cutoffs: DataFrame, y_log: str = "y_log") -> DataFrame:
    """P25: predicted count (clamped at 0 for display) and Low/Medium/High band.

    The band uses the unclamped count (compared at 1e-9, so a count equal to
    a cut-off is not flipped by floating noise); series without cut-offs are
    High.
    """
    j = df.join(cutoffs, on=SERIES2, how="left")
    cnt = F.round(F.expm1(F.col(y_log)), 9)
    return j.withColumns({"count": F.greatest(F.lit(0.0), cnt),
                          "band": band_names()[band_of(cnt)]})


def time_fraction_split(panel: DataFrame, keys=("crop", "location", "pest"), frac: float = 0.75,
                        order: str = "week_id") -> DataFrame:
    """The first int(frac * n) weeks of each series are training rows.

    A series has one row per week, so the per-series window is bounded by
    the calendar (no hot group can exceed it).
    """
    w = Window.partitionBy(*keys)
    return (panel.withColumn("_rn", F.row_number().over(w.orderBy(order)))
            .withColumn("_n", F.count("*").over(w))
            .withColumn("is_train", F.col("_rn") <= F.floor(F.col("_n") * frac))
            .drop("_rn", "_n"))
