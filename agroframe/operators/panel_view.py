"""W1-W3, J1 kept up to date: the feature panel as a view over changing readings.

The weekly sums of the raw panel (weather per location, target per series, readings per viable key) are additive, so a
batch of new readings is aggregated alone and added.  A changed week of a location dirties
the features of the four weeks after it; only those (location, week) rows are computed again, from the weekly table around
them.  Every state table is written as a new version and nothing is changed in place, so a repeated
task or a lost executor meets whole tables only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agroframe.operators import panel as P
from agroframe.session import materialize

REACH = 4  # weeks after a reading whose features see it
_SUMS = [x for c in P.WEATHER for x in (f"{c}_s", f"{c}_n")]


def _add(a: DataFrame | None, b: DataFrame, keys: list[str]) -> DataFrame:
    """Sums of both tables by *keys*."""
    both = b if a is None else a.unionByName(b)
    return both.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in b.columns if c not in keys])


@dataclass
class PanelView:
    """State of the view: weekly weather sums, weekly target sums, readings per series, features per (location, week)."""

    weather: DataFrame | None = None
    target: DataFrame | None = None
    series: DataFrame | None = None
    features: DataFrame | None = None
    recomputed: int = 0  # feature rows that the last batch computed

    def apply(self, batch: DataFrame) -> "PanelView":
        """The view after *batch* (cleaned readings, in any order and of any weeks)."""
        batch = materialize(batch.where("location IS NOT NULL AND week_id IS NOT NULL")
                            .select("crop", "location", "pest", "week_id", "pest_value", *P.WEATHER), "batch")
        sums = [F.sum(c).alias(f"{c}_s") for c in P.WEATHER] + [F.count(c).alias(f"{c}_n") for c in P.WEATHER]
        wx = batch.groupBy("location", "week_id").agg(*sums).na.fill(0.0, [f"{c}_s" for c in P.WEATHER])
        seen = P.monitored(batch).where("pest IS NOT NULL")
        target = seen.groupBy("location", "pest", "week_id").agg(F.sum("pest_value").alias("s"), F.count("*").alias("n"))
        counts = seen.where("crop IS NOT NULL").groupBy("crop", "location", "pest").agg(F.count("*").alias("n_obs"))
        weather = materialize(_add(self.weather, wx, ["location", "week_id"]), "view-weather")
        # the changed weeks and those that look back on them
        dirty = materialize(batch.select("location", F.explode(F.sequence(F.col("week_id"), F.col("week_id") + REACH)).alias("week_id")).distinct(), "dirty")
        around = dirty.select("location", F.explode(F.sequence(F.col("week_id") - REACH, F.col("week_id"))).alias("week_id")).distinct()
        means = [F.try_divide(f"{c}_s", f"{c}_n").alias(c) for c in P.WEATHER]
        local = weather.join(around, ["location", "week_id"], "left_semi").select("location", "week_id", *means)
        fresh = materialize(P.weather_features(local).join(dirty, ["location", "week_id"], "left_semi"), "view-fresh")
        kept = fresh if self.features is None else self.features.join(dirty, ["location", "week_id"], "left_anti").unionByName(fresh)
        return PanelView(weather, materialize(_add(self.target, target, ["location", "pest", "week_id"]), "view-target"),
                         materialize(_add(self.series, counts, ["crop", "location", "pest"]), "view-series"),
                         materialize(kept, "view-features"), fresh.count())

    def panel(self, min_obs: int = P.MIN_OBS, gate: str = "maxt_c_roll4") -> DataFrame:
        """What ``feature_panel`` gives for all readings so far."""
        viable = self.series.where(F.col("n_obs") >= min_obs).select("crop", "location", "pest")
        target = self.target.select("location", "pest", "week_id", (F.col("s") / F.col("n")).alias("pest_value"))
        out = (viable.join(target, ["location", "pest"]).join(self.features, ["location", "week_id"]).where(F.col(gate).isNotNull())
               .withColumns({"year": P.year_of_week("week_id").cast("int"), "y": F.log1p("pest_value")}))
        return out.select("crop", "location", "pest", "week_id", "year", "standard_week", *P.BASE_FEATS, "pest_value", "y")

    def save(self, path: str) -> None:
        for name in ("weather", "target", "series", "features"):
            getattr(self, name).write.mode("overwrite").parquet(f"{path}/{name}")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "PanelView":
        return cls(*[spark.read.parquet(f"{path}/{name}") for name in ("weather", "target", "series", "features")])
