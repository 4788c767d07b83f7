"""Weekly tables stored by location, so that the feature panel reads them without moving a row.

Weekly weather, weekly target and series counts are written as tables with one common number of
buckets of ``location``, sorted by week.  Their joins and the weather window all have
``location`` among their keys, so each task reads the same bucket of all three tables.  Spark plans no
Exchange if the session sets ``spark.sql.requireAllClusterKeysForCoPartition`` to false; by default it wants
all of a join's keys in the buckets and moves the weekly rows, with the same result.  The library leaves the setting
to the session, as it lets every join of a session take fewer keys than it has.  A bucket is bounded by its locations' calendars (pests x weeks rows of target each),
however many raw readings there are.

The tables are external ones of the session's catalogue, under a path that all executors see.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agroframe.operators import panel as P

TABLES = ("weather", "target", "series")


def write(clean: DataFrame, name: str, path: str, buckets: int = 200) -> None:
    """Store the weekly tables of a cleaned panel as ``<name>_weather``, ``<name>_target`` and ``<name>_series`` under *path*.

    Every table's rows are sent to their bucket's task before they are written, so a bucket is one file.
    Rows without location or week are in no weekly group, as in ``feature_panel``.  Existing tables are replaced.
    """
    frames = (P.weekly_weather(clean), P.weekly_target(clean), P.series_counts(clean))
    for kind, frame, order in zip(TABLES, frames, (["week_id"], ["pest", "week_id"], ["pest", "crop"])):
        (frame.repartition(buckets, "location").write.mode("overwrite").option("path", f"{path.rstrip('/')}/{kind}")
         .bucketBy(buckets, "location").sortBy("location", *order).saveAsTable(f"{name}_{kind}"))


def feature_panel(spark: SparkSession, name: str, min_obs: int = P.MIN_OBS, gate: str = "maxt_c_roll4") -> DataFrame:
    """``panel.feature_panel`` from the stored tables: three bucketed scans, no Exchange under the setting named above."""
    weather, target, series = (spark.table(f"{name}_{kind}") for kind in TABLES)
    return P.pooled(series.where(F.col("n_obs") >= min_obs).select(*P.SERIES), target, weather, gate)


def drop(spark: SparkSession, name: str) -> None:
    """Take the tables out of the catalogue; their files stay."""
    for kind in TABLES:
        spark.sql(f"DROP TABLE IF EXISTS `{name}_{kind}`")
