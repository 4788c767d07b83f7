"""Table profiling: nulls, describe, value counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agroframe.operators.ranking import exact_quantiles


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def profile_nulls(df: DataFrame) -> DataFrame:
    """A1: one row per column with its NULL count (one pass, then unpivot)."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return wide.unpivot([], df.columns, "column", "n_null")


def profile_shape(df: DataFrame) -> DataFrame:
    """A1: row and column count."""
    return df.agg(F.count("*").alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)))


def profile_describe(df: DataFrame, cols=None, digits: int = 2) -> DataFrame:
    """A1: count, mean, sample std, min, quartiles, max per numeric column.

    Moments come from one aggregation pass; the quartiles are exact
    (linear interpolation) and computed on the unpivoted long table with a
    skew-safe distributed rank, so no column is sorted inside one task.
    Values are rounded half-to-even like pandas.
    """
    cols = cols or numeric_columns(df)
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot([], cols, "column", "value")
    moments = long.groupBy("column").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"))
    quart = exact_quantiles(long, "value", [0.25, 0.5, 0.75], keys=["column"],
                            names=["p25", "p50", "p75"]).drop("n")
    out = moments.join(quart, "column", "left")
    stats = ["mean", "std", "min", "p25", "p50", "p75", "max"]
    return out.select("column", F.col("count").cast("double").alias("count"),
                      *[F.bround(F.round(F.col(s), 9), digits).alias(s) for s in stats])


def value_counts(df: DataFrame, col: str, digits: int = 3) -> DataFrame:
    """A2: count and proportion per value (proportion rounded half-to-even); NULLs are left out of both.

    The total is a one-row global count (partial-aggregated, broadcast), so
    a column with many distinct values never lands in a single task.
    """
    g = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("count"))
    total = df.agg(F.count(col).alias("_total"))
    return (g.crossJoin(F.broadcast(total))
            .withColumn("proportion", F.bround(F.round(F.col("count") / F.col("_total"), 9), digits))
            .drop("_total"))


def head_rows(df: DataFrame, order, n: int = 5) -> DataFrame:
    """The first *n* rows under an explicit order (files have no row order)."""
    return df.orderBy(*order).limit(n)
