"""Quantiles from merged sketches equal the exact ones, for every cut into batches."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from agroframe.operators import quantile_state as QS
from agroframe.operators.ranking import exact_quantiles

PROBS = [0.0, 1 / 3, 0.5, 2 / 3, 0.975, 1.0]


def rows(spark, n=20_000, seed=3):
    """A third of the rows in one group, heavy ties, a null key, small groups, nulls and NaN."""
    rng = np.random.default_rng(seed)
    key = np.where(rng.random(n) < 0.34, "hot", rng.choice(["a", "b", "c"], n)).astype(object)
    key[rng.random(n) < 0.1] = None
    value = np.where(rng.random(n) < 0.4, 0.0, np.round(rng.lognormal(2, 2, n), 1))
    value = np.where(key == "b", 7.0, value)
    pdf = pd.DataFrame({"g": key, "v": value, "batch": rng.integers(0, 9, n)})
    df = spark.createDataFrame(pdf, "g string, v double, batch long")
    few = spark.createDataFrame([("one", 5.0, 1), ("two", 1.0, 1), ("two", 2.0, 2), ("none", None, 1), ("nan", float("nan"), 1)],
                                "g string, v double, batch long")
    return df.unionByName(few).repartition(7)


def as_dict(df):
    return {r.g: tuple(r)[1:] for r in df.collect()}


@pytest.mark.parametrize("k", [8, 64, 2000])
def test_merged_states_give_the_exact_quantiles(spark, k):
    df = rows(spark)
    state = QS.merge(QS.sketch(df, "v", ["g", "batch"], k), ["g"])
    got = as_dict(QS.quantiles(df, state, "v", PROBS, ["g"], k=k))
    want = as_dict(exact_quantiles(df.where("NOT isnan(v)"), "v", PROBS, ["g"]))
    assert got == want and {"one", "two", None, "hot"} <= set(got) and not {"none", "nan"} & set(got)


def test_only_the_bracket_is_kept(spark):
    df = spark.range(200_000).select(F.lit("x").alias("g"), (F.xxhash64("id") % 10_000_019).cast("double").alias("v"))
    bounds = QS.brackets(QS.sketch(df, "v", ["g"]), [0.5], ["g"])
    counted = QS.bracketed_counts(df, bounds, "v", ["g"]).collect()
    assert sum(r["_c"] for r in counted) == 200_000 and len([r for r in counted if not r["_in"]]) == 2
    assert 0 < len(counted) < 0.02 * 200_000


def test_a_state_of_other_rows_costs_time_only(spark):
    df = spark.range(5000).select(F.lit("x").alias("g"), F.col("id").cast("double").alias("v"))
    other = QS.sketch(df.withColumn("v", F.col("v") + 1e6), "v", ["g"], 64)
    assert as_dict(QS.quantiles(df, other, "v", [0.25, 0.5], ["g"], k=64)) == {"x": (5000, 1249.75, 2499.5)}


def test_no_keys_empty_and_clashing_columns(spark):
    df = rows(spark, 3000).withColumnRenamed("batch", "n").withColumn("sketch", F.lit(1)).withColumn("lows", F.lit(2))
    got = QS.quantiles(df, QS.sketch(df, "v", (), 64), "v", [0.5], k=64).first()
    assert tuple(got) == tuple(exact_quantiles(df.where("NOT isnan(v)"), "v", [0.5]).first())
    none = df.limit(0)
    assert QS.quantiles(none, QS.sketch(none, "v", ["g"]), "v", [0.5], ["g"]).count() == 0
