"""Sensor table: header clean-up, range rules, health label and report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agroframe.functions.columns import sum_of

# Raw sensor header -> column name.
RENAME = {
    "Temperature [_ C]": "temperature_c",
    "Humidity [%]": "humidity_pct",
    "Soil moisture": "soil_moisture_raw",
    "Reference evapotranspiration": "ref_et",
    "Evapotranspiration": "et",
    "Crop Coefficient": "crop_coeff",
    "Crop Coefficient stage": "growth_stage",
    "Nitrogen [mg/kg]": "nitrogen",
    "Phosphorus [mg/kg]": "phosphorus",
    "Potassium": "potassium",
    "Solar Radiation ghi": "solar_radiation",
    "Wind Speed": "wind_speed",
    "Days of planted": "days_planted",
    "pH": "ph",
}

# Growth stages of the crop coefficient.
GROWTH_STAGES = ("F", "O", "P")

# Healthy ranges (inclusive) and display labels.
THRESHOLDS = {
    "temperature_c": (18.0, 30.0),
    "humidity_pct": (50.0, 85.0),
    "nitrogen": (50.0, 250.0),
    "phosphorus": (20.0, 120.0),
    "potassium": (40.0, 250.0),
}
LABELS = {
    "temperature_c": "Temperature (°C)",
    "humidity_pct": "Humidity (%)",
    "nitrogen": "Nitrogen (mg/kg)",
    "phosphorus": "Phosphorus (mg/kg)",
    "potassium": "Potassium (mg/kg)",
}


def trim_headers(df: DataFrame) -> DataFrame:
    """Strip stray spaces from column names."""
    return df.toDF(*[c.strip() for c in df.columns])


def rename_sensor(df: DataFrame, mapping=None) -> DataFrame:
    """Rename known raw headers; unknown names are left alone."""
    mapping = RENAME if mapping is None else mapping
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def drop_present(df: DataFrame, cols) -> DataFrame:
    """Drop columns, ignoring the ones that are absent."""
    return df.drop(*cols)


def rules_table(spark: SparkSession, rules=None) -> DataFrame:
    """Rules as a tiny dimension (variable, label, lo, hi, healthy_range)."""
    rules = THRESHOLDS if rules is None else rules
    rows = [(v, LABELS.get(v, v), float(lo), float(hi), f"{lo:g} – {hi:g}")
            for v, (lo, hi) in rules.items()]
    return spark.createDataFrame(rows, "variable string, label string, lo double, hi double, "
                                       "healthy_range string")


def range_flags(df: DataFrame, rules=None) -> DataFrame:
    """``<var>_ok`` per rule present in *df*; bounds inclusive, NULL is out of range."""
    rules = THRESHOLDS if rules is None else rules
    present = {v: b for v, b in rules.items() if v in df.columns}
    return df.withColumns({f"{v}_ok": F.coalesce(F.col(v).between(lo, hi), F.lit(False))
                           for v, (lo, hi) in present.items()})


def health_label(df: DataFrame, rules=None) -> DataFrame:
    """stress_score = number of variables out of range; label 1 = healthy."""
    rules = THRESHOLDS if rules is None else rules
    flagged = range_flags(df, rules)
    oks = [f"{v}_ok" for v in rules if f"{v}_ok" in flagged.columns]
    score = sum_of([(~F.col(c)).cast("int") for c in oks])
    return (flagged.withColumn("stress_score", score)
            .withColumn("health_label", (F.col("stress_score") == 0).cast("int"))
            .drop(*oks))


def health_report(df: DataFrame, rules=None, id_col: str = "row_id") -> tuple[DataFrame, DataFrame]:
    """One row per (reading, variable) plus one verdict row per reading.

    Readings are unpivoted to long form and joined to the tiny rules table
    (broadcast: its size is the number of rules, a fixed handful).
    """
    rules = THRESHOLDS if rules is None else rules
    rules_df = rules_table(df.sparkSession, rules)
    names = list(rules)
    long = df.select(id_col, *[F.col(v).cast("double").alias(v) for v in names]).unpivot(
        id_col, names, "variable", "value")
    rows = (long.join(F.broadcast(rules_df), on="variable", how="inner")
            .withColumn("ok", F.coalesce(F.col("value").between(F.col("lo"), F.col("hi")), F.lit(False)))
            .withColumn("status", F.when(F.col("ok"), "✓ in range").otherwise("✗ out of range"))
            .select(id_col, "variable", "label", "value", "healthy_range", "ok", "status"))
    # the verdict comes from the wide flags: no regrouping of the long rows
    flags = range_flags(df.select(id_col, *names), rules)
    out = sum_of([(~F.col(f"{v}_ok")).cast("long") for v in names])
    verdict = flags.select(id_col, out.alias("out_of_range")).withColumn(
        "status", F.when(F.col("out_of_range") == 0, "Healthy").otherwise("At risk"))
    return rows, verdict


def one_hot_drop_first(df: DataFrame, col: str, levels, prefix: str | None = None) -> DataFrame:
    """P13 (table form): 0/1 columns for every one of *levels* but the alphabetically first.

    Unlisted values are 0 everywhere, NULL stays NULL.
    """
    prefix = prefix or col
    return df.withColumns({f"{prefix}_{lv}": (F.col(col) == lv).cast("int")
                           for lv in sorted(levels)[1:]}).drop(col)
