"""Evaluation metrics as aggregations (no driver-side arrays)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agroframe.operators import quantile_state as QS
from agroframe.operators.ranking import exact_quantiles


def confusion_counts(df: DataFrame, y: str, p: str) -> DataFrame:
    """All cells of the confusion matrix in one map-side-combined group-by."""
    return df.groupBy(F.col(y).alias("label"), F.col(p).alias("prediction")).agg(F.count("*").alias("n"))


def classification_report(df: DataFrame, y: str, p: str) -> DataFrame:
    """Per-class precision/recall/F1/support, accuracy, macro and weighted mean.

    Zero divisions give 0 (sklearn's default).  Everything is derived from
    the (#classes^2)-row confusion table.
    """
    cm = confusion_counts(df, y, p)
    support = cm.groupBy("label").agg(F.sum("n").alias("support"))
    predicted = cm.groupBy(F.col("prediction").alias("label")).agg(F.sum("n").alias("predicted"))
    tp = cm.filter(F.col("label") == F.col("prediction")).select("label", F.col("n").alias("tp"))
    per = (support.join(predicted, "label", "full").join(tp, "label", "left")
           .na.fill(0, ["support", "predicted", "tp"]))
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(0.0)
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    per = per.withColumns({"precision": prec, "recall": rec})
    per = per.withColumn("f1", F.when(F.col("precision") + F.col("recall") > 0,
                                      2 * F.col("precision") * F.col("recall")
                                      / (F.col("precision") + F.col("recall"))).otherwise(0.0))
    classes = per.select(F.col("label").cast("string").alias("label"), "precision", "recall", "f1",
                         F.col("support").cast("double").alias("support"))
    tot = per.agg(F.sum("support").alias("N"), F.sum("tp").alias("TP"),
                  F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
                  (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("wp"),
                  (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("wr"),
                  (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("wf"))
    acc = tot.select(F.lit("accuracy").alias("label"), F.lit(None).cast("double").alias("precision"),
                     F.lit(None).cast("double").alias("recall"), (F.col("TP") / F.col("N")).alias("f1"),
                     F.col("N").cast("double").alias("support"))
    macro = tot.select(F.lit("macro avg").alias("label"), F.col("mp").alias("precision"),
                       F.col("mr").alias("recall"), F.col("mf").alias("f1"),
                       F.col("N").cast("double").alias("support"))
    weighted = tot.select(F.lit("weighted avg").alias("label"), F.col("wp").alias("precision"),
                          F.col("wr").alias("recall"), F.col("wf").alias("f1"),
                          F.col("N").cast("double").alias("support"))
    return classes.unionByName(acc).unionByName(macro).unionByName(weighted)


def confusion_matrix(df: DataFrame, y: str, p: str, levels) -> DataFrame:
    """Complete grid over *levels* (rows = true, columns = predicted), 0-filled."""
    levels = list(levels)
    spark = df.sparkSession
    spine = spark.createDataFrame([(lv,) for lv in levels], ["label"])  # the fixed level list
    cm = confusion_counts(df, y, p)
    grid = cm.groupBy("label").pivot("prediction", levels).agg(F.sum("n"))
    out = spine.join(grid, "label", "left")
    return out.select("label", *[F.coalesce(F.col(str(lv)), F.lit(0)).cast("long").alias(f"pred_{lv}")
                                 for lv in levels])


def regression_report(df: DataFrame, y: str, preds, block: str | None = None) -> DataFrame:
    """MAE and R^2 per (block, model) in one pass.

    Each row belongs to block "ALL" plus, optionally, the block named in
    column *block*; models are the prediction columns *preds*.  R^2 =
    1 - SSE / (n * var_pop(y)).
    """
    preds = list(preds)
    blocks = F.array(F.lit("ALL")) if block is None else \
        F.when(F.col(block).isNull(), F.array(F.lit("ALL"))).otherwise(F.array(F.lit("ALL"), F.col(block)))
    long = (df.select(F.col(y).alias("_y"), F.explode(blocks).alias("block"), *preds)
            .unpivot(["_y", "block"], preds, "model", "_p"))
    g = long.groupBy("block", "model").agg(
        F.count("*").alias("n"), F.avg(F.abs(F.col("_y") - F.col("_p"))).alias("mae"),
        F.sum((F.col("_y") - F.col("_p")) ** 2).alias("_sse"), F.var_pop("_y").alias("_v"))
    # sklearn convention for a constant target: 1 if perfect, else 0
    r2 = (F.when(F.col("_v") > 0, 1 - F.col("_sse") / (F.col("_v") * F.col("n")))
          .when(F.col("_sse") == 0, 1.0).otherwise(0.0))
    return g.select("block", "model", "n", "mae", r2.alias("r2"))


def median_abs_error(df: DataFrame, y: str, preds, transform=F.expm1) -> DataFrame:
    """Exact median absolute error (on back-transformed counts) per model."""
    preds = list(preds)
    long = df.select(F.col(y).alias("_y"), *preds).unpivot(["_y"], preds, "model", "_p")
    err = long.select("model", F.abs(transform(F.col("_p")) - transform(F.col("_y"))).alias("abs_err"))
    return exact_quantiles(err, "abs_err", [0.5], keys=["model"], names=["median_abs_err"])


def median_abs_error_sketched(df: DataFrame, y: str, preds, batch: str, transform=F.expm1, k: int = QS.K) -> DataFrame:
    """``median_abs_error`` without sorting the errors: sketches per model and *batch*, merged, and one counting pass."""
    preds = list(preds)
    long = df.select(batch, F.col(y).alias("_y"), *preds).unpivot([batch, "_y"], preds, "model", "_p")
    err = long.select(batch, "model", F.abs(transform(F.col("_p")) - transform(F.col("_y"))).alias("abs_err"))
    state = QS.merge(QS.sketch(err, "abs_err", ["model", batch], k), ["model"])
    return QS.quantiles(err, state, "abs_err", [0.5], ["model"], ["median_abs_err"], k)


def accuracy(df: DataFrame, y: str, p: str, keys=()) -> DataFrame:
    """Share of rows where *y* equals *p*."""
    acc = F.avg((F.col(y) == F.col(p)).cast("double")).alias("accuracy")
    n = F.count("*").alias("n")
    return df.groupBy(*keys).agg(acc, n) if keys else df.agg(acc, n)


def series_report(df: DataFrame, keys, y: str, preds) -> DataFrame:
    """A28-A30 per series: n, MAE and R^2, median absolute error in counts, and band accuracy of every model.

    Bands are in columns ``band_<y>`` and ``band_<model>``.  A series is bounded by the calendar, so its exact
    median is an aggregate.
    """
    keys, preds = list(keys), list(preds)
    rows = df.select(*keys, F.col(y).alias("_y"), F.col(f"band_{y}").alias("_band"), F.explode(F.array(*[
        F.struct(F.lit(m).alias("model"), F.col(m).alias("_p"), F.col(f"band_{m}").alias("_b")) for m in preds])).alias("_m"))
    rows = rows.select(*keys, "_y", "_band", "_m.*")
    g = rows.groupBy(*keys, "model").agg(
        F.count("*").alias("n"), F.avg(F.abs(F.col("_y") - F.col("_p"))).alias("mae"),
        F.sum((F.col("_y") - F.col("_p")) ** 2).alias("_sse"), F.var_pop("_y").alias("_v"),
        F.percentile(F.abs(F.expm1("_p") - F.expm1("_y")), 0.5).alias("median_abs_err"),
        F.avg((F.col("_band") == F.col("_b")).cast("double")).alias("band_accuracy"))
    r2 = (F.when(F.col("_v") > 1e-12, 1 - F.col("_sse") / (F.col("_v") * F.col("n")))
          .when(F.col("_sse") <= 1e-12, 1.0).otherwise(0.0))
    return g.select(*keys, "model", "n", "mae", r2.alias("r2"), "median_abs_err", "band_accuracy")
