"""Embedding statistics and Mahalanobis out-of-distribution scoring.

What reaches the driver is bounded by the dimension (one d x d matrix). Everything
proportional to the number of embeddings or classes stays distributed:

* class means: ``Summarizer.mean`` per label (a map-side-combined UDAF);
* pooled covariance: each task folds its centred rows into one d x d
  partial sum (``mapInPandas``), sent as d vectors that are summed map-side;
* scoring: rows against class means, a block at a time (``against_means``);
* moments that merge and subtract are in ``operators.moments``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agroframe.operators.ranking import exact_quantiles
from agroframe.session import materialize

# Strictness multipliers of the rejection threshold, ridge, percentile.
STRICTNESS = {"Lenient": 1.3, "Balanced": 1.1, "Strict": 0.9}
RIDGE = 1e-3
THRESHOLD_PCT = 97.5

HELD_BYTES = 32 << 20      # class means that the tasks get whole
TILE, BLOCK = 1024, 8192   # classes and rows that meet in one task beyond that


def class_means(emb: DataFrame, label: str = "label", vec: str = "embedding") -> DataFrame:
    """Mean embedding per label as ``array<double>``."""
    return (emb.groupBy(label)
            .agg(vector_to_array(Summarizer.mean(array_to_vector(F.col(vec)))).alias("mean")))


def centered(emb: DataFrame, means: DataFrame, label: str = "label", vec: str = "embedding") -> DataFrame:
    """Every row minus its class mean (one row per class; AQE broadcasts it)."""
    return (emb.join(means, label, "inner")
            .withColumn("centered", F.zip_with(F.col(vec).cast("array<double>"), F.col("mean"),
                                               lambda x, m: x - m))
            .drop("mean"))


def pooled_cov_rows(emb: DataFrame, means: DataFrame, label: str = "label", vec: str = "embedding",
                    ridge: float = RIDGE) -> DataFrame:
    """A32 packed: (i, row) with the d values of row i of the pooled covariance plus ridge * I.

    One pass: every task folds its centred rows into one matrix and sends
    d vectors (row i and the number of rows behind it); vector sums
    are combined map-side again before the shuffle.
    """
    c = centered(emb, means, label, vec).select("centered")

    def partial(batches):
        acc, n = 0.0, 0
        for pdf in batches:
            if len(pdf):
                x = np.stack(pdf["centered"].to_numpy()).astype(np.float64)
                acc, n = acc + x.T @ x, n + len(x)
        if n:
            yield pd.DataFrame({"i": np.arange(len(acc), dtype="int32"), "part": [[*row, float(n)] for row in acc]})

    parts = c.mapInPandas(partial, "i int, part array<double>")
    total = parts.groupBy("i").agg(vector_to_array(Summarizer.sum(array_to_vector("part"))).alias("t"))
    n = F.element_at("t", -1)
    return total.select("i", F.transform(F.slice("t", 1, F.size("t") - 1), lambda x, j: x / n + F.when(
        j == F.col("i"), ridge).otherwise(0.0)).alias("row"))


def pooled_cov(emb: DataFrame, means: DataFrame, label: str = "label", vec: str = "embedding",
               ridge: float = RIDGE) -> DataFrame:
    """Within-class covariance / N plus ridge * I, as (i, j, cov) cells."""
    return pooled_cov_rows(emb, means, label, vec, ridge).select("i", F.posexplode("row").alias("j", "cov"))


class OodModel:
    """Fitted detector: class means (a table), inverse Cholesky factor W (Sigma^-1 = W^T W, d x d), threshold."""

    def __init__(self, means: DataFrame, w: np.ndarray, threshold: float | None = None, median: float | None = None,
                 label: str = "label"):
        self.means = means
        self.w = w
        self.threshold = threshold
        self.median = median
        self.label = label

    @property
    def labels(self) -> list:
        """The class labels in order, for models whose classes fit on the driver; nothing here asks for them."""
        return [r[0] for r in self.means.select(self.label).orderBy(self.label).collect()]

    def save(self, spark: SparkSession, path: str) -> None:
        """Means, factor rows and threshold as Parquet tables."""
        self.means.select(F.col(self.label).alias("label"), "mean").write.mode("overwrite").parquet(f"{path}/means")
        spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(self.w)],
                              "i int, row array<double>").write.mode("overwrite").parquet(f"{path}/factor")
        spark.createDataFrame([(self.threshold, self.median)], "threshold double, median double") \
            .write.mode("overwrite").parquet(f"{path}/threshold")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "OodModel":
        f = spark.read.parquet(f"{path}/factor").orderBy("i").collect()  # d rows
        t = spark.read.parquet(f"{path}/threshold").first()
        return cls(spark.read.parquet(f"{path}/means"), np.array([r["row"] for r in f]), t["threshold"], t["median"])


def factor_of(cov_rows: DataFrame) -> np.ndarray:
    """W with Sigma^-1 = W^T W from the (i, row) covariance: d x d numbers, bounded by the dimension, on the driver."""
    cov = np.array([r["row"] for r in cov_rows.orderBy("i").collect()])
    return np.linalg.solve(np.linalg.cholesky(cov), np.eye(len(cov)))


def fit_ood(train: DataFrame, label: str = "label", vec: str = "embedding", ridge: float = RIDGE) -> OodModel:
    """M6 (fit): means and pooled covariance on Spark; the d x d inverse on the driver.

    The means are written once, read by the covariance pass, and stay a table, however many classes there are.
    """
    means = materialize(class_means(train, label, vec), "class-means")
    return OodModel(means, factor_of(pooled_cov_rows(train, means, label, vec, ridge)), label=label)


# ---------------------------------------------------------------- rows against class means
def _array(col: pd.Series) -> np.ndarray:
    return np.stack(col.to_numpy()).astype(np.float64)


def _squares(z: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Squared Euclidean distances, rows x classes, by one matrix product."""
    return np.maximum((z * z).sum(axis=1)[:, None] + (m * m).sum(axis=1) - 2 * (z @ m.T), 0.0)


def _nearest(z: np.ndarray, m: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, class, distance) of at least every row's k nearest classes; their distances are taken from the differences,
    so that equal means are equally far."""
    far = _squares(z, m)
    k = min(k, m.shape[0])
    kth = np.partition(far, k - 1, axis=1)[:, k - 1]
    slack = 1e-9 * (1 + (z * z).sum(axis=1) + kth)
    row, cls = np.nonzero(far <= (kth + slack)[:, None])
    diff = z[row] - m[cls]
    return row, cls, (diff * diff).sum(axis=1)


def against_means(rows: DataFrame, means: DataFrame, label: str, partial, schema: str) -> tuple[DataFrame, list[str]]:
    """``partial(z, m, labels)``, a list of columns, for all *rows* (with an array column ``_z``) against all *means*.

    Returns the partial results beside the rows' other columns, and the columns that tell a row apart if its result lies in several rows
    (none: in one).  Means of at most ``HELD_BYTES`` go to the tasks as one block, and no row moves.  More are
    dealt over tiles of about ``TILE`` classes and meet the rows in blocks of ``BLOCK``: a task holds one tile and one block, and the
    means are neither collected nor broadcast.
    """
    kept = [f for f in rows.schema if f.name != "_z"]
    names = [f.name for f in kept]
    fields = [c.split()[0] for c in schema.split(", ")]
    typed = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in kept)
    means = means.where(F.col("mean").isNotNull()).select(F.col(label).alias("_label"), "mean")
    size = means.agg(F.count("*").alias("n"), F.max(F.size("mean")).alias("d")).first()
    if (size.n or 0) * (size.d or 0) * 8 <= HELD_BYTES:
        held = means.orderBy("_label").collect()  # bounded by HELD_BYTES
        m, labels = np.array([r["mean"] for r in held], dtype=np.float64), np.array([r["_label"] for r in held])

        def run(batches):
            for pdf in batches:
                if len(pdf) and len(m):
                    yield pdf[names].assign(**dict(zip(fields, partial(_array(pdf["_z"]), m, labels))))

        return rows.mapInPandas(run, typed + schema), []
    tiles = -(-size.n // TILE)
    numbered = materialize(rows.withColumn("_row", F.monotonically_increasing_id()), "rows")
    blocks = max(1, -(-numbered.count() // BLOCK))
    left = numbered.withColumns({"_block": F.pmod(F.xxhash64("_row"), F.lit(blocks)), "_tile": F.explode(F.sequence(F.lit(0), F.lit(tiles - 1)))})
    right = means.withColumns({"_tile": F.pmod(F.xxhash64("_label"), F.lit(tiles)).cast("int"),
                               "_block": F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint")))})

    def meet(block: pd.DataFrame, tile: pd.DataFrame) -> pd.DataFrame:
        if not len(block) or not len(tile):
            return block.iloc[:0][[*names, "_row"]].assign(**{f: [] for f in fields})
        tile = tile.sort_values("_label")
        return block[[*names, "_row"]].assign(**dict(zip(fields, partial(_array(block["_z"]), _array(tile["mean"]), tile["_label"].to_numpy()))))

    out = left.groupBy("_block", "_tile").cogroup(right.groupBy("_block", "_tile")).applyInPandas(meet, f"{typed}_row bigint, {schema}")
    return out, [*names, "_row"]


def whitened(w: np.ndarray):
    """Column function: W x of an embedding column."""
    @F.pandas_udf("array<double>")
    def turn(col: pd.Series) -> pd.Series:
        return pd.Series(list(_array(col) @ w.T))

    return turn


def _white(df: DataFrame, model: OodModel, vec: str) -> tuple[DataFrame, DataFrame]:
    turn = whitened(model.w)
    return df.withColumn("_z", turn(F.col(vec))), model.means.select(model.label, turn(F.col("mean")).alias("mean"))


def score_ood(df: DataFrame, model: OodModel, vec: str = "embedding", out: str = "ood_score") -> DataFrame:
    """M6 (score): min over classes of the squared Mahalanobis distance."""
    def least(z, m, labels):
        row, _, far = _nearest(z, m, 1)
        best = np.full(len(z), np.inf)
        np.minimum.at(best, row, far)
        return [best]

    rows, means = _white(df, model, vec)
    scored, key = against_means(rows, means, model.label, least, f"{out} double")
    return scored if not key else scored.groupBy(*key).agg(F.min(out).alias(out)).drop("_row")


def class_distances(df: DataFrame, model: OodModel, key: str, vec: str = "embedding") -> DataFrame:
    """Squared Mahalanobis distance of every row to every class mean (rows x classes, as asked for)."""
    kind = dict(model.means.dtypes)[model.label]

    def every(z, m, labels):
        far = _squares(z, m)
        return [[labels.tolist()] * len(z), list(far)]

    rows, means = _white(df.select(key, vec), model, vec)
    far, _ = against_means(rows.select(key, "_z"), means, model.label, every, f"_class array<{kind}>, _far array<double>")
    return far.select(key, F.explode(F.arrays_zip("_class", "_far")).alias("_c")) \
        .select(key, F.col("_c._class").alias("class"), F.col("_c._far").alias("distance"))


def ood_threshold(valid_scores: DataFrame, score: str = "ood_score", pct: float = THRESHOLD_PCT) -> DataFrame:
    """Exact percentile of validation scores (the threshold) and their median."""
    return exact_quantiles(valid_scores, score, [pct / 100.0, 0.5], names=["threshold", "median"])


def flag_ood(scored: DataFrame, threshold: float, strictness: str = "Balanced", score: str = "ood_score",
             confidence: str | None = None) -> DataFrame:
    """OOD when score > threshold x strictness; low confidence when top prob < 0.5."""
    mult = STRICTNESS[strictness]
    out = scored.withColumn("is_ood", F.coalesce(F.col(score) > F.lit(threshold * mult), F.lit(False)))
    if confidence:
        out = out.withColumn("low_confidence", F.col(confidence) < 0.5)
    return out


def flag_all(scored: DataFrame, threshold: DataFrame, score: str = "ood_score") -> DataFrame:
    """P27 at every strictness: rows x the one-row *threshold* table x the strictness levels."""
    levels = F.explode(F.array(*[F.struct(F.lit(k).alias("strictness"), F.lit(v).alias("_mult"))
                                 for k, v in STRICTNESS.items()]))
    return (scored.crossJoin(F.broadcast(threshold.select("threshold")))  # one row
            .withColumn("_level", levels).select("*", "_level.*")
            .withColumn("is_ood", F.coalesce(F.col(score) > F.col("threshold") * F.col("_mult"), F.lit(False)))
            .drop("threshold", "_level", "_mult"))


def topk_classes(emb: DataFrame, means: DataFrame, key: str, k: int = 3, vec: str = "embedding",
                 label: str = "label", low_confidence: float = 0.5) -> DataFrame:
    """Softmax over classes of -squared Euclidean distance, then the top k per row.

    A tile of classes gives a row its largest score, its sum of exponentials relative to that, and its k best classes; such parts merge, so
    the classes may be dealt over any number of tiles.  ``low_confidence`` tells that the best
    probability is below *low_confidence*.  Of equal scores the smaller class comes first.
    """
    kind = dict(means.dtypes)[label]

    def part(z, m, labels):
        row, cls, far = _nearest(z, m, k)
        order = np.lexsort((labels[cls], far, row))
        row, cls, far = row[order], cls[order], far[order]
        nth = np.arange(len(row)) - np.searchsorted(row, row)
        row, cls, far = (x[nth < k] for x in (row, cls, far))
        cut = np.searchsorted(row, np.arange(len(z) + 1))
        least = far[cut[:-1]]
        total = np.exp(least[:, None] - _squares(z, m)).sum(axis=1)
        names = labels[cls]
        return [least, total, [far[a:b] for a, b in zip(cut, cut[1:])], [names[a:b] for a, b in zip(cut, cut[1:])]]

    rows = emb.select(key, F.col(vec).cast("array<double>").alias("_z"))
    out, own = against_means(rows, means, label, part, f"_least double, _sum double, _far array<double>, _class array<{kind}>")
    cells = F.struct("_least", "_sum", "_far", "_class")
    out = out.select(key, F.array(cells).alias("_p")) if not own else out.groupBy(*own).agg(F.collect_list(cells).alias("_p"))
    least = F.array_min("_p._least")
    total = F.aggregate("_p", F.lit(0.0), lambda acc, p: acc + p["_sum"] * F.exp(F.col("_m") - p["_least"]))
    best = F.slice(F.array_sort(F.arrays_zip(F.flatten("_p._far").alias("far"), F.flatten("_p._class").alias("class"))), 1, k)
    out = out.withColumn("_m", least).withColumn("_total", total)
    prob = F.exp(F.col("_m") - F.col("_top.far")) / F.col("_total")
    return (out.select(key, "_m", "_total", F.posexplode(best).alias("_i", "_top"))
            .select(key, (F.col("_i") + 1).alias("rank"), F.col("_top.class").alias("class"), prob.alias("prob"),
                    (1 / F.col("_total") < low_confidence).alias("low_confidence")))
