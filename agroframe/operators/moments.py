"""A31, A32, S12 kept up to date: class moments that merge and subtract.

The state of a set of labelled embeddings is two tables: ``classes`` (label, n, sum)
and ``gram`` (i, row), the sum of the outer products of all vectors, one row per dimension.  States of disjoint sets
add, a subset's state subtracts, and means, pooled covariance and detector
follow from a state alone: new or withdrawn images change the model without a scan of the others.

Sums are plain doubles: a merge equals one fit up to rounding.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agroframe.operators.ood import RIDGE, OodModel, factor_of
from agroframe.session import materialize


def _sum(col: str):
    return vector_to_array(Summarizer.sum(array_to_vector(col)))


def _gram(rows: DataFrame, vec: str, weight: str | None = None) -> DataFrame:
    """(i, row): sum of (weight x) outer products; a d x d partial per task, sent as d vectors and added by dimension."""
    def partial(batches):
        acc = None
        for pdf in batches:
            if len(pdf):
                x = np.stack(pdf["_x"].to_numpy()).astype(np.float64)
                part = x.T @ (x if weight is None else x * pdf["_w"].to_numpy()[:, None])
                acc = part if acc is None else acc + part
        if acc is not None:
            yield pd.DataFrame({"i": np.arange(len(acc), dtype="int32"), "part": list(acc)})

    columns = [F.col(vec).cast("array<double>").alias("_x")] + ([F.col(weight).alias("_w")] if weight else [])
    return rows.select(*columns).mapInPandas(partial, "i int, part array<double>").groupBy("i").agg(_sum("part").alias("row"))


@dataclass
class Moments:
    classes: DataFrame  # label, n, sum
    gram: DataFrame     # i, row

    def plus(self, other: "Moments", sign: int = 1) -> "Moments":
        """The state of both sets (disjoint), or with sign -1 of this set without the other (a part of it); written once.

        Classes of which nothing is left disappear.
        """
        flip = lambda c: F.transform(c, lambda v: v * float(sign))
        classes = self.classes.unionByName(other.classes.select("label", (F.col("n") * sign).alias("n"), flip("sum").alias("sum")))
        classes = classes.groupBy("label").agg(F.sum("n").alias("n"), _sum("sum").alias("sum"))
        gram = self.gram.unionByName(other.gram.select("i", flip("row").alias("row"))).groupBy("i").agg(_sum("row").alias("row"))
        if sign < 0 and classes.where("n < 0").limit(1).count():
            raise ValueError("the subtracted set is no part of this one")
        return Moments(materialize(classes.where("n > 0"), "class-moments"), materialize(gram, "gram"))

    def minus(self, other: "Moments") -> "Moments":
        return self.plus(other, -1)

    def save(self, path: str) -> None:
        """The state as two Parquet tables."""
        self.classes.write.mode("overwrite").parquet(f"{path}/classes")
        self.gram.write.mode("overwrite").parquet(f"{path}/gram")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "Moments":
        return cls(spark.read.parquet(f"{path}/classes"), spark.read.parquet(f"{path}/gram"))

    def means(self) -> DataFrame:
        """(label, mean)."""
        return self.classes.select("label", F.transform("sum", lambda v: v / F.col("n")).alias("mean"))

    def pooled_cov_rows(self, ridge: float = RIDGE) -> DataFrame:
        """(i, row) of the within-class covariance plus ridge * I: (gram - sum of n mean mean') / N."""
        within = self.classes.select(F.col("sum"), (1.0 / F.col("n")).alias("w"))
        between = _gram(within, "sum", "w").withColumnRenamed("row", "between")
        total = self.classes.agg(F.sum("n").alias("total"))  # one row
        cells = self.gram.join(between, "i").crossJoin(F.broadcast(total))
        return cells.select("i", F.transform(F.arrays_zip("row", "between"), lambda c, j: (c["row"] - c["between"]) / F.col("total")
                                             + F.when(j == F.col("i"), ridge).otherwise(0.0)).alias("row"))

    def model(self, ridge: float = RIDGE) -> OodModel:
        """M6 (fit) from the state alone."""
        return OodModel(materialize(self.means(), "class-means"), factor_of(self.pooled_cov_rows(ridge)))


def moments(emb: DataFrame, label: str = "label", vec: str = "embedding") -> Moments:
    """The state of *emb*, written once; rows without label or vector are no part of it."""
    rows = emb.where(F.col(label).isNotNull() & F.col(vec).isNotNull()).select(F.col(label).alias("label"), F.col(vec).cast("array<double>").alias("x"))
    classes = rows.groupBy("label").agg(F.count("*").alias("n"), _sum("x").alias("sum"))
    return Moments(materialize(classes, "class-moments"), materialize(_gram(rows, "x"), "gram"))
