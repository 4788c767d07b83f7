"""The health classifier's rounds over rows kept as bytes, against Spark's own fit."""

import re

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from agroframe.operators import histogram_boosting as HB
from agroframe.operators import models as MD

NUMBER = r"-?\d+\.?\d*(?:E-?\d+)?"


def vectors(spark, n=1500):
    rng = np.random.default_rng(5)
    x = np.c_[rng.normal(size=n), rng.integers(0, 9, n), rng.random(n) < 0.1, np.full(n, 3.0), np.round(rng.normal(size=n), 1)]
    y = ((x[:, 0] + 0.3 * x[:, 1] > 1) ^ (rng.random(n) < 0.05)).astype(int)
    rows = spark.createDataFrame([(*map(float, r), int(v)) for r, v in zip(x, y)], "a double, b double, c double, d double, e double, label int")
    return VectorAssembler(inputCols=list("abcde"), outputCol="features").transform(rows).select("features", "label")


def text(model):
    return model._java_obj.toDebugString().split("\n", 1)[1]


def same_trees(a, b):
    a, b = text(a), text(b)
    assert re.sub(NUMBER, "#", a) == re.sub(NUMBER, "#", b)
    np.testing.assert_allclose([float(v) for v in re.findall(NUMBER, a)], [float(v) for v in re.findall(NUMBER, b)], atol=1e-9)


@pytest.mark.parametrize("bins", [256, 12])
def test_trees_are_those_of_spark(spark, tmpdir_path, bins):
    rows = vectors(spark).coalesce(1)
    gbt = GBTClassifier(maxIter=9, maxDepth=4, stepSize=0.1, maxBins=bins, seed=42)
    ours, theirs = HB.fit_trees(gbt, rows), gbt.fit(rows)
    same_trees(ours, theirs)
    np.testing.assert_allclose(ours.featureImportances.toArray(), theirs.featureImportances.toArray(), atol=1e-9)
    assert ours.treeWeights == theirs.treeWeights and ours.numFeatures == 5 and ours.getMaxBins() == bins
    score = lambda m: [r.probability[1] for r in m.transform(rows).select("probability").collect()]
    np.testing.assert_allclose(score(ours), score(theirs), atol=1e-12)
    for i, (x, z) in enumerate(zip(nodes(spark, ours, f"{tmpdir_path}/ours"), nodes(spark, theirs, f"{tmpdir_path}/theirs"), strict=True)):
        np.testing.assert_allclose(x, z, atol=1e-9, err_msg=str(i))


def nodes(spark, model, path):
    """Nodes as saved: prediction, rows, residuals, squares, gain, children (Spark marks the impurity of some leaves as unknown)."""
    model.write().overwrite().save(path)
    d = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").orderBy("treeID", "id").collect()
    return [(r.prediction, *r.impurityStats, r.rawCount, r.gain, r.leftChild, r.rightChild) for r in d]


def test_blocks_dealt_over_tasks_give_the_same_model(spark, monkeypatch):
    rows = vectors(spark)
    gbt = GBTClassifier(maxIter=7, maxDepth=3, seed=42, maxBins=256)
    whole = HB.fit_trees(gbt, rows)
    for name, v in (("BLOCK", 40), ("PARTITION_ROWS", 60), ("LINEAGE", 3), ("COLLECTED", 4)):
        monkeypatch.setattr(HB, name, v)
    dealt = HB.fit_trees(gbt, rows.repartition(5))
    score = lambda m: [r.probability[1] for r in m.transform(rows).select("probability").collect()]
    np.testing.assert_allclose(score(dealt), score(whole), atol=1e-12)


def test_one_class_and_no_split(spark):
    gbt = GBTClassifier(maxIter=3, maxDepth=2, seed=42)
    flat = VectorAssembler(inputCols=["k"], outputCol="features").transform(spark.range(40).selectExpr("1D AS k", "cast(id % 4 = 0 AS int) AS label"))
    same_trees(HB.fit_trees(gbt, flat), gbt.fit(flat))
    rows = vectors(spark, 60).withColumn("label", F.lit(1))
    ours, theirs = ([r.probability[1] for r in m.transform(rows).select("probability").collect()] for m in (HB.fit_trees(gbt, rows), gbt.fit(rows)))
    np.testing.assert_allclose(ours, theirs, atol=1e-12)


def test_bad_labels_and_no_rows_are_refused(spark):
    rows, gbt = vectors(spark, 30), GBTClassifier(maxIter=2)
    for label in (F.lit(2), F.lit(None).cast("int")):
        with pytest.raises(Exception, match="label"):
            HB.fit_trees(gbt, rows.withColumn("label", F.when(F.col("features").isNotNull(), label)))
    with pytest.raises(ValueError, match="no training rows"):
        HB.fit_trees(gbt, rows.where("false"))


def test_health_fit_keeps_rows_as_bytes(spark, monkeypatch):
    """The health pipeline's trees no longer go through Spark's fit, which keeps a few objects a row; other settings still do."""
    monkeypatch.setattr(GBTClassifier, "fit", lambda *a, **k: pytest.fail("Spark's fit"))
    rows = spark.range(300).selectExpr("cast(if(id % 11 = 0, null, id % 37) AS double) AS t", "if(id % 2 = 0, 'S', 'F') AS growth_stage",
                                       "cast(id % 37 > 18 AS int) AS health_label")
    model = MD.fit_compact(MD.health_pipeline(["t"], max_iter=3, depth=2), rows, "health_label")
    assert model.transform(rows).where("t IS NOT NULL AND prediction <> health_label").count() == 0
    assert not HB.covers(GBTClassifier(subsamplingRate=0.5)) and not HB.covers(GBTClassifier(maxBins=300)) and HB.covers(GBTClassifier())
