"""Spark ML pipelines for the health classifier and the severity regressors.

The severity trees train with Spark's distributed GBT (each iteration is a
distributed pass over cached, binned features), the health classifier's with the same
rounds over rows kept as bytes (``histogram_boosting``).  Categorical levels are
indexed inside the fitted ``PipelineModel``, so scoring new rows reuses the
exact training columns (unknown levels map to an extra "keep" slot).
Missing features are mean-imputed with an extra missing-indicator column:
Spark trees do not accept NaN.  Split candidates use 256 bins (the usual
histogram resolution of boosted-tree libraries; Spark's default of 32 cannot
place a split on a rule threshold such as potassium = 40).
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import Imputer, OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agroframe.operators import histogram_boosting as HB
from agroframe.operators.panel import BASE_FEATS
from agroframe.operators.sensor import GROWTH_STAGES
from agroframe.session import materialize

# Reference model settings.
HEALTH_GBT = dict(max_iter=200, depth=4, rate=0.1)
FLAGSHIP_GBT = dict(max_iter=400, depth=4, rate=0.04, subsample=0.9, colsample=0.9)
POOLED_GBT = dict(max_iter=500, depth=5, rate=0.04, subsample=0.9, colsample=0.8)

PARTITION_BYTES = 32 << 20  # of training vectors


def _flags(cols) -> str:
    """Missing-indicator columns ``<c>_na`` (the trees' substitute for NaN branches)."""
    return ", ".join(f"cast(isnull({c}) AS double) AS {c}_na" for c in cols)


def health_pipeline(numeric_cols, cat_col: str = "growth_stage", levels=GROWTH_STAGES, label: str = "health_label",
                    max_iter: int = 200, depth: int = 4, rate: float = 0.1, seed: int = 42,
                    max_bins: int = 256) -> Pipeline:
    """M1 + P13: drop-first one-hot of the growth stage and a GBT classifier.

    Every one of *levels* but the alphabetically first gets a 0/1 column;
    missing and unknown values are 0 in all of them.
    """
    kept = sorted(levels)[1:]
    hot = ", ".join(f"coalesce(cast({cat_col} = '{lv}' AS double), 0D) AS {cat_col}_{lv}" for lv in kept)
    prepare = SQLTransformer(statement=f"SELECT *, {_flags(numeric_cols)}, {hot} FROM __THIS__")
    imp = Imputer(inputCols=list(numeric_cols), outputCols=[f"{c}_imp" for c in numeric_cols])
    asm = VectorAssembler(inputCols=[f"{c}_imp" for c in numeric_cols] + [f"{c}_na" for c in numeric_cols]
                          + [f"{cat_col}_{lv}" for lv in kept], outputCol="features")
    gbt = GBTClassifier(labelCol=label, featuresCol="features", maxIter=max_iter, maxDepth=depth,
                        stepSize=rate, seed=seed, maxBins=max_bins)
    return Pipeline(stages=[prepare, imp, asm, gbt])


def severity_pipeline(feats=BASE_FEATS, cats=("crop", "location", "pest"), label: str = "y",
                      max_iter: int = 500, depth: int = 5, rate: float = 0.04, subsample: float = 0.9,
                      colsample: float = 0.8, seed: int = 42, max_bins: int = 256) -> Pipeline:
    """M2 / M3: pooled severity regressor on log1p counts.

    Full one-hot of the series keys (like ``get_dummies``), mean imputation
    plus missing flags for the weather features, GBT with row subsampling
    and a per-node feature fraction.
    """
    feats = list(feats)
    # everything that scoring needs is a stage, so a saved pipeline is complete
    stages = [SQLTransformer(statement=f"SELECT *, {_flags(feats)}, cast(standard_week AS double) AS week_num FROM __THIS__")]
    cat_vecs = []
    for c in cats:
        stages.append(StringIndexer(inputCol=c, outputCol=f"{c}_idx", handleInvalid="keep"))
        # the last slot is the indexer's one for unknown values, which no training row has
        stages.append(OneHotEncoder(inputCols=[f"{c}_idx"], outputCols=[f"{c}_vec"], dropLast=True))
        cat_vecs.append(f"{c}_vec")
    stages.append(Imputer(inputCols=feats, outputCols=[f"{c}_imp" for c in feats]))
    inputs = [f"{c}_imp" for c in feats] + [f"{c}_na" for c in feats] + ["week_num"] + cat_vecs
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features"))
    stages.append(GBTRegressor(labelCol=label, featuresCol="features", maxIter=max_iter, maxDepth=depth,
                               stepSize=rate, subsamplingRate=subsample,
                               featureSubsetStrategy=str(colsample), seed=seed, maxBins=max_bins,
                               checkpointInterval=50))
    return Pipeline(stages=stages)


def fit_compact(pipeline: Pipeline, train: DataFrame, label: str) -> PipelineModel:
    """Fit the preparing stages, write their vectors once into few partitions, and fit the trees on that table.

    A boosting round is several passes over its rows: they read compact cached vectors in
    partitions sized by bytes, not the frame that made them.  The classifier's rounds read
    them as bytes (``histogram_boosting``).
    """
    *prepare, trees = pipeline.getStages()
    prepared = Pipeline(stages=prepare).fit(train)
    ready = materialize(prepared.transform(train).select("features", label), "vectors")
    if HB.covers(trees):
        return PipelineModel([*prepared.stages, HB.fit_trees(trees, ready)])
    width = ready.schema["features"].metadata.get("ml_attr", {}).get("num_attrs", 100)
    size = ready.count() * 8 * width
    rows = ready.coalesce(max(2, -(-size // PARTITION_BYTES))).persist()
    try:
        return PipelineModel([*prepared.stages, trees.fit(rows)])
    finally:
        rows.unpersist()


def fit_severity(train: DataFrame, **params) -> PipelineModel:
    return fit_compact(severity_pipeline(feats=params.pop("feats", BASE_FEATS), **params), train, params.get("label", "y"))


def predict_severity(model: PipelineModel, rows: DataFrame, out: str = "y_log") -> DataFrame:
    pred = model.transform(rows).withColumnRenamed("prediction", out)
    drop = [c for c in pred.columns if c not in rows.columns and c != out]
    return pred.drop(*drop)


def top_features(model: PipelineModel, df: DataFrame, n: int = 10) -> list[tuple[str, float]]:
    """T4: the *n* most important features, named from the assembled vector's metadata.

    Only the schema of ``model.transform(df)`` is inspected (no job runs).
    """
    tree = model.stages[-1]
    meta = model.transform(df).schema["features"].metadata.get("ml_attr", {})
    names = {}
    for group in meta.get("attrs", {}).values():
        for a in group:
            names[a["idx"]] = a["name"]
    imp = tree.featureImportances.toArray()
    ranked = sorted(((names.get(i, f"f{i}"), float(v)) for i, v in enumerate(imp)), key=lambda t: (-t[1], t[0]))
    return ranked[:n]
