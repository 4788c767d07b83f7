"""Registered queries of the embedding / out-of-distribution track."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agroframe.operators import moments as MO
from agroframe.operators import ood as O
from agroframe.plans.registry import finish, fx, query
from agroframe.session import materialize

FX = ("fx_emb",)
LONG_CTES = [
    "el AS (SELECT vec_id, label, split, unnest(embedding) AS v, "
    "unnest(generate_series(0, len(embedding) - 1)) AS dim FROM fx_emb)",
    "ml AS (SELECT label, dim, avg(v) AS m FROM el WHERE split = 'train' GROUP BY label, dim)",
    "cl AS (SELECT el.vec_id, el.dim, el.v - ml.m AS c FROM el JOIN ml ON el.label = ml.label "
    "AND el.dim = ml.dim WHERE el.split = 'train')",
]

# the inverse of the pooled covariance by Gauss-Jordan elimination, a recursion step per dimension
DIST_CTES = LONG_CTES + [
    "covc AS (SELECT a.dim AS i, b.dim AS j, sum(a.c * b.c) / (SELECT count(*) FROM fx_emb WHERE split = 'train') "
    "+ CASE WHEN a.dim = b.dim THEN 0.001 ELSE 0 END AS v FROM cl a JOIN cl b ON a.vec_id = b.vec_id GROUP BY a.dim, b.dim)",
    "aug AS (SELECT i, list_concat(list(v ORDER BY j), list(CASE WHEN i = j THEN 1.0::DOUBLE ELSE 0.0 END ORDER BY j)) AS r, "
    "count(*) AS n FROM covc GROUP BY i)",
    "inv AS (SELECT 0::BIGINT AS k, i, r, n FROM aug UNION ALL SELECT k + 1, i, CASE WHEN i = k "
    "THEN list_transform(r, lambda x: x / r[k + 1]) "
    "ELSE list_transform(list_zip(r, p), lambda z: z[1] - z[2] * r[k + 1] / p[k + 1]) END, n "
    "FROM (SELECT *, any_value(CASE WHEN i = k THEN r END) OVER (PARTITION BY k) AS p FROM inv) s WHERE k < n)",
    "invm AS (SELECT i, r[n + 1:2 * n] AS r FROM inv WHERE k = n)",
    "mu AS (SELECT label AS class, list(m ORDER BY dim) AS mu FROM ml GROUP BY label)",
    "dv AS (SELECT e.vec_id, e.label, e.split, mu.class, list_transform(list_zip(e.embedding, mu.mu), "
    "lambda z: z[1] - z[2]) AS d FROM fx_emb e CROSS JOIN mu)",
    "dist AS (SELECT vec_id, label, split, class, sum(d[i + 1] * list_inner_product(r, d)) AS distance "
    "FROM dv CROSS JOIN invm GROUP BY vec_id, label, split, class)",
    "sc AS (SELECT vec_id, label, split, min(distance) AS ood_score FROM dist GROUP BY vec_id, label, split)",
    "th AS (SELECT count(*) AS n, quantile_cont(ood_score, 0.975) AS threshold, quantile_cont(ood_score, 0.5) AS median "
    "FROM sc WHERE split = 'valid')",
]


def emb(spark, sf) -> DataFrame:
    return fx(spark, sf, "fx_emb")


def train(spark, sf) -> DataFrame:
    return emb(spark, sf).filter(F.col("split") == "train")


def valid(spark, sf) -> DataFrame:
    return emb(spark, sf).filter(F.col("split") == "valid")


def fitted(spark, sf) -> O.OodModel:
    return O.fit_ood(train(spark, sf))


@query("class_means", "SELECT label, cast(dim AS int) AS dim, round(round(m, 9), 6) AS mean FROM ml", FX, LONG_CTES)
def class_means(spark, sf):
    m = O.class_means(train(spark, sf))
    return finish(m.select("label", F.posexplode("mean").alias("dim", "mean")))


@query("centered_embeddings", "SELECT vec_id, round(round(sum(c * c), 9), 6) AS sq_norm FROM cl GROUP BY vec_id",
       FX, LONG_CTES)
def centered_embeddings(spark, sf):
    t = train(spark, sf)
    c = O.centered(t, O.class_means(t))
    return finish(c.select("vec_id", F.aggregate("centered", F.lit(0.0), lambda acc, v: acc + v * v)
                           .alias("sq_norm")))


COV_SQL = ("SELECT a.dim AS i, b.dim AS j, round(round(sum(a.c * b.c) / "
           "(SELECT count(*) FROM fx_emb WHERE split = 'train') + CASE WHEN a.dim = b.dim THEN 0.001 ELSE 0 END, 9), 6) "
           "AS cov FROM cl a JOIN cl b ON a.vec_id = b.vec_id GROUP BY a.dim, b.dim")


@query("pooled_cov", COV_SQL, FX, LONG_CTES)
def pooled_cov(spark, sf):
    t = train(spark, sf)
    return finish(O.pooled_cov(t, O.class_means(t)).select(F.col("i").cast("bigint"), F.col("j").cast("bigint"),
                                                           "cov"))


def merged_moments(spark, sf):
    """The training rows' moments as a stream of changes leaves them: the validation rows came in first, then the
    training rows in three parts, then the validation rows were withdrawn."""
    t, v = train(spark, sf), MO.moments(valid(spark, sf))
    state = v
    for part in range(3):
        state = state.plus(MO.moments(t.filter(F.col("vec_id") % 3 == part)))
    return state.minus(v)


@query("pooled_cov_merged", COV_SQL, FX, LONG_CTES)
def pooled_cov_merged(spark, sf):
    """A31 + A32 + S12: the pooled covariance from merged and subtracted moments."""
    rows = merged_moments(spark, sf).pooled_cov_rows().select("i", F.posexplode("row").alias("j", "cov"))
    return finish(rows.select(F.col("i").cast("bigint"), F.col("j").cast("bigint"), "cov"))


@query("topk_classes",
       "SELECT vec_id, rank, class, round(round(prob, 9), 6) AS prob, best < 0.5 AS low_confidence FROM ("
       "SELECT vec_id, class, prob, max(prob) OVER (PARTITION BY vec_id) AS best, "
       "cast(row_number() OVER (PARTITION BY vec_id ORDER BY prob DESC, class) AS int) AS rank FROM ("
       "SELECT vec_id, class, e / sum(e) OVER (PARTITION BY vec_id) AS prob FROM ("
       "SELECT vec_id, class, exp(score - max(score) OVER (PARTITION BY vec_id)) AS e FROM ("
       "SELECT el.vec_id, ml.label AS class, -sum((el.v - ml.m) * (el.v - ml.m)) AS score FROM el JOIN ml "
       "ON el.dim = ml.dim GROUP BY el.vec_id, ml.label) s) q) p) r WHERE rank <= 3", FX, LONG_CTES)
def topk_classes(spark, sf):
    m = O.class_means(train(spark, sf))
    top = O.topk_classes(emb(spark, sf), m, "vec_id", k=3)
    return finish(top.select("vec_id", F.col("rank").cast("int").alias("rank"), "class", "prob", "low_confidence"))


@query("ood_scores", "SELECT vec_id, label, split, round(round(ood_score, 9), 6) AS ood_score FROM sc", FX, DIST_CTES,
       recursive=True)
def ood_scores(spark, sf):
    """M6: minimum squared Mahalanobis distance of every embedding (train and valid)."""
    return finish(O.score_ood(emb(spark, sf), fitted(spark, sf)).select("vec_id", "label", "split", "ood_score"))


@query("ood_threshold", "SELECT n, round(round(threshold, 9), 6) AS threshold, round(round(median, 9), 6) AS median FROM th",
       FX, DIST_CTES, recursive=True)
def ood_threshold(spark, sf):
    """97.5th percentile (threshold) and median of the validation scores."""
    model = fitted(spark, sf)
    return finish(O.ood_threshold(O.score_ood(valid(spark, sf), model)))


@query("class_distances", "SELECT vec_id, class, round(round(distance, 9), 6) AS distance FROM dist WHERE split = 'valid'",
       FX, DIST_CTES, recursive=True)
def class_distances(spark, sf):
    """Distance of every validation embedding to every class mean."""
    return finish(O.class_distances(valid(spark, sf), fitted(spark, sf), "vec_id"))


@query("ood_flags", "SELECT vec_id, s.strictness, ood_score > threshold * s.mult AS is_ood FROM sc CROSS JOIN th CROSS JOIN "
       f"(VALUES {', '.join(f'({k!r}, {v})' for k, v in O.STRICTNESS.items())}) s(strictness, mult) WHERE split = 'valid'",
       FX, DIST_CTES, recursive=True)
def ood_flags(spark, sf):
    """OOD flags of validation rows at every strictness level."""
    scored = materialize(O.score_ood(valid(spark, sf), fitted(spark, sf)).select("vec_id", "ood_score"))
    flags = O.flag_all(scored, O.ood_threshold(scored))
    return flags.select("vec_id", "strictness", "is_ood")
