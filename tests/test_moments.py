"""Many classes in tiles, and class moments that merge and subtract."""

import numpy as np
import pandas as pd
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from agroframe.operators import moments as MO
from agroframe.operators import ood as O
from agroframe.plans import embedding as PE


def table(spark, n, classes, d=6, seed=0):
    rng = np.random.default_rng(seed)
    label = rng.integers(0, classes, n)
    x = rng.normal(size=(n, d)) + label[:, None] % 7
    return spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(n), "label": label, "embedding": list(x)}))


def rows(df):
    return sorted(map(tuple, df.collect()))


def near(a, b):
    a, b = rows(a), rows(b)
    assert len(a) == len(b) and [[v for v in r if not isinstance(v, float)] for r in a] == [[v for v in r if not isinstance(v, float)] for r in b]
    np.testing.assert_allclose([[v for v in r if isinstance(v, float)] for r in a], [[v for v in r if isinstance(v, float)] for r in b], rtol=1e-9, atol=1e-9)


def test_tiles_give_what_one_block_gives(spark, monkeypatch):
    emb = table(spark, 700, 23)
    model = O.fit_ood(emb)
    whole = [O.topk_classes(emb, model.means, "vec_id", 4), O.score_ood(emb, model).select("vec_id", "ood_score"),
             O.class_distances(emb, model, "vec_id")]
    whole = [spark.createDataFrame(d.collect(), d.schema) for d in whole]
    for name, value in (("HELD_BYTES", 0), ("TILE", 4), ("BLOCK", 100)):
        monkeypatch.setattr(O, name, value)
    tiled = [O.topk_classes(emb, model.means, "vec_id", 4), O.score_ood(emb, model).select("vec_id", "ood_score"),
             O.class_distances(emb, model, "vec_id")]
    for a, b in zip(whole, tiled):
        near(a, b)
    # brute force: softmax over all classes, minimum distance
    m = {r.label: np.array(r["mean"]) for r in model.means.collect()}
    r = emb.collect()[17]
    far = {c: ((np.array(r.embedding) - v) ** 2).sum() for c, v in m.items()}
    want = sorted(far, key=lambda c: (far[c], c))[:4]
    total = sum(np.exp(-v) for v in far.values())
    got = [t for t in rows(tiled[0]) if t[0] == r.vec_id]
    assert [t[2] for t in got] == want and np.allclose([t[3] for t in got], [np.exp(-far[c]) / total for c in want])


def test_fifty_thousand_classes(spark, monkeypatch):
    monkeypatch.setattr(O, "HELD_BYTES", 1 << 20)
    rng = np.random.default_rng(3)
    m = rng.normal(size=(50_000, 8)) * 3
    m[40_000] = m[7]  # equal means: the smaller class first
    means = spark.createDataFrame(pd.DataFrame({"label": np.arange(50_000), "mean": list(m)})).repartition(8)
    x = np.concatenate([m[[7, 123, 49_999]], rng.normal(size=(40, 8)) * 3])
    emb = spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(43), "embedding": list(x)}))
    top = O.topk_classes(emb, means, "vec_id", 2)
    assert "BroadcastExchange" not in top._jdf.queryExecution().executedPlan().toString()
    got = {}
    for r in top.collect():
        got.setdefault(r.vec_id, {})[r["rank"]] = (r["class"], r.prob)
    assert [got[0][1][0], got[0][2][0], got[1][1][0], got[2][1][0]] == [7, 40_000, 123, 49_999]
    for i in (0, 5, 42):
        far = ((m - x[i]) ** 2).sum(axis=1)
        order = np.lexsort((np.arange(50_000), far))[:2]
        e = np.exp(far.min() - far)
        assert [got[i][1][0], got[i][2][0]] == list(order) and abs(got[i][1][1] - 1 / e.sum()) < 1e-9
    model = O.OodModel(means, np.eye(8))
    score = {r.vec_id: r.ood_score for r in O.score_ood(emb, model).collect()}
    assert all(abs(score[i] - ((m - x[i]) ** 2).sum(axis=1).min()) < 1e-9 for i in range(43))


def test_moments_merge_and_subtract(spark, tmpdir_path):
    emb = table(spark, 900, 12, seed=5)
    whole = MO.moments(emb)
    parts = [MO.moments(emb.where(F.col("vec_id") % 4 == i)) for i in range(4)]
    merged = parts[0].plus(parts[1]).plus(parts[2]).plus(parts[3])
    near(whole.means().select("label", F.posexplode("mean")), merged.means().select("label", F.posexplode("mean")))
    near(whole.pooled_cov_rows().select("i", F.posexplode("row")), merged.pooled_cov_rows().select("i", F.posexplode("row")))
    # the same as one direct pass
    direct = O.pooled_cov_rows(emb, O.class_means(emb))
    near(direct.select("i", F.posexplode("row")), merged.pooled_cov_rows().select("i", F.posexplode("row")))
    # withdrawn again, saved and loaded: the state of the rest; a class that is gone disappears
    rest = merged.minus(parts[2])
    rest.save(f"{tmpdir_path}/m")
    rest = MO.Moments.load(spark, f"{tmpdir_path}/m")
    near(MO.moments(emb.where(F.col("vec_id") % 4 != 2)).pooled_cov_rows().select("i", F.posexplode("row")),
         rest.pooled_cov_rows().select("i", F.posexplode("row")))
    alone = MO.moments(emb.where("label = 3"))
    assert whole.minus(alone).means().where("label = 3").count() == 0
    with pytest.raises(ValueError):
        alone.minus(whole)
    a, b = (O.score_ood(emb, m).select("vec_id", "ood_score") for m in (whole.model(), O.fit_ood(emb)))
    near(a, b)


def test_query_state_equals_the_training_rows(spark):
    t = PE.train(spark, SF_SMALL)
    state = PE.merged_moments(spark, SF_SMALL)
    near(MO.moments(t).classes.select("label", "n"), state.classes.select("label", "n"))
