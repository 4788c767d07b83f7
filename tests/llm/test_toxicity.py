import zlib

import numpy as np
from conftest import SF_CHECK

from agroframe.llm import toxicity as T
from agroframe.llm.queries import QUERIES


def test_learns_what_only_pairs_tell():
    """Either term alone is toxic, both together are not: no sum of two weights can say that."""
    rng = np.random.default_rng(0)
    docs, y = [], []
    for _ in range(4000):
        a, b = rng.random(2) < (0.5, 0.2)
        noise = rng.integers(10, 400, 20)
        docs.append(np.unique(np.r_[noise, [1] * int(a), [2] * int(b)].astype(np.int64)))
        y.append(float(a != b))
    y = np.array(y)
    model = T.train(docs, y, np.ones(len(y)))
    rows = lambda d: np.flatnonzero(np.isin(model.ids, d))
    got = np.array([T.predict(model, rows(d)) for d in docs])
    assert ((got > 0.5) == (y > 0)).mean() > 0.98
    i, j = rows(np.array([1, 2]))
    assert model.v[i] @ model.v[j] < -1


def test_predict_is_the_sum_over_pairs():
    rng = np.random.default_rng(1)
    m = T.Model(0.3, np.arange(6), rng.normal(size=6).astype(np.float32), rng.normal(size=(6, 8)).astype(np.float32))
    rows = np.array([0, 2, 5])
    z = 0.3 + m.w[rows].sum() + sum(m.v[a] @ m.v[b] for a in rows for b in rows if a < b)
    assert abs(T.predict(m, rows) - 1 / (1 + np.exp(-z))) < 1e-5
    assert abs(T.predict(m, rows[:0]) - 1 / (1 + np.exp(-0.3))) < 1e-9


def test_held_out_quality(spark):
    got = {r.doc_id: r for r in QUERIES["op8_toxicity"](spark, "/root/testdata/sf0.1").collect()}
    assert len(got) == 10000
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2) for d, r in got.items())
    labels = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "toxic").collect()]
    held = [(y, got[d].predicted) for d, y in labels if d in got and got[d].held_out]
    hit = sum(y and p for y, p in held)
    assert hit >= 0.85 * sum(y for y, _ in held) and hit >= 0.95 * sum(p for _, p in held)


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (None, "idiot", "x"), (3, "idiot " * 9000, "x"), (3, "fine", "x"),
                                  (4, "fine day", "x"), (4, "fine day", "x")], "doc_id long, text string, toxic string")
    labels = spark.createDataFrame([(3, 1, 1), (3, 1, 1), (4, 1, 0), (4, 1, None), (None, 1, 1), (99, 0, 1)],
                                   "doc_id long, quality int, toxic int")
    model = T.fit(T.sample(docs, labels))
    rows = T.score(docs, model).collect()
    assert len(rows) == 7 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert T.score(docs.limit(0), T.fit(T.sample(docs, labels.limit(0)))).count() == 0
    first = T.fit(T.sample(docs, labels))
    assert first.bias == model.bias and (first.w == model.w).all()


def test_only_true_copies_count_once():
    rng = np.random.default_rng(2)
    base = np.unique(rng.integers(10, 10_000, 50))
    near = np.setdiff1d(base, base[-3:])
    other = np.union1d(base[:2], rng.integers(20_000, 30_000, 40))  # shares the two smallest hashes only
    docs = [base, near, other, base, np.empty(0, np.int64), np.empty(0, np.int64)]
    assert T.distinct(docs, np.array([1, 1, 1, 0, 0, 0])) == [0, 2, 3, 4]


def test_rows_of_one_id_count_once(spark, monkeypatch):
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 4 != 2]
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, toxic int")
    once = [(i, "bad word" if i % 2 else "fine day") for i in ids]
    model = [T.fit(T.sample(spark.createDataFrame(rows, "doc_id long, text string"), labels)) for rows in (once, once + [(ids[0], once[0][1])] * 500)]
    assert model[0].bias == model[1].bias and (model[0].w == model[1].w).all()
