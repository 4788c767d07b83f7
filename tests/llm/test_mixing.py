import duckdb
import pytest
from conftest import SF_CHECK
from pyspark.sql import functions as F

from agroframe.llm import mixing as M
from agroframe.llm.queries import ORACLES, QUERIES


def test_marginals_meet_targets(spark):
    cells = spark.createDataFrame([(s, l, t, float(3 + (i * 37) % 101)) for i, (s, l, t) in enumerate(
        (s, l, t) for s in "abc" for l in "xy" for t in "pqr")], "source string, lang string, topic string, tokens double")
    targets = {"source": {"a": 0.2, "b": 0.5, "c": 0.3}, "lang": {"x": 0.9, "y": 0.1}, "topic": {"p": 0.1, "q": 0.6, "r": 0.3}}
    frames = {d: spark.createDataFrame(list(t.items()), f"{d} string, share double") for d, t in targets.items()}
    raked = M.rake(cells, frames)
    for d, t in targets.items():
        got = {r[d]: r.w for r in raked.groupBy(d).agg(F.sum("weight").alias("w")).collect()}
        assert got == pytest.approx(t, abs=1e-8)
    p = M.probabilities(raked)
    assert p.agg(F.max("probability")).first()[0] == 1.0


def test_targets_without_cells_and_cells_without_targets(spark):
    cells = spark.createDataFrame([("a", "x", "p", 5.0), ("b", "x", "p", 5.0)],
                                  "source string, lang string, topic string, tokens double")
    one = lambda d, rows: spark.createDataFrame(rows, f"{d} string, share double")
    raked = M.rake(cells, {"source": one("source", [("a", 0.4), ("zz", 0.6)]), "lang": one("lang", [("x", 1.0)]),
                           "topic": one("topic", [("p", 1.0)])})
    assert {r.source: r.weight for r in raked.collect()} == {"a": 1.0, "b": 0.0}


def test_query_matches_sql_and_sample_follows(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF_CHECK}/documents.parquet'")
    cols = "doc_id, source, lang, topic, n_tokens, sampled, probability"
    want = con.sql(f"SELECT {cols} FROM ({ORACLES['op6_raked_mix']}) ORDER BY doc_id").fetchall()
    got = QUERIES["op6_raked_mix"](spark, SF_CHECK).orderBy("doc_id").collect()
    assert [(r.doc_id, r.source, r.lang, r.topic, r.n_tokens, r.sampled) for r in got] == [w[:6] for w in want]
    assert [r.probability for r in got] == pytest.approx([w[6] for w in want], abs=1.1e-6)
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    kept = M.sample(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [r.doc_id for r in got if r.sampled]


def test_odd_rows(spark):
    df = spark.createDataFrame([(None, None, None, None, "x"), (1, "", "en", "s", "x"), (2, "a b", None, "s", "x"),
                                (2, "a b", None, "s", "x"), (3, "w " * 99999, "en", None, "x")],
                               "doc_id long, text string, lang string, source string, topic string")
    rows = M.mix(df).collect()
    assert len(rows) == 5 and max(r.probability for r in rows) == 1.0
    assert all(0 <= r.probability <= 1 for r in rows) and {r.n_tokens for r in rows} == {0, 2, 99999}
    assert M.mix(df.limit(0)).count() == 0 and M.sample(df.limit(0)).count() == 0
    assert M.sample(df).columns == df.columns


def test_main_path_is_native(spark):
    plan = M.mix(spark.read.parquet(f"{SF_CHECK}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_contradicting_targets_are_an_error(spark):
    cells = spark.createDataFrame([("a", "x", "p", 10.0), ("b", "y", "p", 10.0)], "source string, lang string, topic string, tokens double")
    one = lambda d, rows: spark.createDataFrame(rows, f"{d} string, share double")
    targets = {"source": one("source", [("a", 0.9), ("b", 0.1)]), "lang": one("lang", [("x", 0.1), ("y", 0.9)]), "topic": one("topic", [("p", 1.0)])}
    with pytest.raises(M.Unreachable) as e:
        M.rake(cells, targets, max_sweeps=4)
    assert abs(e.value.residual - 0.8) < 1e-6


def test_plan_of_a_step_does_not_grow_with_dimensions(spark, monkeypatch):
    steps, write = [], M.materialize

    def spy(df, name="stage"):
        if name == "rake":
            steps.append(df._jdf.queryExecution().optimizedPlan().toString())
        return write(df, name)

    monkeypatch.setattr(M, "materialize", spy)
    cells = spark.createDataFrame([(s, l, t, float(3 + len(s + l) * (t == "p"))) for s in ("a", "bb") for l in ("x", "yyy") for t in "pq"],
                                  "source string, lang string, topic string, tokens double")
    even = lambda d, names: spark.createDataFrame([(n, 0.5) for n in names], f"{d} string, share double")
    raked = M.rake(write(cells, "cells"), {"source": even("source", ["a", "bb"]), "lang": even("lang", ["x", "yyy"]), "topic": even("topic", "pq")})
    assert raked.columns == [*cells.columns, "weight"] and raked.count() == 8
    assert len(steps) > 3 and all(p.count("Relation [") <= 2 and p.count("Join") == 1 for p in steps[1:])
