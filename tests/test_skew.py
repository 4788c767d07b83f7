"""Hot keys: one group of copies holds a third of all rows, one class most groups."""

import os

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from agroframe.operators import catalogue as C
from agroframe.operators import splits as SP


def _skewed(spark, n=6000, seed=11):
    rng = np.random.default_rng(seed)
    cls = np.where(rng.random(n) < 0.7, "hot_class", rng.choice(["c1", "c2", "c3"], n)).astype(object)
    src = np.array([f"s{int(x)}" for x in rng.integers(0, 400, n)], dtype=object)
    src[: n // 3] = "copied_photo"          # a third of all rows are copies of one photo
    cls[: n // 3] = "hot_class"
    pdf = pd.DataFrame({"image_id": np.arange(n), "class_name": cls, "source": src})
    return spark.createDataFrame(pdf).repartition(12)


def test_group_split_with_hot_group_and_class(spark):
    df = _skewed(spark)
    out = SP.group_split(df, "class_name", "source", row_order="image_id", frac=0.15, seed=3).cache()
    assert C.leaks(out, ["class_name", "source"]).count() == 0
    hot = out.filter((F.col("class_name") == "hot_class") & (F.col("source") == "copied_photo"))
    sp = [r.split for r in hot.select("split").distinct().collect()]
    assert len(sp) == 1
    assert hot.count() == (2000 if sp[0] == "train" else 1)
    # exact per-class counts of groups per split
    groups = df.select("class_name", "source").distinct().groupBy("class_name").count().collect()
    per = {(r.class_name, r.split): r["count"] for r in
           out.select("class_name", "source", "split").distinct().groupBy("class_name", "split").count().collect()}
    for r in groups:
        n = r["count"]
        k = max(1, int(np.round(0.15 * n))) if n >= 3 else 0
        n_val = min(k, n - 1)
        n_test = min(k, n - 1 - n_val)
        assert per.get((r.class_name, "test"), 0) == n_test
        assert per.get((r.class_name, "valid"), 0) == n_val


def test_stratified_split_exact_on_dominant_label(spark):
    df = _skewed(spark).withColumn("label", (F.col("class_name") == "hot_class").cast("int"))
    out = SP.stratified_split(df, "label", "image_id", 0.2, seed=42)
    counts = {(r.label, r.split): r["count"] for r in out.groupBy("label", "split").count().collect()}
    for lab in (0, 1):
        n = counts.get((lab, "test"), 0) + counts.get((lab, "train"), 0)
        assert counts[(lab, "test")] == int(np.round(0.2 * n))


def test_majority_class_on_a_hot_image(spark):
    rows = [(1, i + 1, f"{5 if i % 3 else 2} 0 0 0 0") for i in range(3000)] + [(2, 1, "1 0 0 0 0")]
    lines = spark.createDataFrame(rows, "image_id long, line_no int, line string").repartition(8)
    m = {r.image_id: (r.class_id, r.mixed) for r in C.majority_class(lines).collect()}
    assert m == {1: (5, True), 2: (1, False)}


def test_quantiles_of_a_hot_value(spark):
    """80 % of the rows share a value: it is counted before the sort, so no partition holds its rows."""
    from agroframe.operators import ranking
    rng = np.random.default_rng(3)
    v = np.where(rng.random(40_000) < 0.8, 5.0, rng.normal(5, 2, 40_000))
    df = spark.createDataFrame(pd.DataFrame({"v": v})).repartition(16)
    seen = []
    keep = ranking.materialize
    try:
        ranking.materialize = lambda d, name="stage": seen.append(keep(d, name)) or seen[-1]
        got = ranking.exact_quantiles(df, "v", [0.1, 0.5, 0.975]).first()
    finally:
        ranking.materialize = keep
    np.testing.assert_allclose([got.q0, got.q1, got.q2], np.percentile(v, [10, 50, 97.5]), rtol=1e-12)
    sizes = [r["count"] for r in seen[0].groupBy("_rk_pid").count().collect()]
    assert seen[0].agg(F.max("_c")).first()[0] > 30_000 and max(sizes) < 3 * np.mean(sizes)


def test_drop_materialized(spark, monkeypatch):
    import pytest

    from agroframe import session
    monkeypatch.setattr(session, "_WRITTEN", {})
    t = session.materialize(spark.range(5).toDF("id"))
    assert t.count() == 5 and session.drop_materialized(spark) == 1 and session.drop_materialized(spark) == 0
    with pytest.raises(Exception):
        spark.read.parquet(t.inputFiles()[0]).count()


def test_order_lines_are_dealt_by_rows_not_by_compressed_bytes(spark, tmpdir_path, monkeypatch):
    """Thousands of lines are few bytes: adaptive execution would give them to one task."""
    from agroframe.plans import catalogue as PC
    from agroframe.sources import fixtures as FX

    spark.range(2000).selectExpr("id AS o_orderkey", "id % 90 AS o_custkey").write.parquet(f"{tmpdir_path}/orders.parquet")
    (spark.range(6000).selectExpr("id % 2001 AS l_orderkey", "cast(id AS int) AS l_linenumber", "id AS l_partkey", "id % 70 AS l_suppkey",
                                  "1.0D AS l_extendedprice", "1.0D AS l_quantity", "cast(NULL AS date) AS l_shipdate")
     .unionByName(spark.range(1).selectExpr("cast(NULL AS long) AS l_orderkey", "1 AS l_linenumber", "id AS l_partkey", "id AS l_suppkey",
                                            "1.0D AS l_extendedprice", "1.0D AS l_quantity", "cast(NULL AS date) AS l_shipdate"))
     .write.parquet(f"{tmpdir_path}/lineitem.parquet"))
    plain = FX.fixture(spark, tmpdir_path, "fx_box_lines").collect()
    few = PC.majority_class(spark, tmpdir_path).collect()
    monkeypatch.setattr(FX, "TASK_ROWS", 100, raising=False)
    lines, most = FX.fixture(spark, tmpdir_path, "fx_box_lines"), PC.majority_class(spark, tmpdir_path)
    assert sorted(lines.collect()) == sorted(plain) and sorted(most.collect()) == sorted(few)
    for df in (lines, most):
        sizes = [len(part) for part in df.rdd.glom().collect()]
        assert len(sizes) >= 60 and max(sizes) < 400


def test_label_lines_are_sorted_by_many_tasks(spark, tmpdir_path, monkeypatch):
    """Short lines compress to next to nothing, and still no task sorts them all."""
    from agroframe.operators import ranking as RK
    from agroframe.sources import files as FS

    os.makedirs(f"{tmpdir_path}/train/labels")
    for name, n in (("a", 9000), ("b", 3), ("c", 1000)):
        with open(f"{tmpdir_path}/train/labels/{name}.txt", "w") as f:
            f.writelines(f"{i % 7} 0.5 0.5\n" for i in range(n))
    monkeypatch.setattr(FS, "SORT_BYTES", 2000, raising=False)
    sorts, keep = [], RK.materialize
    monkeypatch.setattr(RK, "materialize", lambda df, name="stage": sorts.append(keep(df, name)) or sorts[-1])
    got = sorted((r.stem, r.line_no, r.line) for r in FS.label_lines(spark, f"{tmpdir_path}/*/labels/*.txt").collect())
    assert got == sorted((name, i + 1, f"{i % 7} 0.5 0.5") for name, n in (("a", 9000), ("b", 3), ("c", 1000)) for i in range(n))
    most = sorts[0].groupBy("_rk_pid").count().agg({"count": "max"}).first()[0]
    assert most < 1000


def test_written_label_files_are_dealt_by_rows(spark, tmpdir_path, monkeypatch):
    from agroframe.plans import catalogue as PC
    from agroframe.sources import fixtures as FX

    (spark.range(60).selectExpr("id AS o_orderkey", "id % 9 AS o_custkey").unionByName(spark.range(1).selectExpr("id AS o_orderkey", "id AS o_custkey"))
     .write.parquet(f"{tmpdir_path}/orders.parquet"))
    (spark.range(500).selectExpr("id % 61 AS l_orderkey", "cast(id AS int) AS l_linenumber", "id AS l_partkey", "id % 70 AS l_suppkey",
                                 "1.0D AS l_extendedprice", "1.0D AS l_quantity", "cast(NULL AS date) AS l_shipdate")
     .write.parquet(f"{tmpdir_path}/lineitem.parquet"))
    rows = lambda: sorted(map(tuple, PC.label_file_lines(spark, tmpdir_path).collect()))
    want = rows()
    monkeypatch.setattr(FX, "TASK_ROWS", 10, raising=False)
    assert rows() == want and len(want) > 500
