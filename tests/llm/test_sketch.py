import base64
import hashlib

import numpy as np
import pytest
from conftest import SF_CHECK
from pyspark.sql import functions as F

from agroframe.llm import sketch as S
from agroframe.llm.queries import QUERIES


def shingles(text, width=S.SHINGLE):
    w = (text or "").lower().strip(" \t\n\x0b\f\r")
    w = [x for x in __import__("re").split("[\x09-\x0d ]+", w) if x]
    return {tuple(w[i:i + width]) for i in range(max(len(w) - width + 1, 1))} if w else set()


def likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def expected(rows):
    """doc, n_chars, edited text, likeness of the sets to the edited text's and the next one's."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: -r[0])
    for k, (i, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        half = len(t) // 2
        edited = t[:len(t) - half] + after[:half]
        yield i, len(t), edited, likeness(shingles(t), shingles(edited)), likeness(shingles(t), shingles(after))


def check(got, rows, slack):
    got = {r.doc_id: r for r in got}
    assert len(got) == len(rows)
    errors = []
    for i, n, edited, near, near_next in expected(rows):
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (n, hashlib.sha256(edited.encode()).hexdigest())
        errors += [r.near_edited - near, r.near_next - near_next]
        assert max(map(abs, errors[-2:])) < slack
    return errors


def test_query_against_full_sets(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op1_bottom_k"](spark, SF_CHECK).collect()
    errors = check(got, rows, 0.16)
    assert np.mean(np.abs(errors)) < 0.02
    texts = dict(rows)
    by_text = {}
    for r in got:
        by_text.setdefault(texts[r.doc_id], set()).add(r.fingerprint)
    assert all(len(v) == 1 for v in by_text.values())
    for r in got:
        true = len(shingles(texts[r.doc_id]))
        assert abs(r.n_distinct - true) <= (0 if true < S.K else 0.35 * true)


@pytest.mark.parametrize("per_block", [1, 3, 1000])
def test_small_blocks_and_odd_texts(spark, per_block, monkeypatch):
    monkeypatch.setattr(S.with_next, "__defaults__", (per_block,))
    rows = [(i * i - 50, t) for i, t in enumerate(["", None, "a", "a b c d e", "A  b\tc d e", "é ü 🎉 x y z w", " ", "w " * 999,
                                                   "one two three four five six", "b" * 500, "\x0b"])]
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], "doc_id long, text string, key string, block int, visit int")
    check(S.edited_pairs(df).collect(), rows, 1e-9)
    assert S.edited_pairs(df.limit(0)).count() == 0
    assert S.edited_pairs(df.where("doc_id = -46")).first().near_next == 1.0
    more = df.unionByName(df).unionByName(df.withColumn("doc_id", F.lit(None).cast("long")))
    assert S.edited_pairs(more).count() == 33


def test_fingerprint_is_the_bottom_k(spark):
    text = " ".join(f"w{i * 7 % 1000}" for i in range(900))
    row = spark.createDataFrame([(1, text)], "doc_id long, text string").select(
        S.shingle_hashes(S.word_hashes(F.col("text"))).alias("all"), S.sketch(F.col("text")).alias("s"),
        S.as_text(S.sketch(F.col("text"))).alias("t")).first()
    assert row.s == sorted(set(row["all"]))[:S.K]
    assert np.frombuffer(base64.b64decode(row.t), ">i8").tolist() == row.s


def test_merging_parts(spark):
    words = [f"w{i}" for i in range(3000)]
    texts = [(0, " ".join(words[:1500])), (1, " ".join(words[1000:2500])), (2, "")]
    df = S.fingerprints(spark.createDataFrame(texts, "doc_id long, text string")).withColumn("one", F.lit(1))
    merged = S.merge_all(df, ["one"]).first().sketch
    a, b = (df.where(f"doc_id = {i}").select("sketch") for i in (0, 1))
    row = a.withColumnRenamed("sketch", "a").join(b.withColumnRenamed("sketch", "b")).select(
        S.merge(F.col("a"), F.col("b")).alias("m"), S.resemblance(F.col("a"), F.col("b")).alias("r"),
        S.containment(F.col("a"), F.col("b")).alias("c"), S.distinct(S.merge(F.col("a"), F.col("b"))).alias("n")).first()
    assert merged == row.m
    assert abs(row.r - 496 / 2496) < 0.1 and abs(row.c - 496 / 1496) < 0.15 and abs(row.n - 2496) < 500


def test_main_path_is_native(spark):
    plan = S.edited_pairs(spark.read.parquet(f"{SF_CHECK}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_groups_without_shingles_and_null_keys_stay(spark):
    rows = [(1, "a b c d e f"), (2, ""), (2, None), (3, "  "), (None, "x y"), (None, "")]
    df = S.fingerprints(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r.doc_id: r.sketch for r in S.merge_all(df, ["doc_id"]).collect()}
    assert {k: len(v) for k, v in got.items()} == {1: 2, 2: 0, 3: 0, None: 1}


def test_distinct_is_exact_up_to_k(spark):
    for n in (255, 256, 257, 400):
        words = " ".join(f"w{i}" for i in range(n + S.SHINGLE - 1))
        df = S.fingerprints(spark.createDataFrame([(1, words)], "doc_id long, text string"))
        got = df.first().n_distinct
        assert got == n if n <= 256 else abs(got - n) < 0.25 * n
        assert S.merge_all(df.unionByName(df), ["doc_id"]).first().sketch == df.first().sketch


def test_many_rows_without_id_are_cut_into_blocks(spark):
    rows = [(None, f"text {i}") for i in range(900)] + [(i, f"t {i}") for i in range(100)]
    dealt, _ = S.with_next(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), rows_per_block=50)
    sizes = [r["count"] for r in dealt.groupBy("block").count().collect()]
    assert len(sizes) > 10 and max(sizes) < 200
    out = S.edited_pairs(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(out) == 1000


def test_bounds_are_no_literals_of_the_plan(spark):
    import time
    df = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"))
    start = time.time()
    dealt, _ = S.with_next(df, rows_per_block=5)  # 4,000 blocks
    assert time.time() - start < 20 and len(dealt._jdf.queryExecution().logical().toString()) < 20_000
    assert dealt.where("guest").count() == dealt.select("block").distinct().count()
