import glob
import random
import uuid

import numpy as np
import pytest
from conftest import SF_CHECK
from pyspark.sql import functions as F

from agroframe.llm import neardup as N
from agroframe.llm.common import hot_keys, join_dealt, shingle_set
from agroframe.llm.graph import connected_components
from agroframe.llm.queries import QUERIES


def brute(rows, k, percent):
    """Component of every row by comparing every two texts' sets of word tuples."""
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i:i + k]) for i in range(max(len(w) - k + 1, 1))} if w else set())
    parent = list(range(len(rows)))

    def top(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    holders = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    for i, s in enumerate(sets):
        near = {}
        for x in s:
            for j in holders[x]:
                if j > i:
                    near[j] = near.get(j, 0) + 1
        for j, inter in near.items():
            if 100 * inter >= percent * (len(s) + len(sets[j]) - inter):
                parent[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[top(i)] = min(least.get(top(i), d), d)
    return sorted((d, len(sets[i]), least[top(i)]) for i, (d, _) in enumerate(rows) if d is not None)


def got(df):
    rows = df.collect()
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in rows)
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in rows if r.doc_id is not None)


def test_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "text").collect()]
    assert got(QUERIES["op7_hyperminhash"](spark, SF_CHECK)) == brute(rows, 3, 85)


def _variants(rng, n):
    """A large group of near copies at every distance, chains, short texts and copies."""
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    base = [word() for _ in range(200)]
    rows = []
    for i in range(n):
        w = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 5, 8, 13, 30])):
            w[rng.randrange(len(w))] = word()
        rows.append(" ".join(w))
    chain = [word() for _ in range(120)]
    for _ in range(40):
        chain[rng.randrange(len(chain))] = word()
        rows.append(" ".join(chain))
    rows += ["one two three four five six seven eight nine ten eleven twelve", "One two\tthree four five six seven eight "
             "nine ten eleven twelve", "one two three four five six seven eight nine ten eleven", "a", "a", "A", "a b",
             "a b c", "a  b c", "", None, " \n", "x " * 50000, "x " * 40000, "<  y"]
    return rows


@pytest.mark.parametrize("k,percent", [(3, 85), (5, 80)])
def test_hot_group(spark, monkeypatch, k, percent):
    rng = random.Random(5)
    rows = [(i, t) for i, t in enumerate(_variants(rng, 400))]
    rng.shuffle(rows)
    monkeypatch.setattr(N, "BLOCK", 64)
    monkeypatch.setattr("agroframe.llm.common.BROADCAST_ROWS", 0 if k == 5 else 10**6)  # joined by a shuffle, by broadcast
    if k == 3:
        monkeypatch.setattr("agroframe.llm.common.HOT_ROWS", 20)  # hot buckets and hubs are dealt over tasks
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, digest string, size int")
    assert got(N.groups(df, k, percent)) == brute(rows, k, percent)


def test_texts_reach_workers_in_small_batches(spark, monkeypatch, tmpdir_path):
    def counted(batches, rows=0):
        for batch in batches:
            with open(f"{tmpdir_path}/{uuid.uuid4().hex}", "w") as f:
                f.write(f"{batch.num_rows} {batch.schema.names}")
            yield batch

    monkeypatch.setattr("agroframe.llm.common.TEXT_ROWS", 16)
    monkeypatch.setattr(N, "small_batches", counted)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    rows = list(enumerate(_variants(random.Random(8), 150)))
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert got(N.groups(df, 3, 85)) == brute(rows, 3, 85)
    seen = [open(f).read().split(" ", 1) for f in glob.glob(f"{tmpdir_path}/*")]
    assert {names.count("text") for _, names in seen} == {1, 2}  # signatures or full sets, pairs
    assert max(int(n) for n, _ in seen) <= 16 and sum(int(n) for n, names in seen if "text_a" not in names) >= len(rows)
    assert spark.conf.get(key) == before


def test_rows_of_a_hot_key_are_dealt(spark, monkeypatch):
    monkeypatch.setattr("agroframe.llm.common.HOT_ROWS", 100)
    rows = spark.range(5000).select(F.when(F.col("id") < 3000, 7).otherwise(F.col("id")).alias("key"), "id").repartition(16, "key")
    sizes = rows.groupBy("key").agg(F.count("*").alias("size"))
    hot = hot_keys(sizes, "key")
    assert [r.key for r in hot.collect()] == [7]
    out = join_dealt(rows, sizes.select("key", F.col("size").alias("n")), "key", hot, by="id")
    assert out.columns == ["key", "id", "n"]
    assert sorted((r.key, r.id, r.n) for r in out.collect()) == sorted(
        [(7, i, 3000) for i in range(3000)] + [(i, i, 1) for i in range(3000, 5000)])
    assert "salt" in out._jdf.queryExecution().toString()
    assert hot_keys(sizes.limit(0), "key").isEmpty()


def test_odd_rows(spark):
    rows = [(None, "q w e r t y"), (None, None), (3, "q w e r t y"), (3, "q w e r t y"), (1, None), (2, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(N.groups(df)) == [(1, 0, 1), (2, 0, 2), (3, 2, 3), (3, 2, 3)]
    assert N.groups(df).count() == 6 and N.groups(df.limit(0)).count() == 0
    kept = N.keep_one(spark.createDataFrame([(*r, 7) for r in rows + [(9, "Q w e r t  y")]],
                                            "doc_id long, text string, n_chars int"))
    assert kept.columns == ["doc_id", "text", "n_chars"]
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 0, 1, 2, 3]


def test_keep_one_of_rows_with_one_id(spark):
    copy, other, null = "q w e r t y u", "some quite different words of this text", "the text of rows without any id"
    rows = [(1, copy), (5, copy), (5, other), (5, other), (7, other + " again"), (None, null), (None, null), (None, copy),
            (8, "Q w e r t  y u"), (9, None), (9, ""), (9, None)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_chars int")
    left = sorted(((r.doc_id, r.text) for r in N.keep_one(df, 3, 80).collect()), key=repr)
    assert left == sorted([(1, copy), (5, other), (9, None), (9, ""), (None, null), (None, null), (None, copy)], key=repr)


def test_registers_and_estimate():
    rng = np.random.default_rng(1)
    for n in (3, 40, 600, 20000):
        for share in (0.5, 0.85, 0.95):
            common = rng.integers(0, 2**63, max(1, round(n * share)), dtype=np.uint64)
            extra = [rng.integers(0, 2**63, max(1, round(n * (1 - share) / 2)), dtype=np.uint64) for _ in range(2)]
            a, b = (np.unique(np.r_[common, e]) for e in extra)
            true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            same = (N.registers(a) == N.registers(b)).sum()
            got = N.estimate(np.array([same]), np.array([len(a)]), np.array([len(b)]))[0]
            if n > N.ALWAYS_VERIFY:
                assert abs(got - true) < 5 * np.sqrt(true * (1 - true) / N.REGISTERS) + 0.01
    assert N.accidental(np.array([600.0]), np.array([600.0]))[0] < 0.001
    assert N.bands(0.85) == (32, 6) and N.bands(0.8) == (38, 5)


@pytest.mark.parametrize("percent,sizes", [(85, (7, 8, 13, 20)), (80, (5, 6, 10, 20))])
def test_short_sets_share_a_band(percent, sizes):
    """Sets of n and of the fewest shingles among them that reach the threshold."""
    rng = np.random.default_rng(7)
    n_bands, width = N.bands(percent / 100)
    for n in sizes:
        for _ in range(300):
            a = rng.integers(0, 2**64, n, dtype=np.uint64)
            same = N.registers(a) == N.registers(a[:-(-n * percent // 100)])
            assert same[:n_bands * width].reshape(n_bands, width).all(axis=1).any(), n


@pytest.mark.parametrize("k,percent,words", [(3, 85, 9), (5, 80, 9)])
def test_short_pairs_are_linked(spark, k, percent, words):
    """A word appended or cut: 7 and 6 shingles of three words, 5 and 4 of five."""
    rng = random.Random(3)
    rows = []
    for i in range(150):
        w = ["".join(rng.choices("abcdefghij", k=7)) for _ in range(words)]
        rows += [(2 * i, " ".join(w)), (2 * i + 1, " ".join(w[:-1]))]
    want = brute(rows, k, percent)
    assert len({c for *_, c in want}) == 150
    assert got(N.groups(spark.createDataFrame(rows, "doc_id long, text string"), k, percent)) == want


def test_shingle_set_words():
    assert len(shingle_set("a b c d", 3)) == 2 and len(shingle_set("A b", 3)) == 1 and not len(shingle_set(" \x0b", 3))
    assert shingle_set("A\x0bB c", 3).tolist() == shingle_set("a b C", 3).tolist()
    assert shingle_set("a b c", 3).tolist() != shingle_set("a b c", 3).tolist()


def test_components(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 5000), (5000, 3000), (7, 7), (7000, 7000)] + [(400, 401 + i) for i in range(99)]
    out = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    want = {i: 0 for i in range(201)} | {1000: 1000, 3000: 1000, 5000: 1000, 400: 400} | {401 + i: 400 for i in range(99)}
    assert {r.id: r.component for r in out} == want and len(out) == len(want)
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
