import numpy as np
import pytest
from conftest import SF_CHECK

from agroframe.llm import ann
from agroframe.llm.queries import QUERIES


def brute(ids, x, wanted, k=20):
    out = {}
    for q in wanted:
        score = (x * x[ids.index(q)]).sum(axis=1)
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != q][:k]
        out[q] = [(ids[j], score[j]) for j in order]
    return out


def test_recall_against_brute_force(spark):
    rows = spark.read.parquet(f"{SF_CHECK}/embeddings.parquet").orderBy("vec_id").collect()
    ids, x = [r.vec_id for r in rows], np.array([r.embedding for r in rows], dtype=np.float64)
    want = brute(ids, x, [i for i in ids if i % 20 == 0])
    got = {}
    for r in QUERIES["op3_one_bit_codes"](spark, SF_CHECK).orderBy("query_id", "rank").collect():
        assert r.rank == len(got.setdefault(r.query_id, [])) + 1
        got[r.query_id].append((r.vec_id, r.score))
    assert got.keys() == want.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.99 * sum(map(len, want.values()))
    for q in want:
        exact = dict(want[q])
        assert all(abs(s - exact[i]) < 1e-12 for i, s in got[q] if i in exact)


def test_error_bound():
    x = np.random.default_rng(3).standard_normal((4000, 64))
    centre = x.mean(axis=0)
    codes, length, f = ann.encode(x, centre)
    assert codes.shape == (4000, 8)
    est, err = ann.estimate(codes, length, f, centre, x[:50])
    assert (np.abs(est - x[:50] @ x.T) > err).mean() < 0.003


@pytest.mark.parametrize("dim,scale", [(1, 1e4), (1, 1.0), (64, 1e-20), (64, 1.0), (64, 3e18), (64, 1e37)])
def test_any_length_of_vectors(spark, dim, scale):
    x = (np.random.default_rng(4).standard_normal((300, dim)) * scale).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    codes, centres = ann.index(df)
    got = {}
    for r in ann.search(codes, centres, codes.where("id % 20 = 0")).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    want = brute(list(range(300)), x.astype(np.float64), range(0, 300, 20))
    assert got == {q: [i for i, _ in hits] for q, hits in want.items()}


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [1.0, 0.0]), (1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [1.0, nan]), (5, [inf, 1.0]),
            (6, [None, 1.0]), (7, []), (40, [1.0, 2.0, 3.0]), (8, [-1.0, 0.0]), (1, [1.0, 0.0]), (None, [1.0, 1.0])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, id int")
    codes, centres = ann.index(df)
    got = ann.search(codes, centres, codes.where("id % 20 = 0"), shard_vectors=2).orderBy("query_id", "rank").collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 1.0), (0, 2, 20, 1.0), (0, 3, 8, -1.0),
                                       (20, 1, 0, 1.0), (20, 2, 1, 1.0), (20, 3, 8, -1.0)]
    codes, centres = ann.index(df.limit(0))
    assert ann.search(codes, centres, codes).count() == 0


def test_ties_of_a_common_vector(spark):
    df = spark.range(3000).selectExpr("id vec_id", "if(id % 3 = 0, array(1f, 2f, 2f), array(float(id), 1f, -float(id))) embedding")
    codes, centres = ann.index(df)
    got = ann.search(codes, centres, codes.where("id = 0"), k=5, shard_vectors=100).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in got] == [(3, 9.0), (6, 9.0), (9, 9.0), (12, 9.0), (15, 9.0)]


def test_codes_leave_a_tenth_to_be_scored():
    """On sf0.1: at most 10 % of all pairs pass the bound, and at least 95 % (here all) of the neighbours do."""
    import pyarrow.parquet as pq
    x = np.array(pq.read_table("/root/testdata/sf0.1/embeddings.parquet")["embedding"].to_pylist(), dtype=np.float64)
    centre, bits = x.mean(axis=0), ann.code_bits(x.shape[1])
    codes, length, f = ann.encode(x, centre, bits)
    est, err = ann.estimate(codes, length, f, centre, x[::20], ann.SEARCH_BOUND, bits, ann.PLANES)
    own = np.zeros(est.shape, dtype=bool)
    own[np.arange(len(est)), np.arange(0, len(x), 20)] = True
    kth = np.partition(np.where(own, -np.inf, est - err), -20, axis=1)[:, -20]
    passed = (est + err >= kth[:, None]) & ~own
    score = np.where(own, -np.inf, x[::20] @ x.T)
    near = score >= np.partition(score, -20, axis=1)[:, -20][:, None]
    assert passed.mean() <= 0.1 and (near & passed).sum() >= 0.95 * near.sum()


def test_packed_counts_are_the_products_with_the_signs():
    rng = np.random.default_rng(8)
    x, centre = rng.standard_normal((200, 7)), rng.standard_normal(7)
    codes, length, f = ann.encode(x, centre, 128)
    signs = np.unpackbits(codes, axis=1, count=128) * 2.0 - 1
    q = rng.standard_normal((5, 7))
    est, _ = ann.estimate(codes, length, f, centre, q, bits=128)
    exact = (q @ ann.rotation(7, bits=128) / np.sqrt(128)) @ signs.T * (length / f) + (q @ centre)[:, None]
    assert np.abs(est - exact).max() < 0.1


def test_rows_that_share_an_id(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (0, [0.0, 1.0]), (3, [2.0, 1.0]), (4, [1.0, 3.0])], "vec_id long, embedding array<float>")
    codes, centres = ann.index(df)
    got = sorted(map(tuple, ann.search(codes, centres, codes.where("id = 0"), k=2).collect()))
    assert got == [(0, 1, 3, 2.0), (0, 1, 4, 3.0), (0, 2, 3, 1.0), (0, 2, 4, 1.0)]
