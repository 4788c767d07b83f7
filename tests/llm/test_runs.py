import hashlib
import random
import zlib

import numpy as np
from conftest import SF_SMALL
from hypothesis import given, settings
from hypothesis import strategies as st

from agroframe.llm import runs as R
from agroframe.llm.queries import QUERIES


def brute(w):
    """(start, length, smallest period) of every run, from its definition."""
    found = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def expected(doc_id, text, plant=True):
    w = (text or "").encode().split()
    if plant and w and doc_id is not None and (h := zlib.crc32(str(doc_id).encode())) % 10 == 0:
        g = h // 10
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
    found = brute(w)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(found), *((*best, 1000 * best[1] // best[2]) if best else (None,) * 4),
            sha("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()), sha(b" ".join(x for i, x in enumerate(w) if i not in gone)))


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_query_against_plain_search(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    want = sorted((expected(*r) for r in docs if len((r[1] or "").split()) < 3000), key=str)
    got = [r for r in rows(QUERIES["op13_periodic_runs"](spark, SF_SMALL))]
    assert len(got) == len(docs) and set(want) <= set(got) and sum(r[1] > 0 for r in want) > 5


unit = st.lists(st.integers(0, 2), min_size=1, max_size=7)
piece = st.tuples(unit, st.integers(1, 9), st.integers(0, 6)).map(lambda x: x[0] * x[1] + x[0][:x[2]])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(piece, max_size=6).map(lambda p: sum(p, [])), min_size=1, max_size=5))
def test_runs_of_repetitive_texts(documents):
    got = R.find_runs([np.array(d, dtype=np.int64) for d in documents])
    assert [[tuple(r) for r in g.tolist()] for g in got] == [brute(d) for d in documents]


def test_extensions_are_exact_both_ways():
    rnd = random.Random(2)
    text = [9] + [rnd.randint(0, 1) for _ in range(150)] + [3] * 40 + [0, 1] * 60 + [8]
    levels = R.grammar(np.array(text))
    pairs = [(i, j) for i in range(1, len(text) - 1) for j in range(i + 1, len(text) - 1)]
    a, b = (np.array(x) for x in zip(*pairs))
    ahead, back = R.extension(levels, a, b), R.extension(levels, a, b, forward=False)
    for i, j, x, y in zip(a.tolist(), b.tolist(), ahead.tolist(), back.tolist()):
        n = 0
        while text[i + n] == text[j + n]:
            n += 1
        m = 0
        while text[i - m] == text[j - m]:
            m += 1
        assert (n, m) == (x, y)
    assert len(levels[-1].symbol) == 1


def test_long_texts_nulls_and_repeats(spark):
    long = " ".join(str(i % 700) for i in range(250_000)) + " end"
    docs = [(1, "a " * 8), (1, "a " * 8), (2, None), (3, ""), (4, " \t\n"), (None, "x y\tx y\nx\x0by x y"), (5, "a b c " * 4 + "a"), (6, "A a " * 2),
            (7, "é é " * 6)]
    df = spark.createDataFrame([(*r, "c") for r in [*docs, (8, long)]], "doc_id long, text string, runs string")
    got = {(r[0], r[7]): r for r in rows(R.runs_of(df, texts=False))}
    assert len(got) == 9 and [r for k, r in got.items() if k[0] == 8][0][1:6] == (1, 0, 250_000, 700, 357_142)
    assert set(got.values()) >= {expected(d, t, plant=False) for d, t in docs}
    whole = {r.doc_id: r for r in R.runs_of(df).collect()}
    assert [tuple(x) for x in whole[5].runs] == [(0, 13, 3)] and whole[5].collapsed == "a b c"
    assert rows(R.runs_of(df.limit(0))) == []
