import hashlib
import random
import re

from conftest import SF_SMALL
from pyspark.sql import functions as F

from agroframe.llm import postings as P
from agroframe.llm.queries import QUERIES
from agroframe.session import materialize

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, width=P.WIDTH):
    windows = {}
    for i, t in items:
        w = words(t)
        for s in range(max(len(w) - width, 0) + 1 if w else 0):
            windows.setdefault(tuple(w[s:s + width]), set()).add("" if i is None else str(i))
    lengths = {len(g) for g in windows}
    out = []
    for d, t in docs:
        w, hit, seen = words(t), set(), set()
        for n in lengths:
            for s in range(len(w) - n + 1):
                if tuple(w[s:s + n]) in windows:
                    hit |= set(range(s, s + n))
                    seen |= windows[tuple(w[s:s + n])]
        out.append((d, len(w), len(hit), len(seen), hashlib.sha256(",".join(sorted(seen)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_query_against_plain_search(spark):
    docs, items = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("documents", "benchmark"))
    want = brute([tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in items.select("item_id", "text").collect()])
    assert any(r[-1] for r in want) and not all(r[-1] for r in want)
    assert rows(QUERIES["op11_positional_index"](spark, SF_SMALL)) == want


def test_random_words_few_terms(spark, monkeypatch):
    rnd = random.Random(3)
    text = lambda n, v: " ".join(rnd.choice("abcdefgh"[:v]) for _ in range(n))
    docs = [(i, text(rnd.randint(0, 60), rnd.choice([2, 4, 8]))) for i in range(60)]
    items = [(i, text(rnd.randint(0, 7), 8)) for i in range(12)] + [(90, "a"), (91, "b b"), (91, "a b c d e f")]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert rows(P.decontaminate(d, b, width=4)) == brute(docs, items, 4)
    monkeypatch.setattr(P, "BROADCAST_ROWS", 0)  # every join by a shuffle
    assert rows(P.decontaminate(d, b, width=4)) == brute(docs, items, 4)


def test_nulls_repeats_and_extra_columns(spark):
    passage = "One, two; THREE four five six seven eight nine ten eleven twelve"
    docs = [(1, passage), (1, passage), (2, None), (None, "x " + passage.upper() + " y"), (3, ""), (4, " ,.! "), (5, "É two short"),
            (6, "nothing " * 3000 + passage + " tail" * 3000), (7, "é two short")]
    items = [(10, passage), (10, passage), (None, passage), (2, "É two SHORT"), (11, None), (12, "--")]
    d = spark.createDataFrame([(*r, "x", 1) for r in docs], "doc_id long, text string, term string, row int")
    b = spark.createDataFrame([(*r, 0) for r in items], "item_id long, text string, phrase int")
    got = rows(P.decontaminate(d, b))
    assert got == brute(docs, items)
    assert [r[2] for r in got if r[0] == 6] == [12] and [r[2] for r in got if r[0] == 7] == [0]
    for x, y in ((d.limit(0), b), (d, b.limit(0))):
        assert rows(P.decontaminate(x, y)) == brute(docs if x is d else [], items if y is b else [])


def test_full_index_phrases_and_proximity(spark):
    docs = spark.createDataFrame([(1, "the red fox saw the old fox"), (2, "fox red"), (3, "red a b c d e fox"), (4, "red fox red")],
                                 "doc_id long, text string")
    index = P.write_index(docs)  # all postings
    assert index.where("term IS NOT NULL").count() == 7 + 2 + 7 + 3
    asked = materialize(P.windows_of(spark.createDataFrame([(0, "red fox"), (1, "the old"), (2, "fox")], "item_id long, text string"))
                        .select(F.col("item_id").alias("phrase"), "terms"), "asked")
    planned = P.plan_phrases(index, asked)
    named = P.documents_of(index).select("row", "doc_id")
    exact = P.phrase_places(index, planned).join(named, "row").select("phrase", "doc_id", "start")
    assert rows(exact) == [(0, 1, 1), (0, 4, 0), (1, 1, 4), (2, 1, 2), (2, 1, 6), (2, 2, 0), (2, 3, 6), (2, 4, 1)]
    near = P.near_places(index, planned.where("phrase = 0"), 5).join(named, "row").select("doc_id", "first", "last")
    # red is as frequent as fox; the one at the smaller offset is taken as the rarest
    found = {tuple(r) for r in near.collect()}
    assert {(2, 0, 1), (1, 1, 2), (4, 0, 1)} <= found and not any(r[0] == 3 for r in found)
