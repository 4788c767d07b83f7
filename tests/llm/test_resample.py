import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from agroframe.llm import resample as R
from agroframe.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, n=1):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return len(w), [zlib.crc32(" ".join(w[i:i + k]).encode()) % 10_000 for k in range(1, n + 1) for i in range(len(w) - k + 1)]


def brute(docs, target, n=1, least=20, percent=10):
    held = [(d, *features(t, n)) for d, t in docs]
    s, t = Counter(b for *_, f in held for b in f), Counter(b for x in target for b in features(x, n)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1.0) * (all_s + 1e4) / ((s[b] + 1.0) * (all_t + 1e4)))) for b in s}
    out = []
    for d, words, f in held:
        h = int(hashlib.sha256(f"2024:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        w = sum(gain[b] for b in f)
        out.append([d, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), words])
    order = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[2], r[1]))
    rank = {id(r): i + 1 for i, r in enumerate(order[:percent * len(order) // 100])}
    return sorted(((*r[:4], rank.get(id(r))) for r in out), key=str)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_query_against_plain_python(spark):
    docs, items = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("documents", "benchmark"))
    want = brute([tuple(r) for r in docs.select("doc_id", "text").collect()], [r.text for r in items.collect()])
    assert rows(QUERIES["op12_target_resampling"](spark, SF_SMALL)) == want


def test_longer_runs_nulls_ties_and_extra_columns(spark):
    rnd = random.Random(5)
    docs = [(i, " ".join(rnd.choices(["Ab", "é", "C3", "dd", "e-f"], k=rnd.randint(0, 9)))) for i in range(80)]
    docs += [(7, docs[7][1]), (7, "other words here"), (None, "ab ab ab ab"), (None, None), (200, None), (201, " .,"), (202, "x " * 30_000)]
    target = ["ab c3 é", None, "", "dd dd"]
    d = spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, score int")
    t = spark.createDataFrame([(x, 2) for x in target], "text string, doc_id int")
    assert rows(R.resample(d, t, max_run=3, min_words=3, percent=35)) == brute(docs, target, 3, 3, 35)
    assert rows(R.resample(d, t.limit(0), min_words=3, percent=100)) == brute(docs, [], 1, 3, 100)
    assert rows(R.resample(d.limit(0), t)) == []
    assert rows(R.resample(d, t, min_words=10**6)) == brute(docs, target, 1, 10**6)


@pytest.mark.parametrize("k", [1, 7, 3000, 9_999, 10_000])
def test_bracket_holds_the_cutoff_and_widens(spark, k):
    # half of all rows share one score, far from even
    table = spark.range(10_000).select(F.when(F.col("id") % 2 == 0, F.lit(50)).otherwise((F.col("id") * 7919) % 1000).cast("long").alias("score"))
    b = R.bracket(table, k, 10_000, margin=1e-9)
    scores = sorted((r.score for r in table.collect()), reverse=True)
    assert b.low <= scores[k - 1] <= b.high and b.above < k <= b.above + b.inside
    assert b.above == sum(s > b.high for s in scores) and b.inside == sum(b.low <= s <= b.high for s in scores)


def test_a_wrong_proposal_is_widened(spark):
    table = spark.range(1000).select(F.col("id").alias("score"))
    b = R.bracket(table, 500, 250)  # a wrong n proposes shares beyond the ends
    assert b.above < 500 <= b.above + b.inside and b.tries > 1
