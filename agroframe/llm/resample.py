"""Resampling towards a target distribution by importance weights.

Features are runs of words, hashed into buckets.  A bucket's gain is the scaled
logarithm of its smoothed share in the target over that in the corpus; the gains
are one array, and a document's weight is the sum of the array over its
features.  With Gumbel noise fixed by the id, the documents of the highest
scores are a sample without replacement in proportion to the weights' exponentials.

The cutoff is found without ordering the table: a mergeable quantile sketch
(``approx_percentile``) brackets it, exact counts outside the bracket confirm or
widen that, and only the rows inside the bracket are sorted.  The texts are read once:
the buckets of every document's features are written and then counted and scored.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agroframe.llm.common import small_batches, worker_cache
from agroframe.operators.ranking import rank_within
from agroframe.session import materialize

MAX_RUN, BUCKETS, SCALE, SEED = 1, 10_000, 1000, 2024
MIN_WORDS, PERCENT = 20, 10
ACCURACY = 10_000  # of the quantile sketch: its rank error is a share of 1 / ACCURACY
FIRST_MARGIN = 4 / ACCURACY
CACHED_WORDS = 200_000  # per Python worker; results never depend on it

# digits, letters (A-Z lower-cased) and bytes beyond ASCII stay, all else separates
_PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def split_words(text: str | None) -> list[bytes]:
    """A-Z lower-cased, then the maximal runs of digits, letters and characters beyond ASCII, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_PLAIN).split() if text else []


def feature_buckets(text: str | None, max_run: int, buckets: int) -> tuple[int, np.ndarray]:
    """The number of words, and the bucket of every run of 1 to *max_run* consecutive words (repeats kept)."""
    words = split_words(text)
    cache = worker_cache("buckets")
    if cache.get("modulus") != buckets or len(cache) > CACHED_WORDS:
        cache.clear()
        cache["modulus"] = buckets
    found = []
    for w in words:
        b = cache.get(w)
        if b is None:
            b = cache[w] = zlib.crc32(w) % buckets
        found.append(b)
    for n in range(2, max_run + 1):
        found += [zlib.crc32(b" ".join(words[i:i + n])) % buckets for i in range(len(words) - n + 1)]
    return len(words), np.array(found, dtype="<u4")


def bucketed(docs: DataFrame, max_run: int = MAX_RUN, buckets: int = BUCKETS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_features and the features' buckets (unsigned 32-bit, packed) of every row, written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            rows = [feature_buckets(t, max_run, buckets) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array([n for n, _ in rows], pa.int64()),
                 pa.array([len(b) for _, b in rows], pa.int64()), pa.array([b.tobytes() for _, b in rows], pa.binary())],
                names=["doc_id", "n_words", "n_features", "buckets"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return materialize(rows.mapInArrow(run, "doc_id long, n_words long, n_features long, buckets binary"), "buckets")


def bucket_counts(rows: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features per bucket over all rows of ``bucketed``: one array per task, added up by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for packed in batch.column(0):
                total += np.bincount(np.frombuffer(packed.as_buffer(), dtype="<u4"), minlength=buckets)
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(total)), pa.array(total[total > 0])], names=["bucket", "n"])

    counted = rows.where("n_features > 0").select("buckets").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, dtype=np.int64)
    for r in counted.collect():  # at most *buckets* rows
        out[r.bucket] = r.n
    return out


def gains(corpus: np.ndarray, target: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * ln) of every bucket's smoothed target share over its smoothed corpus share."""
    all_corpus, all_target, n = int(corpus.sum()), int(target.sum()), len(corpus)
    ratio = lambda s, t: ((t + 1.0) * (all_corpus + float(n))) / ((s + 1.0) * (all_target + float(n)))
    return np.array([math.floor(scale * math.log(ratio(float(s), float(t)))) for s, t in zip(corpus, target)], dtype=np.int64)


def noise(doc_id: int | None, scale: int = SCALE, seed: int = SEED) -> int:
    """Scaled Gumbel noise from the first 32 bits of a sha256 of seed and id (a null id is written as nothing)."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-scale * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(rows: DataFrame, gain: np.ndarray, scale: int = SCALE, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight and score of every row of ``bucketed``, written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weight = [int(gain[np.frombuffer(b.as_buffer(), dtype="<u4")].sum()) for b in batch.column("buckets")]
            score = [w + noise(i, scale, seed) for w, i in zip(weight, batch.column("doc_id").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_words"), batch.column("n_features"),
                                              pa.array(weight, pa.int64()), pa.array(score, pa.int64())],
                                             names=["doc_id", "n_words", "n_features", "weight", "score"])

    return materialize(rows.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long, score long"), "scored")


@dataclass(frozen=True)
class Bracket:
    """Scores from *low* to *high*; *above* rows score more and *inside* rows lie in it; *tries* brackets were counted."""

    low: int
    high: int
    above: int
    inside: int
    tries: int


def bracket(rows: DataFrame, k: int, n: int, margin: float = FIRST_MARGIN) -> Bracket:
    """A bracket of scores that holds the *k*-th highest of *n* rows (1 <= k <= n), checked by exact counts.

    The sketch proposes the scores *margin* below and above the wanted share; if the counts
    outside show that the cutoff lies elsewhere, the failing side is moved on by four times the margin.
    """
    share, below, over, tries = 1 - k / n, margin, margin, 0
    while True:
        tries += 1
        shares = [min(max(x, 0.0), 1.0) for x in (share - below, share + over)]
        low, high = rows.agg(F.percentile_approx("score", shares, ACCURACY)).first()[0]
        if share - below <= 0 or share + over >= 1:  # beyond the ends: the exact extremes
            least, most = rows.agg(F.min("score"), F.max("score")).first()
            low, high = least if share - below <= 0 else low, most if share + over >= 1 else high
        above, inside = rows.agg(F.count_if(F.col("score") > high), F.count_if(F.col("score").between(low, high))).first()
        if above < k <= above + inside:
            return Bracket(low, high, above, inside, tries)
        below, over = (below, over * 4) if above >= k else (below * 4, over)


def _order() -> list[Column]:
    """Highest score, then smallest id (null ids last), then the columns that may differ in rows of one id."""
    return [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("weight"), F.asc("n_features"), F.asc("n_words")]


def draw(rows: DataFrame, k: int, n: int, eligible: Column) -> DataFrame:
    """*rows* with ``rank``: 1 to *k* for the highest scores among the *n* eligible rows, null for all others."""
    unranked = lambda df: df.withColumn("rank", F.lit(None).cast("long"))
    if k == 0:
        return unranked(rows)
    b = bracket(rows.where(eligible), k, n)
    inside = eligible & F.col("score").between(b.low, b.high)
    ordered = materialize(rank_within(rows.where(inside), [], _order(), out="place"), "bracket")
    taken = F.col("place") <= k - b.above
    surely = rows.where(eligible & (F.col("score") > b.high))
    drawn = rank_within(surely, [], _order(), out="rank").unionByName(
        ordered.where(taken).withColumn("rank", F.col("place") + b.above).drop("place"))
    rest = rows.where(~(eligible & (F.col("score") >= b.low))).unionByName(ordered.where(~taken).drop("place"))
    return drawn.unionByName(unranked(rest))


def resample(docs: DataFrame, target: DataFrame, max_run: int = MAX_RUN, buckets: int = BUCKETS, scale: int = SCALE,
             seed: int = SEED, min_words: int = MIN_WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every document, where *target* (column ``text``) sets the weights.

    floor(percent * N / 100) of the N documents with at least *min_words* words get a rank; all others have none.

    Null, empty and blank texts have no features and weight 0.  Every row counts, also where ids
    or texts repeat; of equal scores the smaller id comes first, a null id last.  Either table may be
    empty; other columns are ignored.
    """
    rows = bucketed(docs, max_run, buckets)
    wanted = bucketed(target.select(F.lit(0).alias("doc_id"), "text"), max_run, buckets)
    table = scored(rows, gains(bucket_counts(rows, buckets), bucket_counts(wanted, buckets), scale), scale, seed)
    eligible = F.col("n_words") >= min_words
    n = table.where(eligible).count()
    return draw(table, percent * n // 100, n, eligible).select("doc_id", "n_features", "weight", "score", "rank")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark),
f AS (SELECT r, unnest(w) AS word FROM d),
tab AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY i) AS t
  FROM (SELECT unnest(range(256))::BIGINT AS i)),
hexed AS (SELECT word, hex(word) AS h FROM (SELECT word FROM f UNION SELECT word FROM b)),
bytes AS (SELECT word, list_transform(range(1, len(h), 2), lambda i: ('0x' || substr(h, i, 2))::BIGINT) AS bs FROM hexed),
hashed AS (
  SELECT word, xor(list_reduce(list_prepend(4294967295, bs),
    lambda c, x: xor(c // 256, t[(xor(c, x) % 256) + 1])), 4294967295) % 10000 AS bucket FROM bytes, tab),
s AS (SELECT bucket, count(*) AS s FROM f JOIN hashed USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM b JOIN hashed USING (word) GROUP BY bucket),
gain AS (
  SELECT bucket, floor(1000 * ln(((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM f) + 10000)::DOUBLE)
    / ((s + 1)::DOUBLE * ((SELECT count(*) FROM b) + 10000)::DOUBLE)))::BIGINT AS gain FROM s LEFT JOIN t USING (bucket)),
weights AS (SELECT r, count(*) AS n, sum(gain)::BIGINT AS weight FROM f JOIN hashed USING (word) JOIN gain USING (bucket) GROUP BY r),
scores AS (
  SELECT doc_id, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE)
      / 4294967296::DOUBLE))))::BIGINT AS score FROM d LEFT JOIN weights USING (r)),
ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS total
  FROM scores WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, rank
FROM scores LEFT JOIN (SELECT doc_id, rank FROM ranked WHERE rank <= 10 * total // 100) USING (doc_id)
"""
