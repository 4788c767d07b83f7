"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import sys
import types
from contextlib import contextmanager

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WORD_CACHE_ENTRIES = 150_000  # hashed words kept per Python worker; results never depend on it

BROADCAST_ROWS = 1_000_000  # a few numbers each; larger sides are joined by a shuffle


def few_or_shuffled(rows: DataFrame) -> DataFrame:
    """*rows* (written, a few numbers each), to be broadcast only if counted below ``BROADCAST_ROWS``."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


HOT_ROWS = 2048  # rows of one key from which on a key is dealt over several tasks
SALTS = 32


def hot_keys(sizes: DataFrame, key: str, size: str = "size") -> DataFrame:
    """The keys (``hot``) of *sizes* (written, one row a key) with so many rows that one task should not take them all.

    Fewer than ``BROADCAST_ROWS`` keys, whatever the input: the limit is at least that part of all rows.
    """
    rows = sizes.agg(F.sum(size)).first()[0] or 0
    return sizes.where(F.col(size) > max(HOT_ROWS, rows // max(BROADCAST_ROWS, 1))).select(key, F.lit(True).alias("hot"))


def join_dealt(rows: DataFrame, other: DataFrame, key: str, hot: DataFrame, by: str) -> DataFrame:
    """*rows* joined with *other* (one row a key) on *key*; the rows of *hot* keys are dealt by *by* over ``SALTS`` tasks."""
    marked = lambda df: df.join(F.broadcast(hot), key, "left")
    salt = F.when(F.col("hot"), F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int")).otherwise(0)
    every = F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    return (marked(rows).withColumn("salt", salt).drop("hot")
            .join(marked(other).withColumn("salt", F.explode(every)).drop("hot"), [key, "salt"]).drop("salt"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


LARGE_CACHES = ("encoders", "word_hashes", "terms")


def worker_cache(name: str) -> dict:
    """A dict that lives as long as the Python worker process, across tasks.

    Functions are shipped by value, so their module globals are new in every
    task; the holder is kept in ``sys.modules`` of the reused worker instead.
    A worker keeps one large cache at a time: asking for another empties it,
    so the stages of a pipeline do not add up in memory.
    """
    holder = sys.modules.setdefault("_agroframe_worker_cache", types.ModuleType("_agroframe_worker_cache")).__dict__
    if name in LARGE_CACHES:
        for other in LARGE_CACHES:
            if other != name and holder.get(other):
                holder[other].clear()
    return holder.setdefault(name, {})


def small_batches(batches, rows: int = 1000):
    """The same rows in batches of at most *rows*, so that few texts are Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


TEXT_ROWS = 256  # rows with whole texts or sets that go to a Python worker at a time


@contextmanager
def text_batches(spark: SparkSession, rows: int | None = None):
    """Jobs run within it send Python workers at most *rows* (``TEXT_ROWS``) rows at a time.

    A batch stands in the executor's memory beyond the heap several times over (Arrow vectors, the buffer of the
    worker's socket, the worker), so rows that hold texts go in small ones.  A smaller setting of the session stays.
    """
    key, rows = "spark.sql.execution.arrow.maxRecordsPerBatch", rows or TEXT_ROWS
    before = spark.conf.get(key)
    if 0 < int(before) <= rows:
        yield
        return
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash (bijective), vectorised."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hash of each word, through a bounded per-worker cache."""
    cache = worker_cache("word_hashes")
    try:
        return np.array([cache[w] for w in words], dtype=np.uint64)
    except KeyError:
        if len(cache) > WORD_CACHE_ENTRIES:
            cache.clear()
        digest = xxhash.xxh3_64_intdigest
        for w in words:
            if w not in cache:
                cache[w] = digest(w)
        return np.array([cache[w] for w in words], dtype=np.uint64)


def split_words(text: str | None) -> list[bytes]:
    """A-Z lower-cased, then maximal runs of bytes other than space and \\x09-\\x0D.

    ``bytes.lower`` and ``bytes.split`` touch ASCII letters and ASCII white
    space only, which is exactly this definition for UTF-8 text.
    """
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word *k*-shingles of *text*.

    Fewer than *k* words make one shingle of the whole sequence; no words make
    the empty set.
    """
    words = split_words(text)
    if not words:
        return np.empty(0, dtype=np.uint64)
    h = word_hashes(words)
    n = max(len(h) - k + 1, 1)
    with np.errstate(over="ignore"):
        acc = np.full(n, np.uint64(min(k, len(h))), dtype=np.uint64)
        for j in range(min(k, len(h))):
            acc = mix64((acc + h[j:j + n]) * np.uint64(0x9E3779B97F4A7C15))
    acc.sort()
    return acc[np.r_[True, acc[1:] != acc[:-1]]]
