"""Toxicity scores from a factorization machine over hashed terms.

A text is the set of its lower-cased terms, hashed.  The machine adds a weight
per term and, for each pair of terms in the text, the inner product of two
short vectors, so a pair can mean more (or less) than its two terms:

    score = sigmoid(b + sum w_i + sum_{i<j} <v_i, v_j>)

Only terms whose share of toxic documents differs from the rest by more than chance
(``MIN_Z`` standard errors) get weights, either over all documents or among
those that hold such a term already: the latter finds the second half of a
pair.  All other terms, and with them the noise of long texts, count nothing.

It is trained on a bounded sample of the labelled rows (``SAMPLE_ROWS``): the
rarer class as whole as the bound allows, the sampling ratio undone by row
weights.  Scoring reads every text whole, in one pass without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agroframe.llm.common import WORD_CACHE_ENTRIES, small_batches, worker_cache

TERM_BITS = 28  # of the hash; only terms of the sample are stored, so wide hashes cost nothing
FACTORS = 8
SAMPLE_ROWS = 16_000
ALIKE = 0.8  # resemblance from which two texts of one label are copies in the choice of terms
MIN_DOCS = 3
MIN_Z = 4.5
EPOCHS = 40
RATE = 0.2
DECAY_W, DECAY_V = 1e-6, 5e-3
THRESHOLD = 0.3
SEED = 11

_find = re.compile(r"\w+").findall


def term_id(word: str) -> int:
    return xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass")) >> (64 - TERM_BITS)


def terms(text: str | None) -> set[str]:
    return set(_find(text.lower())) if text else set()


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that are never learned from: crc32 of the id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


@dataclass
class Model:
    bias: float
    ids: np.ndarray  # sorted hashed terms
    w: np.ndarray
    v: np.ndarray


def telling(docs: list[np.ndarray], labels: np.ndarray, min_docs: int = MIN_DOCS, min_z: float = MIN_Z) -> np.ndarray:
    """Terms whose documents are toxic more, or less, often than chance allows."""
    if not docs:
        return np.empty(0, dtype=np.int64)
    ids, at = np.unique(np.concatenate(docs), return_inverse=True)
    toxic = np.repeat(labels, [len(d) for d in docs])
    n, hit, p = np.bincount(at, minlength=len(ids)), np.bincount(at, toxic, len(ids)), labels.mean()
    spread = np.sqrt(np.maximum(n * p * (1 - p) * (1 - n / (len(docs) + 1)), 1e-9))
    return ids[(n >= min_docs) & (np.abs(hit - n * p) >= min_z * spread) & (0 < p < 1)]


def distinct(docs: list[np.ndarray], labels: np.ndarray, alike: float = ALIKE) -> list[int]:
    """The documents that are no copies of an earlier one of their label, for the choice of terms.

    Copies of one text would make each of its words telling.  Texts that share their two smallest hashes are
    compared on their full sets of terms; a resemblance of *alike* makes a copy.
    """
    kept, first = {}, []
    for i, (d, y) in enumerate(zip(docs, labels)):
        others = kept.setdefault((d[:2].tobytes(), y), [])
        for o in others:
            both = len(np.intersect1d(d, o, assume_unique=True))
            if both >= alike * (len(d) + len(o) - both):
                break
        else:
            others.append(d)
            first.append(i)
    return first


def train(docs: list[np.ndarray], labels: np.ndarray, weights: np.ndarray, epochs: int = EPOCHS,
          factors: int = FACTORS) -> Model:
    """Minibatch Adam on the weighted logistic loss; *docs* hold distinct term ids."""
    rng = np.random.default_rng(SEED)
    first = distinct(docs, labels)
    few, y_few = [docs[i] for i in first], labels[first]
    ids = telling(few, y_few)
    some = np.array([np.isin(d, ids).any() for d in few], dtype=bool)
    ids = np.union1d(ids, telling([d for d, s in zip(few, some) if s], y_few[some])) if some.any() else ids
    size = len(ids)
    rows = [np.flatnonzero(np.isin(ids, d, assume_unique=True)) for d in docs]
    positive = float((labels * weights).sum() / max(weights.sum(), 1e-9))
    # the last row is the bias, present in every document; it has no pair vector
    w = np.zeros(size + 1)
    w[size] = np.log(np.clip(positive, 1e-3, 0.999) / (1 - np.clip(positive, 1e-3, 0.999)))
    v = np.vstack([rng.normal(0, 0.01, (size, factors)), np.zeros((1, factors))])
    moments = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(v), np.zeros_like(v)]
    step, batch = 0, 256
    if 0 < labels.sum() < len(labels):
        for epoch in range(epochs):
            order = rng.permutation(len(rows))
            for at in range(0, len(order), batch):
                pick = order[at:at + batch]
                idx = np.concatenate([np.r_[rows[i], size] for i in pick])
                lens = np.array([len(rows[i]) + 1 for i in pick])
                start = np.r_[0, np.cumsum(lens)[:-1]]
                vi = v[idx]
                s = np.add.reduceat(vi, start)
                score = np.add.reduceat(w[idx], start) + 0.5 * ((s * s).sum(axis=1) - np.add.reduceat((vi * vi).sum(axis=1), start))
                p = 1 / (1 + np.exp(-np.clip(score, -30, 30)))
                g = np.repeat((p - labels[pick]) * weights[pick] / weights[pick].sum(), lens)
                gw = np.bincount(idx, g, size + 1)
                gv = (g[:, None] * (np.repeat(s, lens, axis=0) - vi))
                gv = np.stack([np.bincount(idx, gv[:, f], size + 1) for f in range(factors)], axis=1)
                gv[size] = 0
                decay = np.r_[np.full(size, DECAY_W), 0.0]
                step += 1
                rate = RATE * (1 - epoch / epochs) * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
                for x, grad, m1, m2 in ((w, gw + decay * w, moments[0], moments[1]), (v, gv + DECAY_V * v, moments[2], moments[3])):
                    m1 += 0.1 * (grad - m1)
                    m2 += 0.001 * (grad * grad - m2)
                    x -= rate * m1 / (np.sqrt(m2) + 1e-6)
    return Model(float(w[size]), ids, w[:size].astype(np.float32), v[:size].astype(np.float32))


def predict(model: Model, rows: np.ndarray) -> float:
    """Probability for the model rows of a text's terms."""
    v = model.v[rows].astype(np.float64)
    s = v.sum(axis=0)
    score = model.bias + model.w[rows].sum(dtype=np.float64) + 0.5 * float((s * s).sum() - (v * v).sum())
    return float(1 / (1 + np.exp(-np.clip(score, -30, 30))))


def sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """At most about *rows* labelled rows that are not held out: text, label, weight.

    Each class may fill half, and what the rarer one leaves.  A document with
    several labels is toxic if one says so; null labels say nothing.
    """
    known = (labels.where("toxic is not null and doc_id is not null").where(~held_out())
             .groupBy("doc_id").agg(F.max("toxic").alias("label")))
    count = {r.label: r["count"] for r in known.groupBy("label").count().collect()}
    rare = min(count, key=count.get, default=0)
    taken = {c: min(n, rows // 2) if c == rare else min(n, rows - min(count[rare], rows // 2)) for c, n in count.items()}
    share = F.lit(0.0)
    for c, n in count.items():
        share = F.when(F.col("label") == c, F.lit(taken[c] / n)).otherwise(share)
    draw = F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    picked = known.withColumn("share", share).where(draw < F.col("share"))
    # bounded by the sample size, so it may be broadcast
    return docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id") \
        .select("doc_id", "text", F.col("label").cast("double").alias("label"), F.try_divide(F.lit(1.0), "share").alias("weight"))


def fit(rows: DataFrame) -> Model:
    """Train on (doc_id, text, label, weight) in one task; the ids are a bounded sample.

    Of several rows of one id one counts, so the task's rows are bounded too: that with the greatest terms in byte order.
    """
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            ids = [np.unique(np.array([term_id(w) for w in terms(t)], dtype="<i8")).tobytes()
                   for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary()), batch.column(2), batch.column(3)],
                                             names=["doc_id", "ids", "label", "weight"])

    def learn(table: pa.Table) -> pa.Table:
        docs = [np.frombuffer(b, "<i8") for b in table.column("ids").to_pylist()]
        # the order of rows, and with it the model, does not depend on how they came
        key = [xxhash.xxh3_64_intdigest(d.tobytes()) for d in docs]
        order = np.lexsort((table.column("label").to_numpy(), key))
        m = train([docs[i] for i in order], table.column("label").to_numpy()[order], table.column("weight").to_numpy()[order])
        return pa.table({"bias": [m.bias], "ids": [m.ids.astype("<i8").tobytes()], "w": [m.w.astype("<f4").tobytes()],
                         "v": [m.v.astype("<f4").tobytes()]},
                        schema=pa.schema([("bias", pa.float64()), ("ids", pa.binary()), ("w", pa.binary()), ("v", pa.binary())]))

    rows = rows.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "label", "weight")
    got = (rows.mapInArrow(hashed, "doc_id long, ids binary, label double, weight double")
           .groupBy("doc_id").agg(F.max(F.struct("ids", "label", "weight")).alias("r")).select("r.*")
           .withColumn("one", F.lit(1)).groupBy("one").applyInArrow(learn, "bias double, ids binary, w binary, v binary").first())
    if got is None:  # nothing labelled: every text gets the same low score
        return Model(-3.0, np.empty(0, dtype=np.int64), np.empty(0, dtype=np.float32), np.empty((0, FACTORS), dtype=np.float32))
    return Model(got.bias, np.frombuffer(got.ids, "<i8"), np.frombuffer(got.w, "<f4"),
                 np.frombuffer(got.v, "<f4").reshape(-1, FACTORS))


def scorer(model: Model):
    """Function from a text to its score, for use inside a task."""
    row_of = {int(t): k for k, t in enumerate(model.ids)}
    known = worker_cache("terms")
    known.clear()  # rows of another model

    def of(text: str | None) -> float:
        words = terms(text)
        if len(known) > WORD_CACHE_ENTRIES:
            known.clear()
        for w in words.difference(known):
            known[w] = row_of.get(term_id(w), -1)
        rows = {known[w] for w in words}
        rows.discard(-1)
        return predict(model, np.array(sorted(rows), dtype=np.int64))

    return of


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every row.

    Null and empty texts get the score of the bias alone.  Null ids are never
    held out; repeated rows are scored each by itself; other columns are ignored.
    """
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = scorer(model)
        for batch in small_batches(batches):
            out = [of(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.float64())], names=["doc_id", "score"])

    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(scored, "doc_id long, score double")
    return out.select("doc_id", held_out().alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of *docs* whose text scores below *threshold*, all columns as they are; no shuffle."""
    at = docs.columns.index("text")

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = scorer(model)
        for batch in small_batches(batches):
            yield batch.filter(pa.array([of(t) < threshold for t in batch.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(clean, docs.schema)
