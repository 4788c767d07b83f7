"""Near-duplicate groups by HyperMinHash registers.

Every text becomes the set of its word shingles.  Its hashes are dealt into M
bins; a register keeps, of the smallest hash in its bin, the number of leading zeros and
the mantissa bits after them.  An empty bin borrows from the first
filled one in an order of all bins fixed for it, so short texts fill their registers
too, and the loan depends on which bins are filled, not on how many.

1. Texts with equal sets form a class (grouped by a digest of the set).
2. Bands of registers of the class representatives give buckets.
3. In every bucket each member is paired with the smallest id; pairs whose
   collision-corrected Jaccard estimate is too low are dropped; the others are
   verified on the full texts, and verified links give components.
4. In buckets that still hold several components, the remaining pairs across
   components are estimated block against block inside tasks; those that may
   reach the threshold are verified there, most alike first, until their
   components are joined.  A task sends on no more links than it joins components.
5. Components of all verified links, spread to the classes' documents.

So no bucket is expanded into all its pairs, and no pair that shares a
bucket and whose estimate allows the threshold stays untested, except within a
component, where its outcome cannot change anything.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agroframe.llm.common import (TEXT_ROWS, few_or_shuffled, hot_keys, join_dealt, mix64, shingle_set, small_batches, text_batches,
                                  worker_cache)
from agroframe.llm.graph import connected_components
from agroframe.operators.ranking import rank_within
from agroframe.session import materialize

REGISTERS = 192
MANTISSA_BITS = 10
MISS = 1e-6  # chance that a pair at the threshold shares no bucket, were its registers independent
SLACK_ERRORS = 4.0  # standard errors below the threshold at which an estimate still passes
ALWAYS_VERIFY = 64  # sets up to this size skip the estimate
BLOCK = 1024
_PROBES = 32  # looked at first; the rest of the order only where these are all empty


def bands(threshold: float, registers: int = REGISTERS, miss: float = MISS) -> tuple[int, int]:
    """(number of bands, registers per band): the longest bands that still miss less than *miss*."""
    best = (registers, 1)
    for r in range(1, registers + 1):
        b = registers // r
        if (1 - threshold ** r) ** b <= miss:
            best = (b, r)
    return best


def registers(hashes: np.ndarray, m: int = REGISTERS) -> np.ndarray:
    """HyperMinHash registers (uint16: leading zeros, then mantissa) of a non-empty hash set."""
    with np.errstate(over="ignore"):
        bins = ((hashes >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
        value = mix64(hashes ^ np.uint64(0xA5A5A5A55A5A5A5A))
    least = np.full(m, np.iinfo(np.uint64).max, dtype=np.uint64)
    np.minimum.at(least, bins, value)
    held = np.zeros(m, dtype=bool)
    held[bins] = True
    fraction, exponent = np.frexp(least.astype(np.float64))
    zeros = np.clip(64 - exponent, 0, 63).astype(np.uint16)
    mantissa = np.clip((fraction - 0.5) * (2 << MANTISSA_BITS), 0, (1 << MANTISSA_BITS) - 1).astype(np.uint16)
    out = zeros << np.uint16(MANTISSA_BITS) | mantissa
    empty = np.flatnonzero(~held)
    if len(empty):
        cache = worker_cache("probes")
        if m not in cache:
            cache[m] = np.random.default_rng(m).permuted(np.tile(np.arange(m), (m, 1)), axis=1)
        order = cache[m]
        pick = order[empty, held[order[empty, :_PROBES]].argmax(axis=1)]
        late = empty[~held[pick]]
        pick[~held[pick]] = order[late, held[order[late]].argmax(axis=1)]
        out[empty] = out[pick]
    return out


def accidental(n: np.ndarray, other: np.ndarray, m: int = REGISTERS) -> np.ndarray:
    """Chance that one register of two disjoint sets of these sizes agrees."""
    level = np.arange(64)
    at = lambda size: (np.exp(-np.outer(size / m, 2.0 ** -(level + 1)))
                       - np.exp(-np.outer(size / m, 2.0 ** -level)))
    return (at(n) * at(other)).sum(axis=1) / (1 << MANTISSA_BITS)


def estimate(same: np.ndarray, n: np.ndarray, other: np.ndarray, m: int = REGISTERS) -> np.ndarray:
    """Jaccard estimate from the number of equal registers, corrected for accidental agreement."""
    chance = accidental(n, other, m)
    return np.clip((same / m - chance) / (1 - chance), 0, 1)


def floor_of(threshold: float, m: int = REGISTERS) -> float:
    return threshold - SLACK_ERRORS * float(np.sqrt(threshold * (1 - threshold) / m))


def signatures(docs: DataFrame, k: int, m: int = REGISTERS) -> DataFrame:
    """doc_id, n_shingles, digest and registers (null for empty sets) of (doc_id, text)."""
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, TEXT_ROWS):
            n, digest, regs = [], [], []
            for text in batch.column(1).to_pylist():
                s = shingle_set(text, k)
                n.append(len(s))
                digest.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                regs.append(registers(s, m).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(digest, pa.binary()),
                                              pa.array(regs, pa.binary())], names=["doc_id", "n_shingles", "digest", "regs"])

    return docs.select("doc_id", "text").mapInArrow(sign, "doc_id long, n_shingles long, digest binary, regs binary")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint16).reshape(len(column), -1)


def _bucket_rows(classes: DataFrame, n_bands: int, width: int) -> DataFrame:
    """(bucket, band, id): one row per class and band."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                regs = _matrix(part.column(1)).astype(np.uint64)
                for band in range(n_bands):
                    with np.errstate(over="ignore"):
                        key = np.full(len(regs), np.uint64(band + 1), dtype=np.uint64)
                        for j in range(band * width, (band + 1) * width):
                            key = mix64((key + regs[:, j]) * np.uint64(0x9E3779B97F4A7C15))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key.view(np.int64)), pa.array(np.full(len(regs), band, dtype=np.int32)), part.column(0)],
                        names=["bucket", "band", "id"])

    return classes.select("id", "regs").mapInArrow(rows, "bucket long, band int, id long")


def _hot_hubs(pairs: DataFrame) -> DataFrame:
    """The ids ``a`` that stand in very many of *pairs* (a, b); every b stands in few."""
    return hot_keys(materialize(pairs.groupBy("a").agg(F.count("*").alias("size")), "hub-sizes"), "a")


def _promising(pairs: DataFrame, classes: DataFrame, threshold: float, m: int) -> DataFrame:
    """Pairs (a, b) whose estimate allows the threshold."""
    floor = floor_of(threshold, m)
    side = lambda c: classes.select(F.col("id").alias(c), F.col("n").alias(f"n_{c}"), F.col("regs").alias(f"regs_{c}"))
    sides = join_dealt(pairs, side("a"), "a", _hot_hubs(pairs), by="b").join(side("b"), "b")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            n, other = (batch.column(c).to_numpy() for c in ("n_a", "n_b"))
            same = (_matrix(batch.column("regs_a")) == _matrix(batch.column("regs_b"))).sum(axis=1)
            ok = estimate(same, n, other, m) >= floor
            ok |= np.maximum(n, other) <= ALWAYS_VERIFY
            ok &= np.minimum(n, other) >= threshold * np.maximum(n, other) - 1e-9
            yield batch.select(["a", "b"]).filter(pa.array(ok))

    return sides.select("a", "b", "n_a", "n_b", "regs_a", "regs_b").mapInArrow(keep, "a long, b long")


def verified(pairs: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * |intersection| >= percent * |union| of their full shingle sets."""
    ids = materialize(pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id")))
                      .distinct(), "pair-ids")
    texts = materialize(docs.select("doc_id", "text").join(few_or_shuffled(ids), "doc_id", "left_semi")
                        .dropDuplicates(["doc_id", "text"]), "pair-texts")
    side = lambda c: texts.select(F.col("doc_id").alias(c), F.col("text").alias(f"text_{c}"))
    both = join_dealt(pairs.join(side("b"), "b"), side("a"), "a", _hot_hubs(pairs), by="b")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, None  # after the join, rows of one document follow each other
        for batch in small_batches(batches, TEXT_ROWS):
            ok = []
            for a, b in zip(batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist()):
                if a != last:
                    last, held = a, shingle_set(a, k)
                other = shingle_set(b, k)
                inter = len(np.intersect1d(held, other, assume_unique=True))
                ok.append(100 * inter >= percent * (len(held) + len(other) - inter))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return both.select("a", "b", "text_a", "text_b").mapInArrow(check, "a long, b long")


def _full_sets(ids: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """(id, digest, hashes) of the documents named in *ids* (doc_id)."""
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, TEXT_ROWS):
            got = [shingle_set(t, k).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([xxhash.xxh3_128_digest(g) for g in got], pa.binary()), pa.array(got, pa.binary())],
                names=["id", "digest", "hashes"])

    some = docs.select("doc_id", "text").join(few_or_shuffled(ids), "doc_id", "left_semi")
    return some.mapInArrow(sets, "id long, digest binary, hashes binary").dropDuplicates(["id", "digest"])


def _across(members: DataFrame, classes: DataFrame, labels: DataFrame, docs: DataFrame, k: int, percent: int,
            n_bands: int, width: int, m: int) -> DataFrame:
    """Verified links between components in the buckets of *members* (bucket, band, id, hub, size).

    Pairs with the hub are tested already, so only buckets of three or more and
    their other members count.  A large bucket is cut into blocks and every block
    meets every other one in a task of its own; a pair that shares several
    buckets is looked at in its first band only.
    """
    threshold = percent / 100
    floor = floor_of(threshold, m)
    rest = (members.where("size > 2 and id <> hub").join(labels.withColumnRenamed("component", "c"), "id", "left")
            .withColumn("component", F.coalesce("c", "id")).drop("c", "hub"))
    mixed = materialize(rest.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"),
                                                   F.count("*").alias("rows")).where("lo < hi"), "mixed-buckets")
    rest = materialize(join_dealt(rest, mixed.select("bucket"), "bucket", hot_keys(mixed, "bucket", "rows"), by="id"), "mixed")
    ids = materialize(rest.select(F.col("id").alias("doc_id")).distinct(), "mixed-ids")
    held = classes.select("id", "digest", "n", "regs").join(_full_sets(ids, docs, k), ["id", "digest"]).drop("digest")
    with text_batches(docs.sparkSession):
        held = materialize(held, "mixed-sets")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    met = (rest.withColumn("own", F.pmod(F.xxhash64("id"), blocks).cast("int"))
           .withColumn("met", F.explode(F.sequence(F.lit(0), blocks - 1)))
           .withColumn("x", F.least("own", "met")).withColumn("y", F.greatest("own", "met")).join(held, "id"))

    def meet(table: pa.Table) -> pa.Table:
        got = []
        if table.num_rows > 1:
            x, y = table.column("x")[0].as_py(), table.column("y")[0].as_py()
            band = table.column("band")[0].as_py()
            ids, comp, n, own = (table.column(c).to_numpy() for c in ("id", "component", "n", "own"))
            regs = _matrix(table.column("regs").combine_chunks())
            sets = [np.frombuffer(h, dtype=np.uint64) for h in table.column("hashes").to_pylist()]
            left, right = np.flatnonzero(own == x), np.flatnonzero(own == y)
            values, code, counts = np.unique(comp, return_inverse=True, return_counts=True)
            main, parent = counts.argmax(), list(range(len(values)))

            def top(c: int) -> int:
                while parent[c] != c:
                    parent[c] = c = parent[parent[c]]
                return c

            # rows outside the largest component against everyone: the other pairs are joined already
            sides = [(left[code[left] != main], right)]
            if x != y:
                sides.append((right[code[right] != main], left[code[left] == main]))
            for some, others in sides:
                for at in range(0, len(some), 64):
                    part = some[at:at + 64]
                    equal = regs[part][:, None, :] == regs[others][None, :, :]
                    in_band = equal[:, :, :n_bands * width].reshape(len(part), len(others), n_bands, width).all(axis=3)
                    i, j = np.nonzero((code[part][:, None] != code[others][None, :]) & (in_band.argmax(axis=2) == band)
                                      & in_band[:, :, band])
                    a, b = part[i], others[j]
                    alike = estimate(equal.sum(axis=2)[i, j], n[a], n[b], m)
                    ok = (alike >= floor) | (np.maximum(n[a], n[b]) <= ALWAYS_VERIFY)
                    ok &= np.minimum(n[a], n[b]) >= threshold * np.maximum(n[a], n[b]) - 1e-9
                    order = np.flatnonzero(ok)[np.argsort(-alike[ok], kind="stable")]
                    for p, q in zip(a[order].tolist(), b[order].tolist()):
                        cp, cq = top(code[p]), top(code[q])
                        if cp == cq:
                            continue
                        inter = len(np.intersect1d(sets[p], sets[q], assume_unique=True))
                        if 100 * inter >= percent * (len(sets[p]) + len(sets[q]) - inter):
                            parent[cp] = cq
                            got.append((ids[p], ids[q]))
        pairs = np.array(got, dtype=np.int64).reshape(-1, 2)
        return pa.table({"a": pairs.min(axis=1, initial=2**63 - 1), "b": pairs.max(axis=1, initial=-2**63)})

    return met.select("bucket", "x", "y", "band", "id", "component", "n", "own", "regs", "hashes") \
        .groupBy("bucket", "x", "y").applyInArrow(meet, "a long, b long").distinct()


def groups(docs: DataFrame, k: int = 5, percent: int = 80, m: int = REGISTERS) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id and kept.

    Two texts are linked if 100 * |intersection| >= percent * |union| of their
    sets of distinct *k*-word shingles (see ``shingle_set``).  The component is the
    smallest id reachable over links, the own one included; ``kept`` says that the
    document is that one.  Null, empty and blank texts have the empty set and no
    links.  A null id is kept and has no component; its text links nothing.
    Repeated rows give one row each.  Other columns are ignored.
    """
    threshold = percent / 100
    n_bands, width = bands(threshold, m)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    spark = docs.sparkSession
    with text_batches(spark):
        signed = materialize(signatures(docs, k, m), "signatures")
    classes = materialize(signed.where("digest is not null and doc_id is not null").groupBy("digest")
                          .agg(F.min("doc_id").alias("id"), F.first("n_shingles").alias("n"), F.first("regs").alias("regs")),
                          "classes")
    rows = _bucket_rows(classes, n_bands, width)
    shared = materialize(rows.groupBy("bucket").agg(F.min("id").alias("hub"), F.count("*").alias("size")).where("size > 1"), "buckets")
    members = materialize(join_dealt(rows, shared, "bucket", hot_keys(shared, "bucket"), by="id"), "members")
    stars = materialize(members.where("id <> hub").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct(), "stars")
    stars = materialize(_promising(stars, classes, threshold, m), "pairs")
    checked = verified(stars, docs, k, percent)
    with text_batches(spark):
        links = materialize(checked, "links")
    labels = materialize(connected_components(links), "labels")
    across = _across(members, classes, labels, docs, k, percent, n_bands, width, m)
    with text_batches(spark):
        more = materialize(across, "links")
    if not more.isEmpty():
        labels = materialize(connected_components(links.unionByName(more)), "labels")
    by_class = classes.select("digest", "id").join(labels, "id", "left") \
        .select("digest", F.coalesce("component", "id").alias("component"))
    out = signed.select("doc_id", "n_shingles", "digest").join(by_class, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """*docs* with one document of every near-duplicate group, all columns as they are.

    Rows that repeat an id and a text count as one document; rows of one id with
    different texts are documents of their own.  Rows with a null id all stay.
    """
    number = F.col("doc_id").cast("long")
    if docs.where(number.isNotNull()).groupBy(number.alias("id")).count().where("count > 1").isEmpty():
        found = materialize(groups(docs, k, percent), "groups")
        dropped = materialize(found.where("not kept").select("doc_id").distinct(), "dropped")
        return docs.join(few_or_shuffled(dropped), "doc_id", "left_anti").select(*docs.columns)
    own = ["_id", "_text"]
    rows = docs.withColumns({"_id": number, "_text": F.coalesce(F.unhex(F.sha2(F.col("text").cast("string"), 256)), F.lit(b""))})
    texts = materialize(rows.where("_id is not null").select(*own, "text").dropDuplicates(own), "documents")
    numbers = materialize(rank_within(texts.select(*own), [], own, out="doc_id"), "numbers")  # smaller ids first
    found = groups(texts.join(numbers, own).select("doc_id", "text"), k, percent)
    dropped = materialize(found.where("not kept").select("doc_id").join(numbers, "doc_id").select(*own), "dropped")
    kept = rows.join(few_or_shuffled(dropped), own, "left_anti")
    return kept.where("_id is not null").dropDuplicates(own).unionByName(kept.where("_id is null")).select(*docs.columns)
