"""Document fingerprints: bottom-k sketches of shingle hashes.

The sketch of a text is the k smallest distinct 64-bit hashes of its word
shingles, as a sorted array<long>.  The bottom k of a union of sketches is the
sketch of the union of the sets, so sketches merge across parts.  From sketches
alone come the resemblance and containment of two sets and the number of
distinct shingles; all are exact while the sets have fewer than k shingles, and with the flag ``complete``
(no shingle is left out) also at k.

Everything here is a Column expression or a DataFrame of built-in functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agroframe.session import materialize

K = 256
SHINGLE = 5
_SPACE = " \t\n\x0b\f\r"
ROWS_PER_BLOCK, MAX_BLOCKS = 1024, 1 << 20
LOWEST = -(1 << 63)


def _with(value: Column, use) -> Column:
    """``use(value)`` with *value* computed once, however often it is mentioned."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def word_hashes(text: Column) -> Column:
    """Hashes of the lower-cased words (split at ASCII white space); empty for blank text."""
    bare = F.btrim(F.lower(text), F.lit(_SPACE))
    return F.when(bare == "", F.array().cast("array<bigint>")).otherwise(
        F.transform(F.split(bare, "[\\x09-\\x0D ]+"), lambda w: F.xxhash64(w)))


def shingle_hashes(hashes: Column, width: int = SHINGLE) -> Column:
    """Hashes of the word *width*-shingles; fewer words make one shingle of all, none make none."""
    # beyond the end get() is null, and hashing passes over nulls
    return _with(hashes, lambda h: F.when(F.size(h) == 0, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.greatest(F.size(h) - width, F.lit(0))),
                    lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(width)]))))


def fingerprint(text: Column, k: int = K, width: int = SHINGLE) -> Column:
    """Struct of the bottom-k ``sketch`` of *text* and whether it is ``complete``; null is the empty text, whose sketch is empty."""
    found = F.array_distinct(shingle_hashes(word_hashes(F.coalesce(text, F.lit(""))), width))
    return _with(found, lambda x: F.struct(F.slice(F.sort_array(x), 1, k).alias("sketch"), (F.size(x) <= k).alias("complete")))


def sketch(text: Column, k: int = K, width: int = SHINGLE) -> Column:
    """Bottom-k sketch of *text*; null is the empty text, whose sketch is empty."""
    return fingerprint(text, k, width)["sketch"]


def merge(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the union of two sets."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merge_all(sketches: DataFrame, keys: list[str], column: str = "sketch", k: int = K) -> DataFrame:
    """One sketch per group of *keys*, over all its rows' sets; a group of empty sets has an empty one, null keys are a group.

    Grouping is by hash first, so that no group's sketches are gathered: a
    group's k smallest distinct hashes are ranked from rows (key, hash), of which
    each task sends on at most k per group.
    """
    hashes = sketches.select(*keys, F.explode_outer(column).alias("_h")).distinct()
    order = Window.partitionBy(*keys).orderBy(F.asc_nulls_last("_h"))
    least = hashes.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= k)
    return least.groupBy(*keys).agg(F.sort_array(F.collect_list("_h")).alias(column))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard resemblance (0 to 1); two empty sets are alike (1)."""
    return _with(merge(a, b, k), lambda u: F.when(F.size(u) == 0, F.lit(1.0)).otherwise(
        F.size(F.array_intersect(F.array_intersect(u, a), b)) / F.size(u)))


def distinct(a: Column, k: int = K, complete: Column | None = None) -> Column:
    """Estimated number of distinct shingles: exact below k and for a *complete* sketch, else from the k-th smallest hash."""
    share = (F.element_at(a, -1).cast("double") - float(LOWEST)) / float(1 << 64)
    exact = F.size(a) < k if complete is None else (F.size(a) < k) | complete
    return F.when(exact, F.size(a).cast("double")).otherwise((k - 1) / share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that are in b too (1 for an empty a)."""
    both = resemblance(a, b, k) * distinct(merge(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), both / distinct(a, k)))


def as_text(a: Column) -> Column:
    """A sketch as a string: base64 of its hashes, eight bytes each."""
    return F.translate(F.base64(F.unhex(F.array_join(F.transform(a, lambda x: F.lpad(F.hex(x), 16, "0")), ""))), "\r\n", "")


def fingerprints(docs: DataFrame, k: int = K, width: int = SHINGLE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, sketch, complete and n_distinct of every row."""
    return docs.select(F.col(doc_id).alias("doc_id"), fingerprint(F.col(text), k, width).alias("f")).select("doc_id", "f.*") \
        .withColumn("n_distinct", distinct(F.col("sketch"), k, F.col("complete")))


def _place(key: Column, text: Column) -> Column:
    """What documents are ordered by: id (null last when descending), then the text's hash."""
    return F.struct(F.coalesce(key.cast("long"), F.lit(LOWEST)).alias("key"), F.xxhash64(text).alias("h"))


def _block_of(place: Column, heads: Column, lows: Column, step: Column) -> Column:
    """Number of the block of *place* among the ascending first places *lows*: first by every *step*-th (*heads*), then within."""
    run = F.greatest(F.size(F.filter(heads, lambda x: x <= place)) - 1, F.lit(0))
    inner = F.size(F.filter(F.slice(lows, run * step + 1, step), lambda x: x <= place))
    return F.greatest(run * step + inner - 1, F.lit(0))


def with_next(docs: DataFrame, rows_per_block: int = ROWS_PER_BLOCK) -> tuple[DataFrame, Window]:
    """Rows (doc_id, text, guest, ...) in blocks of descending ids, and the window that runs over a block.

    The documents are cut into blocks of consecutive places (id, then hash of the text, so that many rows of one id, or without, are
    cut too); the first document of each
    block also visits the block before it (that of the lowest ids gets the
    very first one), so the next document of every row is in its own block and
    no window spans the table.  Rows with ``guest`` are visits.  The blocks' first places are a table of
    one row per block, which the documents meet as one broadcast row of at most ``MAX_BLOCKS`` places.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("place", _place(F.col("doc_id"), F.col("text")))
    blocks = min(MAX_BLOCKS, max(1, docs.count() // rows_per_block))
    ranges = docs.select("place").repartitionByRange(blocks, "place").groupBy(F.spark_partition_id().alias("p")) \
        .agg(F.min("place").alias("low"), F.max("place").alias("high"))
    ranges = materialize(ranges, "ranges")  # a row per block
    lows = F.sort_array(F.collect_list("low"))
    step = F.ceil(F.sqrt(F.size("lows"))).cast("int")
    bounds = ranges.agg(lows.alias("lows")).select("lows", F.greatest(step, F.lit(1)).alias("step")) \
        .select("*", F.filter("lows", lambda x, i: i % F.col("step") == 0).alias("heads"))
    # the last document of a block (the first in descending order) visits the next block
    visits = ranges.crossJoin(F.broadcast(bounds)).select(
        F.col("high").alias("place"), F.pmod(_block_of(F.col("high"), F.col("heads"), F.col("lows"), F.col("step")) + 1, F.size("lows")).alias("visit"))
    dealt = (docs.crossJoin(F.broadcast(bounds)).withColumn("block", _block_of(F.col("place"), F.col("heads"), F.col("lows"), F.col("step")))
             .drop("heads", "lows", "step").join(F.broadcast(visits), "place", "left")
             .withColumn("visit", F.explode(F.when(F.col("visit").isNull(), F.array("block"))
                                            .otherwise(F.array(F.col("block"), -1 - F.col("visit")))))
             .withColumn("guest", F.col("visit") < 0)
             .withColumn("block", F.when(F.col("guest"), -1 - F.col("visit")).otherwise(F.col("block"))).drop("visit"))
    window = Window.partitionBy("block").orderBy("guest", F.desc("place"))
    return dealt, window


def edited_pairs(docs: DataFrame, k: int = K, width: int = SHINGLE) -> DataFrame:
    """Every document's fingerprint beside that of its edited text and its likeness to the next document's.

    The edited text has the last floor(n_chars / 2) code points replaced by the first
    as many (or all) of the next document in descending doc_id; after the last
    comes the first, which may be the document itself.  Null texts are empty; null ids
    come last; rows with equal ids, or none, follow an order of their texts' hashes; other
    columns are ignored; an empty table gives no rows.
    """
    dealt, window = with_next(docs)
    half = F.floor(F.col("n_chars") / 2).cast("int")
    rows = (dealt.withColumn("next_text", F.lead("text").over(window))
            .withColumn("f", fingerprint(F.col("text"), k, width)).select("*", "f.*").drop("f")
            .withColumn("next_sketch", F.lead("sketch").over(window))
            .where("not guest")
            .withColumn("n_chars", F.length("text").cast("long"))
            .withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - half),
                                           F.substring(F.col("next_text"), F.lit(1), half)))
            .withColumn("edited_sketch", sketch(F.col("edited"), k, width)))
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"), as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch"), k).alias("near_next"),
        distinct(F.col("sketch"), k, F.col("complete")).alias("n_distinct"))
