"""Exact selection by radix: the first k rows of every group in md5 order, without sorting.

The order key is a hex digest.  Rows are counted by the digest's first three
digits per group (map-side, at most 4,096 counts a group); the running count tells in which of
these buckets the k-th row lies.  Only that bucket is counted again, by the
next three digits, until a bucket ends exactly at the cut.  What is left is one text bound per
group: the chosen rows are those whose digest is below it, a plain filter.  No
row is sorted, exchanged or written.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agroframe.operators.ranking import join_null_safe
from agroframe.session import materialize

DIGITS, STEP = 32, 3       # of an md5 in hex; digits looked at per pass
BROADCAST_ROWS = 1_000_000  # bounds (one a group); more groups are joined by a shuffle
BEYOND = "g"                # above every hex digit: a prefix and this bound everything that starts with it


def bounds(rows: DataFrame, keys: list[str], digest: str, cuts: dict[str, object]) -> DataFrame:
    """One row per group of *keys*: its size ``n`` and, per name in *cuts*, the digest bound of its cut.

    ``cuts[name]`` maps the Column ``n`` to the number k of rows wanted (between 0 and n); exactly those
    with ``digest < bound`` are the k first.  Rows of one digest cannot be parted: where the k-th lies
    among them, none of them is chosen, so that there are then fewer than k.  Null keys form a group.
    """
    digit = lambda at: F.substring(F.col(digest), at + 1, STEP)
    counts = materialize(rows.groupBy(*keys, digit(0).alias("_digits")).agg(F.count("*").alias("_c")), "digits")
    sizes = counts.groupBy(*keys).agg(F.sum("_c").alias("n"))
    wanted = F.explode(F.array(*[F.struct(F.lit(name).alias("_cut"), k(F.col("n")).cast("long").alias("_k"))
                                 for name, k in cuts.items()]))
    opened = sizes.select(*keys, "n", wanted.alias("_w")).select(*keys, "n", "_w._cut", "_w._k", F.lit("").alias("_prefix"))
    opened = materialize(opened, "cuts")
    counts = counts.withColumn("_prefix", F.lit(""))
    none = opened.where("_k <= 0").select(*keys, "n", "_cut", F.lit("").alias("_bound"))
    closed, opened = [none], opened.where("_k > 0")
    for depth in range(0, DIGITS, STEP):
        w = Window.partitionBy(*keys, "_prefix").orderBy("_digits").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        upto = counts.withColumn("_upto", F.sum("_c").over(w))
        at = join_null_safe(opened, upto, [*keys, "_prefix"]).where("_k <= _upto AND _k > _upto - _c") \
            .withColumn("_prefix", F.concat("_prefix", "_digits"))
        at = materialize(at.withColumn("_k", F.col("_k") - F.col("_upto") + F.col("_c")).select(*opened.columns, "_c"), "cuts")
        closed.append(at.where("_k = _c").select(*keys, "n", "_cut", F.concat("_prefix", F.lit(BEYOND)).alias("_bound")))
        opened = at.where("_k < _c").drop("_c")
        left = opened.select(*keys, "_prefix").distinct()
        few = left.count()
        if not few:
            break
        if depth + STEP >= DIGITS:  # rows of one digest
            closed.append(opened.select(*keys, "n", "_cut", F.col("_prefix").alias("_bound")))
            break
        inner = rows.select(*keys, digest).withColumn("_prefix", F.substring(F.col(digest), 1, depth + STEP))
        inner = join_null_safe(inner, F.broadcast(left) if few <= BROADCAST_ROWS else left, [*keys, "_prefix"])
        counts = materialize(inner.groupBy(*keys, "_prefix", digit(depth + STEP).alias("_digits")).agg(F.count("*").alias("_c")),
                             "digits")
    found = reduce(DataFrame.unionByName, closed)
    return materialize(found.groupBy(*keys, "n").agg(*[F.max(F.when(F.col("_cut") == c, F.col("_bound"))).alias(c) for c in cuts]),
                       "bounds")


def with_bounds(rows: DataFrame, keys: list[str], digest: Column, cuts: dict[str, object]) -> DataFrame:
    """*rows* with their group's ``n`` and the bounds of *cuts*; the digests are in ``_digest``."""
    tagged = rows.withColumn("_digest", digest)
    found = bounds(tagged.select(*keys, "_digest"), keys, "_digest", cuts)
    if not keys:
        return tagged.crossJoin(F.broadcast(found))  # one row
    return join_null_safe(tagged, F.broadcast(found) if found.count() <= BROADCAST_ROWS else found, keys)
