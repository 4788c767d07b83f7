"""Exact ranks and quantiles that stay balanced under skewed keys.

``Window.partitionBy(key).orderBy(...)`` sends every row of a key to one
task, which is fine for groups bounded by the calendar (a series has at most
one row per week) but not for a label that holds half of all rows.  For
those cases the rank is computed as:

1. one global range-partitioned sort on (key, order): Spark samples range
   bounds, so a hot key is split over many partitions;
2. a position inside each partition (``monotonically_increasing_id`` is
   consecutive within a partition of sorted rows); the tagged rows are
   written once to the shared checkpoint folder so every later read sees
   the same ids (and a lost executor cannot renumber them);
3. a tiny table of per-(partition, key) counts gives each partition's
   offset inside its key; joined back, offset + local position = rank.

No task ever holds more than one range partition, and only
(#partitions + #keys) rows of bookkeeping are aggregated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agroframe.session import materialize


def join_null_safe(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join on equal columns *on*, where null equals null (a null key is a group like any other)."""
    right = right.withColumnsRenamed({c: f"_r_{c}" for c in on})
    same = F.lit(True)
    for c in on:
        same = same & left[c].eqNullSafe(right[f"_r_{c}"])
    return left.join(right, same, how).drop(*[f"_r_{c}" for c in on])


def rank_within(df: DataFrame, keys, order, out: str = "rank", size: str | None = None, tasks: int | None = None) -> DataFrame:
    """Add the 1-based rank of each row inside its *keys* group by *order*.

    *order* (columns or Column expressions, ascending unless given as
    ``Column.desc()``) must be a total order inside a key for the ranks to
    be deterministic.  ``size`` names an optional column with the group size.
    Rows with a null key are a group of their own.  The sort has *tasks* tasks if
    given (for rows of few bytes, which adaptive execution would pack by the million).
    """
    keys = list(keys)
    order = list(order)
    ordered = (df.repartitionByRange(tasks, *keys, *order).sortWithinPartitions(*keys, *order) if tasks and (keys or order)
               else df.orderBy(*keys, *order))
    tagged = materialize(ordered
                         .withColumn("_rk_pid", F.spark_partition_id())
                         .withColumn("_rk_mid", F.monotonically_increasing_id()), "ranked")
    per_part = tagged.groupBy(*keys, "_rk_pid").agg(F.min("_rk_mid").alias("_rk_first"),
                                                   F.count("*").alias("_rk_cnt"))
    w = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    before = w.orderBy("_rk_pid").rowsBetween(Window.unboundedPreceding, -1)
    per_part = per_part.withColumn("_rk_off", F.coalesce(F.sum("_rk_cnt").over(before), F.lit(0)))
    if size:
        per_part = per_part.withColumn(size, F.sum("_rk_cnt").over(w))
    keep = [*keys, "_rk_pid", "_rk_first", "_rk_off"] + ([size] if size else [])
    ranked = join_null_safe(tagged, per_part.select(*keep), [*keys, "_rk_pid"])
    ranked = ranked.withColumn(out, (F.col("_rk_off") + F.col("_rk_mid") - F.col("_rk_first") + 1)
                               .cast("long"))
    return ranked.drop("_rk_pid", "_rk_mid", "_rk_first", "_rk_off")


def exact_quantiles(df: DataFrame, value: str, probs, keys=(), names=None) -> DataFrame:
    """Exact linear-interpolation quantiles (pandas / ``percentile`` semantics).

    Rows with NULL *value* are ignored; a null key is a group.  One output row per key with one
    column per probability (``names`` or ``q<i>``) plus ``n``.
    """
    # equal values are counted before the sort (map-side too), so a value that
    # holds most rows is a single row of the sorted table
    counted = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_c"))
    return quantiles_of_counts(counted, value, probs, keys, names)


def quantiles_of_counts(counted: DataFrame, value: str, probs, keys=(), names=None, known: str | None = None) -> DataFrame:
    """``exact_quantiles`` of rows (keys, *value*, ``_c``) that stand for ``_c`` equal values each.

    Rows whose column *known* is false stand for values below *value* that are only counted; a quantile that falls on them is null.
    """
    keys = list(keys)
    probs = list(probs)
    names = list(names or [f"q{i}" for i in range(len(probs))])
    order = [value, known] if known else [value]
    tagged = materialize(counted.orderBy(*keys, *order).withColumn("_rk_pid", F.spark_partition_id()), "counted")
    w = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    before = w.orderBy("_rk_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (tagged.groupBy(*keys, "_rk_pid").agg(F.sum("_c").alias("_s"))
               .withColumn("_off", F.coalesce(F.sum("_s").over(before), F.lit(0)))
               .withColumn("_n", F.sum("_s").over(w)).drop("_s"))
    run = Window.partitionBy(*keys, "_rk_pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    ranked = (join_null_safe(tagged, offsets, [*keys, "_rk_pid"])
              .withColumn("_r", F.col("_off") + F.sum("_c").over(run)))  # rows up to and with this value
    pos = {}
    for nm, p in zip(names, probs):
        h = (F.col("_n") - 1) * F.lit(float(p))
        pos[nm] = (F.floor(h) + 1, F.ceil(h) + 1, h - F.floor(h))
    holds = lambda at: (F.col("_r") >= at) & (F.col("_r") - F.col("_c") < at)
    need: Column = F.lit(False)
    for lo, hi, _ in pos.values():
        need = need | holds(lo) | holds(hi)
    picked = ranked.filter(need)
    shown = F.when(F.col(known), F.col(value)) if known else F.col(value)
    aggs = [F.max("_n").alias("n")]
    for nm, (lo, hi, frac) in pos.items():
        aggs += [F.max(F.when(holds(lo), shown)).alias(f"_{nm}_lo"),
                 F.max(F.when(holds(hi), shown)).alias(f"_{nm}_hi"),
                 F.max(frac).alias(f"_{nm}_f")]
    g = picked.groupBy(*keys).agg(*aggs) if keys else picked.agg(*aggs)
    return g.select(*keys, "n", *[
        (F.col(f"_{nm}_lo") + F.col(f"_{nm}_f") * (F.col(f"_{nm}_hi") - F.col(f"_{nm}_lo"))).alias(nm)
        for nm in names])
