"""Seeded, exact, skew-safe splits and samples.

Random shuffles are replaced by an md5 order of (seed, key): the same
statistics as a seeded shuffle, reproducible in any engine.  Which rows come first
in that order is found by radix selection (``operators.selection``): a few
counts and a filter, no sort, however large a class is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agroframe.functions.columns import md5_order
from agroframe.operators.ranking import join_null_safe
from agroframe.operators.selection import with_bounds
from agroframe.session import materialize


def stratified_split(df: DataFrame, label: str, key: str, test_frac: float = 0.2,
                     seed: int = 42) -> DataFrame:
    """Per label, the first rint(test_frac * n) rows in md5 order are test.

    A null label is a label.  Rows of one *key* stay together: where the cut falls among them they are train.
    """
    cut = {"_test": lambda n: F.bround(n * test_frac, 0)}
    return (with_bounds(df, [label], md5_order(seed, key), cut)
            .withColumn("split", F.when(F.col("_digest") < F.col("_test"), "test").otherwise("train"))
            .select(*df.columns, "split"))


def group_split(df: DataFrame, cls: str, group: str, row_order: str, frac: float = 0.15,
                seed: int = 42) -> DataFrame:
    """Leakage-free split of *df* by (cls, group).

    Per class with n groups: n_val = n_test = max(1, rint(frac*n)) when n >= 3
    else 0, then n_val = min(n_val, n-1), n_test = min(n_test, n-1-n_val).  In
    md5 order the first n_test groups are test, the next n_val valid, the rest
    train.  Train keeps every row of a group, valid/test keep one
    representative (the first row by *row_order*).  Groups are formed with a
    map-side ``min`` so a hot group of copies never sits in one task.  A null class
    or group is one like any other.
    """
    groups = materialize(df.groupBy(cls, group).agg(F.min(row_order).alias("_rep")), "groups")

    def sizes(n):
        k = F.when(n >= 3, F.greatest(F.lit(1), F.bround(n * frac, 0).cast("long"))).otherwise(F.lit(0).cast("long"))
        n_val = F.least(k, n - 1)
        return F.least(k, n - 1 - n_val), n_val

    cuts = {"_test": lambda n: sizes(n)[0], "_valid": lambda n: sizes(n)[0] + sizes(n)[1]}
    bounded = with_bounds(groups, [cls], md5_order(seed, cls, group), cuts)
    assigned = bounded.select(
        cls, group, "_rep",
        F.when(F.col("_digest") < F.col("_test"), "test").when(F.col("_digest") < F.col("_valid"), "valid")
        .otherwise("train").alias("_split"))
    j = join_null_safe(df, assigned, [cls, group])
    keep = (F.col("_split") == "train") | F.col(row_order).eqNullSafe(F.col("_rep"))
    return j.filter(keep).withColumn("split", F.col("_split")).drop("_split", "_rep")


def sample_n(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """Seeded sample of at most *n* rows (the sampling operator); rows of one *key* stay together."""
    chosen = with_bounds(df, [], md5_order(seed, key), {"_first": lambda total: F.least(total, F.lit(n))})
    return chosen.where("_digest < _first").select(*df.columns)
