"""Connected components by alternating star steps, without collecting links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agroframe.session import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    near = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return near.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component) for every node of *edges* (a, b); the component is its smallest id.

    Rounds go on until every node hangs on its component's smallest id; their
    number grows with the logarithm of the size.  Each round is written once,
    so a lost executor repeats one round at most.
    """
    # b < a throughout: sums alone tell whether a round has changed anything
    state = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                        .distinct(), "edges")
    mark = None
    while True:
        now = state.agg(F.count("*"), F.sum(F.hash("a", "b")), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == mark or now[0] == 0:
            break
        mark = now
        state = materialize(_small_star(_large_star(state)), "edges")
    roots = state.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return state.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots)
