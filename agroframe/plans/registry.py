"""Registry of named queries and their DuckDB oracle SQL.

A query is ``fn(spark, sf_dir) -> DataFrame`` built from the library
operators; its oracle is independent hand-written SQL over the same fixture
views (see ``agroframe.sources.fixtures``).  Doubles are rounded at the very
end on both sides so that engines agree on printed values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agroframe.sources.fixtures import duckdb_ctes, fixture

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

DIGITS = 6


def query(name: str, oracle: str | None = None, fixtures=(), ctes=(), recursive: bool = False):
    """Register *fn* as query *name*.

    *oracle* is the final SELECT; it may use the *fixtures* views and the
    extra common table expressions *ctes* (``"name AS (...)"`` strings).
    """

    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            parts = duckdb_ctes(fixtures) + list(ctes)
            head = "WITH RECURSIVE " if recursive else "WITH "
            sql = (head + ",\n".join(parts) + "\n" if parts else "") + oracle
            ORACLES[name] = exact_rounding(sql)
        return fn

    return deco


def fx(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return fixture(spark, sf_dir, name)


def finish(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every floating column (NaN never appears: NULL is used)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            # two steps: the 9-digit rounding absorbs summation-order noise so
            # exact ties (k / 2^m values) round the same way in every engine
            out.append(F.round(F.round(F.col(f.name).cast("double"), 9), digits).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def exact_rounding(sql: str) -> str:
    """Rewrite ``round(round(E, 9), 6)`` to decimal rounding in DuckDB.

    Spark rounds a double through its decimal text (HALF_UP); DuckDB rounds
    in floating point.  Doing the second step on DECIMAL(38, 9) makes the
    two agree on the ties the 9-digit step creates.
    """
    key = "round(round("
    out, i = [], 0
    while True:
        j = sql.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        k, depth = j + len("round("), 0
        for m in range(k, len(sql)):  # find the end of the inner round(...)
            if sql[m] == "(":
                depth += 1
            elif sql[m] == ")":
                depth -= 1
                if depth == 0:
                    break
        inner = sql[k:m + 1]
        tail = sql[m + 1:m + 5]
        if tail != ", 6)":
            out.append(sql[i:j + 1])
            i = j + 1
            continue
        out.append(sql[i:j])
        out.append(f"cast(round(cast({inner} AS DECIMAL(38, 9)), 6) AS double)")
        i = m + 5
