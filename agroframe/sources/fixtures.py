"""Stand-in crop-health tables derived from the TPC-H-like test tables.

The reference ships no data, so each input it expects (weekly pest panel,
sensor table, image catalogue, box-label lines, class list, file listing,
long-form sensor readings, embeddings) is derived from the given tables.
The derivations are plain SQL that runs unchanged in Spark SQL and DuckDB,
so the Spark operators and the DuckDB oracle start from identical rows.
Base tables appear as ``{orders}``-style placeholders: Spark reads
``parquet.`<dir>/orders.parquet``` (a pruned, pushed-down scan), DuckDB its
pre-registered view.

Every fixture reads whole tables; modulo arithmetic only *assigns* values
(dirty tokens, splits, extensions).  The one filter on values is in the class
list, which leaves out two class ids so that the fallback for unknown ids is
exercised.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

# name -> (dependencies, SELECT text)
FIXTURES: dict[str, tuple[tuple[str, ...], str]] = {}

FIXTURES["fx_order_lines"] = ((), """
SELECT l_orderkey,
       count(*) AS n,
       sum(cast(l_quantity AS bigint)) AS q,
       sum(cast(round(l_discount * 100) AS bigint)) AS disc,
       sum(cast(round(l_tax * 100) AS bigint)) AS tax,
       sum(cast(l_linenumber AS bigint)) AS ln,
       sum(cast(floor(l_extendedprice) AS bigint)) AS px
FROM {lineitem}
GROUP BY l_orderkey
""")


def _panel_select(location_expr: str, extra_join: str) -> str:
    def wx(expr: str) -> str:
        return (f"CASE WHEN o.o_orderkey % 53 = 0 THEN '-' "
                f"ELSE cast(cast(floor({expr}) AS bigint) AS string) END")

    return f"""
SELECT o.o_orderkey AS row_id,
       o.o_orderstatus AS crop,
       {location_expr} AS location,
       o.o_orderpriority AS pest,
       cast(year(o.o_orderdate) AS int) AS year,
       cast(floor((dayofyear(o.o_orderdate) - 1) / 7) AS int) + 1 AS standard_week,
       CASE WHEN o.o_orderkey % 97 = 0 THEN '9..9'
            WHEN o.o_orderkey % 89 = 0 THEN '56.o'
            WHEN o.o_orderkey % 11 = 0 THEN NULL
            WHEN o.o_orderkey % 5 = 0 THEN '0'
            ELSE cast(cast(floor(o.o_totalprice / 1000) AS bigint) AS string) END AS pest_value,
       {wx('20 + ol.q / ol.n / 2')} AS maxt_c,
       {wx('5 + ol.q / ol.n / 3')} AS mint_c,
       {wx('10 * (ol.disc / ol.n)')} AS rh1_pct,
       {wx('12 * (ol.tax / ol.n)')} AS rh2_pct,
       {wx('ol.px / ol.n / 1000')} AS rf_mm,
       {wx('ol.ln / ol.n')} AS ws_kmph,
       {wx('ol.n')} AS ssh_hrs,
       {wx('ol.tax / ol.n')} AS evp_mm,
       concat('no.  per ', substr(o.o_orderpriority, 1, 1), '  trap ') AS unit
FROM {{orders}} o
JOIN {{customer}} c ON o.o_custkey = c.c_custkey
JOIN {{nation}} n ON c.c_nationkey = n.n_nationkey
{extra_join}
LEFT JOIN fx_order_lines ol ON o.o_orderkey = ol.l_orderkey
"""


FIXTURES["fx_panel"] = (("fx_order_lines",), _panel_select("n.n_name", ""))
FIXTURES["fx_panel_region"] = (("fx_order_lines",), _panel_select(
    "r.r_name", "JOIN {region} r ON n.n_regionkey = r.r_regionkey"))

FIXTURES["fx_sensor"] = (("fx_order_lines",), """
SELECT o.o_orderkey AS row_id,
       cast(10 + floor(ol.q / ol.n * 6) / 10 AS double) AS temperature_c,
       cast(30 + floor(7 * (ol.disc / ol.n)) AS double) AS humidity_pct,
       cast(100 + o.o_custkey % 600 AS double) AS soil_moisture_raw,
       cast(30 + floor(ol.q / ol.n * 2) AS double) AS nitrogen,
       cast(5 + floor(ol.px / ol.n / 900) AS double) AS phosphorus,
       cast(15 + floor(ol.ln / ol.n * 20) AS double) AS potassium,
       cast(o.o_orderkey % 120 AS double) AS days_planted,
       cast(o.o_orderkey % 140 AS double) / 10 AS ph,
       o.o_orderstatus AS growth_stage
FROM {orders} o
LEFT JOIN fx_order_lines ol ON o.o_orderkey = ol.l_orderkey
""")

FIXTURES["fx_images"] = ((), """
SELECT o_orderkey AS image_id,
       CASE WHEN (o_custkey + o_orderkey) % 10 < 7 THEN 'train'
            WHEN (o_custkey + o_orderkey) % 10 = 7 THEN 'valid'
            ELSE 'test' END AS split,
       concat('IMG_', cast(o_orderkey % 300 AS string), '_jpg.rf.',
              md5(cast(o_orderkey AS string)),
              CASE WHEN o_orderkey % 7 = 0 THEN '.PNG' ELSE '.jpg' END) AS file_name
FROM {orders}
""")

FIXTURES["fx_box_lines"] = ((), """
SELECT o.o_orderkey AS image_id,
       cast(row_number() OVER (PARTITION BY o.o_orderkey
            ORDER BY l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_extendedprice,
                     l.l_quantity, l.l_shipdate) AS int) AS line_no,
       CASE WHEN l.l_partkey % 101 = 0 THEN '1.5 0.5 0.5 0.2 0.2'
            ELSE concat(cast(CASE WHEN l.l_partkey % 3 = 0 THEN l.l_suppkey % 30
                                  ELSE o.o_custkey % 30 END AS string),
                        ' 0.5 0.5 0.2 0.2') END AS line
FROM {orders} o
JOIN {lineitem} l ON o.o_orderkey = l.l_orderkey
""")

# Class dimension: the class ids that occur in the box labels, minus ids 28
# and 29 (left out so that the id -> name fallback is exercised).
FIXTURES["fx_classes"] = (("fx_box_lines",), """
SELECT class_id,
       concat('crop', cast(class_id % 5 AS string), '_',
              CASE WHEN class_id % 6 = 0 THEN 'healthy'
                   ELSE concat('disease  ', cast(class_id AS string)) END) AS class_name
FROM (SELECT DISTINCT cast(split_part(line, ' ', 1) AS int) AS class_id
      FROM fx_box_lines WHERE split_part(line, ' ', 1) NOT LIKE '%.%') t
WHERE class_id < 28
""")

FIXTURES["fx_files"] = ((), """
SELECT page_id,
       concat('set', cast(page_id % 3 AS string), '/', CASE page_id % 4 WHEN 0 THEN 'train/' WHEN 1 THEN 'Valid/' ELSE '' END,
              regexp_replace(regexp_replace(url, '^[a-z]+://', ''), '[?#].*$', ''),
              '/f', cast(page_id AS string),
              CASE page_id % 6 WHEN 0 THEN '.txt' WHEN 1 THEN '.yaml' WHEN 2 THEN '.csv'
                               WHEN 3 THEN '.JPG' ELSE '.png' END) AS path
FROM {pages}
""")

FIXTURES["fx_readings"] = ((), """
SELECT event_id, ts, user_id AS device_id,
       CASE event_type WHEN 'view' THEN 'temperature_c' WHEN 'click' THEN 'humidity_pct'
                       WHEN 'signup' THEN 'nitrogen' WHEN 'error' THEN 'phosphorus'
                       WHEN 'purchase' THEN 'potassium' END AS variable,
       value
FROM {events}
""")

FIXTURES["fx_emb"] = ((), """
SELECT vec_id, embedding, label,
       CASE WHEN vec_id % 5 = 0 THEN 'valid' ELSE 'train' END AS split
FROM {embeddings}
""")

_BASE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
         "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def _closure(names) -> list[str]:
    out: list[str] = []

    def visit(n):
        if n in out:
            return
        for d in FIXTURES[n][0]:
            visit(d)
        out.append(n)

    for n in names:
        visit(n)
    return out


def cte_list(names, table_ref) -> list[str]:
    """``name AS (...)`` definitions of the fixtures *names* and their dependencies.

    *table_ref* maps a base-table name to the text used to reference it.
    """
    refs = {t: table_ref(t) for t in _BASE}
    return [f"{n} AS ({FIXTURES[n][1].format(**refs)})" for n in _closure(names)]


def with_clause(names, table_ref) -> str:
    parts = cte_list(names, table_ref)
    return "WITH " + ",\n".join(parts) + "\n" if parts else ""


def duckdb_ctes(names) -> list[str]:
    return cte_list(names, lambda t: t)


def spark_table_ref(sf_dir: str):
    root = sf_dir.rstrip("/")
    return lambda t: f"parquet.`{os.path.join(root, t + '.parquet')}`"


TASK_ROWS = 250_000  # of order lines in one task of a join and window by order
# fixture -> tables that it joins by one key, and this key
BY_KEY = {"fx_box_lines": {"orders": "o_orderkey", "lineitem": "l_orderkey"}}


def line_tasks(spark: SparkSession, sf_dir: str) -> int | None:
    """Number of tasks for the order lines by their count; None if one task's share holds them several times over.

    Adaptive execution sizes tasks by compressed bytes, and a line is few of them: 64 MB are two million
    lines, which take a gigabyte in the sorts and maps of one task.
    """
    rows = spark.read.parquet(os.path.join(sf_dir.rstrip("/"), "lineitem.parquet")).count()
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // TASK_ROWS)) if rows > 4 * TASK_ROWS else None


def dealt_table_ref(spark: SparkSession, sf_dir: str, names, tasks: int | None = None):
    """``spark_table_ref``, with the tables of ``BY_KEY`` fixtures dealt by their key to ``line_tasks`` tasks (*tasks* if given)."""
    plain = spark_table_ref(sf_dir)
    keys = {t: k for n in _closure(names) for t, k in BY_KEY.get(n, {}).items()}
    n = tasks or (line_tasks(spark, sf_dir) if keys else None)
    return lambda t: f"(SELECT /*+ REPARTITION({n}, {keys[t]}) */ * FROM {plain(t)})" if n and t in keys else plain(t)


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Spark DataFrame of fixture *name* over the tables in *sf_dir*."""
    return spark.sql(with_clause([name], dealt_table_ref(spark, sf_dir, [name])) + f"SELECT * FROM {name}")


def images_and_lines(spark: SparkSession, sf_dir: str, tasks: int) -> tuple[DataFrame, DataFrame]:
    """``fx_images`` and ``fx_box_lines``, both over tables dealt by the image's key to *tasks* tasks: their join moves no row."""
    ref = dealt_table_ref(spark, sf_dir, ["fx_box_lines"], tasks)
    images, lines = (spark.sql(with_clause([n], ref) + f"SELECT * FROM {n}") for n in ("fx_images", "fx_box_lines"))
    return images, lines
