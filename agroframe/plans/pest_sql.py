"""DuckDB oracle building blocks for the pest-panel track.

Independent SQL formulation: the dense calendar is generated with
``generate_series`` and the weather features use ROWS frames over it
(the Spark side uses RANGE frames on the sparse weekly table).
"""

from __future__ import annotations

from agroframe.operators.panel import BASE_FEATS, WEATHER

NUM_RE = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"

# Parameters used for the oracle runs (FIXTURES.md: sf0.01, nation level).
MIN_OBS_Q = 35
SPLIT_YEAR_Q = 2000
ENDEMIC_Q = 0.80
MODELABLE_Q = (30, 20, 5)


def num(col: str, bad) -> str:
    bads = ", ".join(f"'{b}'" for b in bad)
    return (f"CASE WHEN {col} IN ({bads}) THEN NULL "
            f"WHEN regexp_matches({col}, '{NUM_RE}') THEN cast(trim({col}) AS double) END")


def clean_cte(src: str = "fx_panel") -> str:
    wx = ",\n  ".join(f"{num(c, ['-'])} AS {c}" for c in WEATHER)
    return f"""clean AS (SELECT row_id, crop, location, pest, year, standard_week, unit,
  {num('pest_value', ['9..9', '56.o'])} AS pest_value,
  {wx},
  cast(year AS bigint) * 52 + standard_week - 1 AS week_id
FROM {src})"""


WX_CTE = ("wx AS (SELECT location, week_id, "
          + ", ".join(f"avg({c}) AS {c}" for c in WEATHER)
          + " FROM clean GROUP BY location, week_id)")

DENSE_CTES = [
    "bounds AS (SELECT location, min(week_id) AS lo, max(week_id) AS hi FROM wx GROUP BY location)",
    "cal AS (SELECT location, unnest(generate_series(lo, hi)) AS week_id FROM bounds)",
    "dense AS (SELECT cal.location, cal.week_id, "
    + ", ".join(f"wx.{c}" for c in WEATHER)
    + " FROM cal LEFT JOIN wx ON cal.location = wx.location AND cal.week_id = wx.week_id)",
]


def _feat_exprs() -> str:
    out = []
    for c in WEATHER:
        out.append(f"lag({c}, 1) OVER w AS {c}_lag1")
        out.append(f"CASE WHEN count({c}) OVER w4 = 4 THEN avg({c}) OVER w4 END AS {c}_roll4")
        out.append(f"lag({c}, 1) OVER w - lag({c}, 4) OVER w AS {c}_trend")
    return ",\n  ".join(out)


FEAT_CTE = f"""feat AS (SELECT location, week_id, cast(week_id % 52 + 1 AS int) AS standard_week,
  {_feat_exprs()}
FROM dense
WINDOW w AS (PARTITION BY location ORDER BY week_id),
       w4 AS (PARTITION BY location ORDER BY week_id ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING))"""

TGT_CTE = ("tgt AS (SELECT location, pest, week_id, avg(pest_value) AS pest_value "
           "FROM clean WHERE pest_value IS NOT NULL GROUP BY location, pest, week_id)")


def viable_cte(min_obs: int = MIN_OBS_Q) -> str:
    return (f"viable AS (SELECT crop, location, pest, count(*) AS n_obs FROM clean "
            f"WHERE pest_value IS NOT NULL GROUP BY crop, location, pest HAVING count(*) >= {min_obs})")


PANEL_CTE = f"""panel AS (SELECT v.crop, v.location, v.pest, t.week_id,
  cast(floor(t.week_id / 52) AS int) AS year, f.standard_week,
  {", ".join("f." + c for c in BASE_FEATS)},
  t.pest_value, ln(1 + t.pest_value) AS y
FROM viable v JOIN tgt t ON v.location = t.location AND v.pest = t.pest
JOIN feat f ON f.location = t.location AND f.week_id = t.week_id
WHERE f.maxt_c_roll4 IS NOT NULL)"""


def panel_ctes(src: str = "fx_panel", min_obs: int = MIN_OBS_Q) -> list[str]:
    return [clean_cte(src), WX_CTE, *DENSE_CTES, FEAT_CTE, TGT_CTE, viable_cte(min_obs), PANEL_CTE]


SPLIT_CTES = [
    f"tr AS (SELECT * FROM panel WHERE year < {SPLIT_YEAR_Q})",
    "clim AS (SELECT location, pest, standard_week, avg(y) AS clim, count(*) AS n_train "
    "FROM tr GROUP BY location, pest, standard_week)",
    "flat AS (SELECT avg(y) AS flat, count(*) AS n_train FROM tr)",
    "seas AS (SELECT p.*, coalesce(c.clim, f.flat) AS seas, f.flat AS flat FROM panel p "
    "LEFT JOIN clim c ON p.location = c.location AND p.pest = c.pest AND p.standard_week = c.standard_week "
    "CROSS JOIN flat f)",
    f"endem AS (SELECT location, pest, avg(CASE WHEN pest_value > 0 THEN 1 ELSE 0 END) AS train_presence, "
    f"avg(CASE WHEN pest_value > 0 THEN 1 ELSE 0 END) >= {ENDEMIC_Q} AS endemic FROM tr GROUP BY location, pest)",
    "cuts AS (SELECT location, pest, "
    "CASE WHEN count(CASE WHEN pest_value > 0 THEN 1 END) >= 8 "
    "THEN quantile_cont(CASE WHEN pest_value > 0 THEN pest_value END, 1/3) "
    "WHEN count(CASE WHEN pest_value > 0 THEN 1 END) > 0 "
    "THEN quantile_cont(CASE WHEN pest_value > 0 THEN pest_value END, 0.5) ELSE 1.0 END AS q1, "
    "CASE WHEN count(CASE WHEN pest_value > 0 THEN 1 END) >= 8 "
    "THEN quantile_cont(CASE WHEN pest_value > 0 THEN pest_value END, 2/3) "
    "WHEN count(CASE WHEN pest_value > 0 THEN 1 END) > 0 "
    "THEN quantile_cont(CASE WHEN pest_value > 0 THEN pest_value END, 0.5) ELSE 1.0 END AS q2 "
    "FROM panel GROUP BY location, pest)",
]


def band_sql(v: str) -> str:
    return (f"CASE WHEN coalesce({v} <= q1, false) THEN 0 "
            f"WHEN coalesce({v} <= q2, false) THEN 1 ELSE 2 END")
