"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells (source, language, topic).  Starting from the cells'
token weights, raking scales all cells of a source, then of a language, then of
a topic, so that the marginal meets its target, again and again until all
three hold.  A document's sampling probability is its cell's calibrated weight
over its natural one, scaled so that the largest is 1: the expected token mix
of the sample then meets the three targets exactly.

The corpus is read once for the cell table and once for the sample; the sweeps
run over cells.  All steps are DataFrame or SQL functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agroframe.session import materialize

DIMENSIONS = ("source", "lang", "topic")
TOLERANCE = 1e-10
MAX_SWEEPS = 60
MAX_RESIDUAL = 1e-3
TEMPER = {"source": 0.7, "lang": 0.7, "topic": 0.8}
SEED = 7


def topic_of(text: Column) -> Column:
    """A coarse topic from marks in the whole text."""
    has = lambda s: F.contains(text, F.lit(s))
    return (F.when(has("License"), "licensed").when(has("@"), "contacts").when(has(" | "), "table")
            .when(has("###") | has("%%%"), "marked").otherwise("prose"))


def token_weight(text: Column) -> Column:
    """Number of words (runs of anything but ASCII white space)."""
    return F.regexp_count(text, F.lit("[^\\x09-\\x0D ]+")).cast("long")


def described(docs: DataFrame) -> DataFrame:
    """doc_id, source, lang, topic, n_tokens; null texts are empty, null categories are ''."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", F.coalesce("source", F.lit("")).alias("source"), F.coalesce("lang", F.lit("")).alias("lang"),
                       topic_of(text).alias("topic"), token_weight(text).alias("n_tokens"))


def cell_table(described_docs: DataFrame) -> DataFrame:
    """Token mass per cell; cells without tokens have no weight to scale and are left out."""
    return described_docs.groupBy(*DIMENSIONS).agg(F.sum("n_tokens").cast("double").alias("tokens")).where("tokens > 0")


def tempered_target(cells: DataFrame, dimension: str, power: float) -> DataFrame:
    """Target shares proportional to the natural ones to a *power* below 1, which lifts small categories."""
    mass = cells.groupBy(dimension).agg(F.pow(F.sum("tokens"), F.lit(power)).alias("mass"))
    total = mass.agg(F.sum("mass").alias("total"))  # one row
    return mass.join(F.broadcast(total)).select(dimension, (F.col("mass") / F.col("total")).alias("share"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], tolerance: float = TOLERANCE,
         max_sweeps: int = MAX_SWEEPS, max_residual: float = MAX_RESIDUAL) -> DataFrame:
    """*cells* with ``weight`` (sum 1) whose marginals meet *targets* {dimension: (category, share)}.

    Shares are taken relative to those of the categories that occur; an occurring
    category without target gets weight 0.  A step scales one dimension and is written (a few
    rows per cell), so it is its own recovery point and its plan reads the cells twice, whatever the
    number of steps before it.  Sweeps end when no weight moves by more than
    *tolerance*, or after *max_sweeps*; if a marginal is off by more than *max_residual* then,
    the targets contradict each other and ``Unreachable`` is raised with that residual.
    """
    shares, state = {}, cells.withColumn("weight", F.col("tokens"))
    for d, target in targets.items():
        there = target.where("share > 0").join(cells.select(d).distinct(), d, "left_semi")
        total = there.agg(F.sum("share").alias("all"))  # one row
        shares[d] = materialize(there.join(F.broadcast(total)).select(d, (F.col("share") / F.col("all")).alias("share")), "share")
        state = state.join(shares[d].withColumnRenamed("share", f"_share_{d}"), d, "left")
    state, moved = materialize(state, "rake"), None
    for _ in range(max_sweeps):
        state = state.withColumn("_before", F.col("weight"))
        for d in shares:
            now = state.groupBy(d).agg(F.sum("weight").alias("_now"))
            factor = F.coalesce(F.try_divide(f"_share_{d}", "_now"), F.lit(0.0))
            state = materialize(state.join(now, d).withColumn("weight", F.col("weight") * factor).drop("_now"), "rake")
        moved = state.agg(F.max(F.abs(F.col("weight") - F.col("_before")))).first()[0]
        if moved is None or moved <= tolerance:
            break
    raked = state.select(*[c for c in cells.columns if c != "weight"], "weight")
    if moved is not None and (off := residual(raked, shares)) > max_residual:
        raise Unreachable(off)
    return raked


class Unreachable(ValueError):
    """No weights of the cells meet the targets; ``residual`` is the largest difference of a share."""

    def __init__(self, residual: float):
        super().__init__(f"targets cannot be met: a share is off by {residual:.4g}")
        self.residual = residual


def residual(raked: DataFrame, targets: dict[str, DataFrame]) -> float:
    """Largest difference between a target share and the one of the *raked* weights."""
    gaps, total = None, raked.agg(F.sum("weight").alias("total"))  # one row
    for d, share in targets.items():
        now = raked.groupBy(d).agg(F.sum("weight").alias("now")).join(share, d, "full").crossJoin(F.broadcast(total))
        gap = now.select(F.abs(F.coalesce("now", F.lit(0.0)) / F.col("total") - F.coalesce("share", F.lit(0.0))).alias("gap"))
        gaps = gap if gaps is None else gaps.unionByName(gap)
    return gaps.agg(F.max("gap")).first()[0] or 0.0


def probabilities(raked: DataFrame) -> DataFrame:
    """Sampling probability per cell: calibrated over natural weight, the largest being 1."""
    ratio = raked.withColumn("ratio", F.col("weight") / F.col("tokens"))
    top = ratio.agg(F.max("ratio").alias("top"))  # one row
    return ratio.join(F.broadcast(top)).select(*DIMENSIONS, F.try_divide("ratio", "top").alias("probability"))


def draw(doc_id: Column, seed: int = SEED) -> Column:
    """A number in [0, 1) fixed by the id, the same in any engine: 52 bits of an md5."""
    digest = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(f":{seed}")).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(1 << 52)


def mix(docs: DataFrame, targets: dict[str, DataFrame] | None = None, temper: dict[str, float] | None = None,
        seed: int = SEED) -> DataFrame:
    """doc_id, source, lang, topic, n_tokens, probability and sampled of every document.

    Without *targets* they are the natural shares tempered by *temper*.  A document
    whose cell holds no token at all has probability 0.  Repeated rows share one draw.  An empty table gives no rows.
    """
    rows = described(docs)
    cells = materialize(cell_table(rows), "cells")
    targets = targets or {d: tempered_target(cells, d, p) for d, p in (temper or TEMPER).items()}
    chance = materialize(probabilities(rake(cells, targets)), "chance")
    out = rows.join(chance, list(DIMENSIONS), "left")
    return out.select("doc_id", *DIMENSIONS, "n_tokens", F.coalesce("probability", F.lit(0.0)).alias("probability"),
                      F.coalesce(draw(F.col("doc_id"), seed) < F.col("probability"), F.lit(False)).alias("sampled"))


def sample(docs: DataFrame, targets: dict[str, DataFrame] | None = None, temper: dict[str, float] | None = None,
           seed: int = SEED) -> DataFrame:
    """The sampled documents with all their columns."""
    text = F.coalesce(F.col("text"), F.lit(""))
    cells = materialize(cell_table(described(docs)), "cells")
    targets = targets or {d: tempered_target(cells, d, p) for d, p in (temper or TEMPER).items()}
    chance = materialize(probabilities(rake(cells, targets)), "chance").select(
        *[F.col(d).alias(f"_cell_{d}") for d in DIMENSIONS], F.col("probability").alias("_chance"))
    tagged = docs.withColumns({"_cell_source": F.coalesce("source", F.lit("")), "_cell_lang": F.coalesce("lang", F.lit("")),
                               "_cell_topic": topic_of(text)})
    return tagged.join(chance, [f"_cell_{d}" for d in DIMENSIONS]) \
        .where(draw(F.col("doc_id"), seed) < F.col("_chance")).select(*docs.columns)


ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang,
    CASE WHEN contains(coalesce(text, ''), 'License') THEN 'licensed' WHEN contains(coalesce(text, ''), '@') THEN 'contacts'
         WHEN contains(coalesce(text, ''), ' | ') THEN 'table'
         WHEN contains(coalesce(text, ''), '###') OR contains(coalesce(text, ''), '%%%') THEN 'marked' ELSE 'prose' END AS topic,
    len(regexp_extract_all(coalesce(text, ''), '[^\x09-\x0D ]+')) AS n_tokens
  FROM documents),
cells AS (SELECT source, lang, topic, sum(n_tokens)::DOUBLE AS tokens FROM d GROUP BY ALL HAVING sum(n_tokens) > 0),
s AS (SELECT source, power(sum(tokens), 0.7) / sum(power(sum(tokens), 0.7)) OVER () AS share FROM cells GROUP BY source),
l AS (SELECT lang, power(sum(tokens), 0.7) / sum(power(sum(tokens), 0.7)) OVER () AS share FROM cells GROUP BY lang),
t AS (SELECT topic, power(sum(tokens), 0.8) / sum(power(sum(tokens), 0.8)) OVER () AS share FROM cells GROUP BY topic),
rake AS (
  SELECT 0 AS k, source, lang, topic, tokens, tokens AS weight FROM cells
  UNION ALL
  SELECT k + 1, source, lang, topic, tokens,
    CASE k % 3 WHEN 0 THEN weight * s.share / sum(weight) OVER (PARTITION BY source)
               WHEN 1 THEN weight * l.share / sum(weight) OVER (PARTITION BY lang)
               ELSE weight * t.share / sum(weight) OVER (PARTITION BY topic) END
  FROM rake JOIN s USING (source) JOIN l USING (lang) JOIN t USING (topic) WHERE k < 180),
chance AS (SELECT source, lang, topic, weight / tokens / max(weight / tokens) OVER () AS probability FROM rake WHERE k = 180)
SELECT doc_id, source, lang, topic, n_tokens, round(coalesce(probability, 0.0), 6) AS probability,
  coalesce(('0x' || substr(md5(doc_id || ':7'), 1, 13))::BIGINT / 4503599627370496.0 < probability, false) AS sampled
FROM d LEFT JOIN chance USING (source, lang, topic)
"""
