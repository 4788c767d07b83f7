"""Benchmark decontamination with a distributed positional inverted index.

``write_index`` stores the postings (term, document row, position) of the training
texts as a Parquet table whose every file is ordered by term.  A document row
also has one posting without a term, at the position after its last word: it
carries the id and, by its position, the number of words.  A term is the 64-bit
hash of a word.

``phrase_places`` finds the exact places of word sequences: the list of a
sequence's rarest term is shifted by the term's offset, intersected with the
shifted list of its second rarest one, and the few places left with the lists of
all the others.  ``near_places`` finds the places of a sequence's rarest term that
have all its other terms within a distance, in any order.

Every join is on (row, position) or on a term whose list is dealt out over
several tasks, so no frequent word, common passage or long document gathers in one.
All steps are DataFrame or SQL functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agroframe.llm.common import BROADCAST_ROWS
from agroframe.session import materialize

WIDTH = 10
WIDEST = 1 << 30  # slice() to the end
SALTS = 32  # tasks over which a term's list is dealt where the other side is too large to broadcast
SEPARATORS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """A-Z lower-cased, then the maximal runs of digits, letters a-z and characters beyond ASCII; null has none."""
    text = F.coalesce(text, F.lit(""))
    plain = F.length(text) == F.octet_length(text)  # ASCII alone, where lower() touches A-Z alone
    lowered = F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.filter(F.split(lowered, SEPARATORS), lambda w: w != "")


def term_array(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def _on(rows: DataFrame, small: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """*rows* (with a column ``row``) joined with *small* (written) on *key*.

    *small* is broadcast if counted below ``BROADCAST_ROWS``; else both sides are also dealt by
    ``row`` modulo ``SALTS``, each row of *small* to all of them, so that a frequent key is in no single task.
    """
    if small.count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(small), key, how)
    salted = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("_salt", F.pmod("row", F.lit(SALTS)).cast("int")).join(salted, [key, "_salt"], how).drop("_salt")


def write_index(docs: DataFrame, vocabulary: DataFrame | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The stored index of *docs*: rows (term, row, position, doc_id).

    With a *vocabulary* (column ``term``) only its postings are kept: no other list can
    be asked for by sequences of its terms.  A null or blank text has no words; every row of
    *docs* is a document of its own, also where ids repeat or are null; other columns
    are ignored.
    """
    terms = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), term_array(F.col(text)).alias("terms"))
    end = F.lit(None).cast("bigint")
    rows = terms.select("row", F.posexplode(F.concat("terms", F.array(end))).alias("position", "term"), "doc_id")
    if vocabulary is not None:
        known = vocabulary.select("term", F.lit(True).alias("known"))
        rows = _on(rows, known, "term", "left").where("known OR term IS NULL")
    kept = rows.select("term", "row", "position", F.when(F.col("term").isNull(), F.col("doc_id")).alias("doc_id"))
    return materialize(kept.sortWithinPartitions("term"), "postings")


def documents_of(index: DataFrame) -> DataFrame:
    """row, doc_id and n_words of every indexed document."""
    return index.where("term IS NULL").select("row", "doc_id", F.col("position").cast("long").alias("n_words"))


def windows_of(items: DataFrame, width: int = WIDTH, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, terms): the windows of *width* consecutive words of every item; an item of fewer, but not none, is one."""
    terms = items.select(F.col(item_id).alias("item_id"), term_array(F.col(text)).alias("terms")).where("size(terms) > 0")
    starts = F.sequence(F.lit(0), F.greatest(F.size("terms") - width, F.lit(0)))
    cut = F.transform(starts, lambda i: F.slice("terms", i + 1, width))
    return terms.select("item_id", F.explode(cut).alias("terms"))


def plan_phrases(index: DataFrame, phrases: DataFrame) -> DataFrame:
    """*phrases* (phrase, terms) as (phrase, length, ranked): their (frequency, offset, term), rarest first.

    Phrases with a term that the index has not are left out, as they occur nowhere.
    """
    asked = materialize(phrases.select(F.explode("terms").alias("term")).distinct(), "asked")
    frequency = materialize(_on(index.select("term", "row"), asked, "term").groupBy("term").agg(F.count("*").alias("frequency")),
                            "frequency")
    places = phrases.select("phrase", F.size("terms").alias("length"), F.posexplode("terms").alias("offset", "term"))
    ranked = (places.join(frequency, "term").groupBy("phrase", "length")
              .agg(F.sort_array(F.collect_list(F.struct("frequency", "offset", "term"))).alias("ranked")))
    return materialize(ranked.where(F.size("ranked") == F.col("length")), "phrases")


def phrase_places(index: DataFrame, planned: DataFrame) -> DataFrame:
    """Every exact place of the *planned* phrases: (row, start, phrase, length), written once."""
    lists = index.where("term IS NOT NULL").select("term", "row", "position")
    least, next_least = F.get("ranked", F.lit(0)), F.get("ranked", F.lit(1))
    heads = materialize(planned.select(
        least.term.alias("term"), least.offset.alias("offset"), "phrase", "length",
        next_least.term.alias("next_term"), next_least.offset.alias("next_offset")), "rarest")
    places = _on(lists, heads, "term").select(
        "row", (F.col("position") - F.col("offset")).alias("start"), "phrase", "length", "next_term", "next_offset").where("start >= 0")
    # the second rarest list, at its own offset
    second = _on(lists, materialize(heads.select(F.col("next_term").alias("term")).dropna().distinct(), "second"), "term")
    met = (places.where("length > 1").withColumn("there", F.col("start") + F.col("next_offset"))
           .join(second.withColumnsRenamed({"position": "there", "term": "next_term"}), ["row", "there", "next_term"]))
    columns = ["row", "start", "phrase", "length"]
    both = met.select(*columns).unionByName(places.where("length = 1").select(*columns))
    others = materialize(planned.select("phrase", F.slice("ranked", 3, WIDEST).alias("others")), "others")
    alive = materialize(_on(both, others, "phrase"), "places")
    # all other lists, in the documents that are left
    needs = (alive.select("row", "start", F.explode("others").alias("o"))
             .select("row", (F.col("start") + F.col("o.offset")).alias("there"), F.col("o.term").alias("term")).distinct())
    rows = materialize(alive.select("row").distinct(), "rows")
    rows = F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows
    held = lists.withColumnRenamed("position", "there").join(rows, "row", "left_semi")
    found = needs.join(held, ["row", "there", "term"])
    checks = (alive.select("row", "start", "phrase", "length", F.explode_outer("others").alias("o"))
              .select("row", "start", "phrase", "length", (F.col("start") + F.col("o.offset")).alias("there"), F.col("o.term").alias("term"))
              .join(found.withColumn("held", F.lit(1)), ["row", "there", "term"], "left"))
    whole = checks.groupBy("row", "start", "phrase", "length").agg(F.count("held").alias("held"))
    return materialize(whole.where("held >= length - 2").drop("held"), "found")


def near_places(index: DataFrame, planned: DataFrame, distance: int) -> DataFrame:
    """(phrase, row, position, first, last): occurrences of a phrase's rarest term with every other of its terms near.

    Near is at most *distance* words away, in any order, the phrase's terms being taken as a set;
    ``first`` and ``last`` span the nearest occurrence of each (the earlier one of two equally near).
    """
    block = distance + 1
    terms = planned.select("phrase", F.explode("ranked").alias("r")).select("phrase", "r.frequency", "r.term").distinct()
    rarest = planned.select("phrase", F.col("ranked")[0].term.alias("term"))
    lists = index.where("term IS NOT NULL").select("term", "row", F.col("position").cast("long").alias("position"))
    centre = _on(lists, materialize(rarest, "rarest"), "term").select("phrase", "row", "position")
    wanted = centre.join(terms.join(rarest, ["phrase", "term"], "left_anti").select("phrase", "term"), "phrase")
    cells = F.explode(F.array(*[F.floor(F.col("position") / block) + i for i in (-1, 0, 1)]))
    wanted = wanted.withColumn("cell", cells)
    there = _on(lists, materialize(terms.select("term").distinct(), "asked"), "term") \
        .select("row", "term", F.col("position").alias("there"), F.floor(F.col("position") / block).alias("cell"))
    met = wanted.join(there, ["row", "term", "cell"]).where(F.abs(F.col("there") - F.col("position")) <= distance)
    nearest = met.groupBy("phrase", "row", "position", "term") \
        .agg(F.min(F.struct(F.abs(F.col("there") - F.col("position")).alias("far"), "there")).there.alias("there"))
    spans = nearest.groupBy("phrase", "row", "position").agg(F.count("*").alias("n"), F.min("there").alias("first"), F.max("there").alias("last"))
    sizes = terms.groupBy("phrase").agg((F.count("*") - 1).alias("others"))
    return (centre.join(sizes, "phrase").join(spans, ["phrase", "row", "position"], "left").where(F.coalesce("n", F.lit(0)) == F.col("others"))
            .select("phrase", "row", "position", F.least("first", "position").alias("first"), F.greatest("last", "position").alias("last")))


def decontaminate(docs: DataFrame, items: DataFrame, width: int = WIDTH) -> DataFrame:
    """Which words of every document lie inside a window of an item, and which items these are.

    Returns doc_id, n_words, n_hit (words inside any place of a window), n_items,
    items_sha256 (of the items' ids, sorted as strings and joined by commas) and contaminated.

    Null, empty and blank texts have no words, and such items no window.  Every row of *docs*
    is judged by itself, also where ids repeat or are null.  Items of one id count as one; a
    null item id is the empty string.  Empty tables are allowed; other columns are ignored.
    """
    windows = materialize(windows_of(items, width), "windows")
    phrases = materialize(windows.select("terms").distinct().withColumn("phrase", F.monotonically_increasing_id()), "phrases")
    owners = materialize(windows.join(phrases, "terms").select(
        "phrase", F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item")).distinct(), "owners")
    index = write_index(docs, materialize(phrases.select(F.explode("terms").alias("term")).distinct(), "vocabulary"))
    places = phrase_places(index, plan_phrases(index, phrases))
    return report(documents_of(index), places, owners)


def report(documents: DataFrame, places: DataFrame, owners: DataFrame) -> DataFrame:
    """The rows of ``decontaminate`` from the *places* of phrases and the (phrase, item) that *owners* lists."""
    end = F.col("start") + F.col("length")
    spans = places.groupBy("row", "start").agg(F.max(end).alias("end"))
    before = Window.partitionBy("row").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)  # one document's places
    covered = spans.withColumn("reached", F.greatest("start", F.coalesce(F.max("end").over(before), F.lit(0))))
    hits = covered.groupBy("row").agg(F.sum(F.greatest(F.col("end") - F.col("reached"), F.lit(0))).alias("n_hit"))
    items = _on(places.select("row", "phrase").distinct(), owners, "phrase").select("row", "item").distinct()
    listed = items.groupBy("row").agg(F.sort_array(F.collect_list("item")).alias("items"))
    joined = documents.join(hits.join(listed, "row"), "row", "left")
    n_hit = F.coalesce(F.col("n_hit").cast("long"), F.lit(0))
    ids = F.coalesce(F.array_join("items", ","), F.lit(""))
    return joined.select("doc_id", "n_words", n_hit.alias("n_hit"), F.greatest(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
                         F.sha2(ids.cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
wins AS (
  SELECT item_id, least(len(w), 10) AS k, array_to_string(w[i:i + 9], ' ') AS gram
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
toks AS (SELECT r, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS word FROM d),
next10 AS (SELECT r, p, list(word) OVER (PARTITION BY r ORDER BY p ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS g FROM toks),
grams AS (SELECT r, p, k, array_to_string(g[1:k], ' ') AS gram FROM next10, (SELECT DISTINCT k FROM wins) WHERE len(g) >= k),
found AS (SELECT DISTINCT r, p, k, item_id FROM grams JOIN wins USING (k, gram)),
hit AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + k)) AS q FROM found) GROUP BY r),
items AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
          FROM found GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN items USING (r)
"""
