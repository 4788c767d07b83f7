"""Token counts as rollups maintained by signed deltas.

A change says what a document counted under a tokenizer version before and
after: inserts have no count before, deletes none after, revisions both.  A
batch of changes is summed to one signed row per (source, language, tokenizer)
and committed under its id; totals are the sum of all committed batches.

A batch's sums are written to a folder of their own, which one appended row then names: the commit.
If two writers commit one batch, both rows stand and every reader takes the same one of them (the smaller folder
name), so the batch counts once.  A batch that broke off before its commit is in a folder nobody names.
Compaction folds one snapshot of the commits into a new base (totals, and the batch ids it
holds as a table); rows of those ids no longer count, and ``vacuum`` deletes them, so the log holds what came since.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from agroframe.llm.common import small_batches
from agroframe.llm.tokens import TokenizerFile, encode_in_chunks

KEYS = ("source", "lang", "tokenizer")
DELTA = "source string, lang string, tokenizer string, docs long, tokens long"
COMMIT, BASE = "batch string, folder string", "generation long, folder string"


class Snapshot(NamedTuple):
    live: dict[str, str]  # batches since the base, and the folder that counts
    files: list[str]  # files of the commit rows read
    generation: int
    base: str | None


class Rollup:
    """Any number of writers and readers may use a store at once, but only one ``compact`` or ``vacuum`` at a time."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _read(self, name: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return self.spark.createDataFrame([], schema)

    def _snapshot(self) -> Snapshot:
        """The commits since the newest base: one row per batch since the last compaction, so few.

        Commits are read before the base: what a compaction folds in between is then left out by the base's ids.
        """
        commits = self._read("commits", COMMIT)
        if commits.inputFiles():
            commits = commits.select("batch", "folder", F.col("_metadata.file_path").alias("file"))
        rows = commits.collect()
        bases = sorted(((r.generation, r.folder) for r in self._read("bases", BASE).collect()), reverse=True)
        generation, base = bases[0] if bases else (0, None)
        live: dict[str, str] = {}
        for r in rows:
            live[r.batch] = min(r.folder, live.get(r.batch, r.folder))
        if base and live:
            asked = self.spark.createDataFrame([(b,) for b in live], "batch string")
            for r in self._ids(base).join(F.broadcast(asked), "batch", "left_semi").collect():  # no more than asked
                live.pop(r.batch, None)
        return Snapshot(live, sorted({r.file for r in rows}), generation, base)

    def _ids(self, base: str) -> DataFrame:
        return self._read(f"{base}/ids", "batch string")

    def is_committed(self, batch: str) -> bool:
        now = self._snapshot()
        return batch in now.live or bool(now.base and not self._ids(now.base).where(F.col("batch") == batch).isEmpty())

    def committed(self) -> set[str]:
        """Ids of all batches ever committed, brought to the driver; ``is_committed`` asks for one of them."""
        now = self._snapshot()
        return set(now.live) | ({r.batch for r in self._ids(now.base).collect()} if now.base else set())

    def _commit(self, rows: list[tuple]) -> None:
        self.spark.createDataFrame(rows, COMMIT).coalesce(1).write.mode("append").parquet(f"{self.path}/commits")

    def apply(self, batch: str, changes: DataFrame) -> bool:
        """Commit *changes* (source, lang, tokenizer, old_tokens, new_tokens) as *batch*; False if it is committed already.

        Each row is one document's change; null counts mean absence; null keys are
        categories of their own; rows with both counts null change nothing; an empty batch commits.
        Two writers of one batch id at once both get True; one of the two counts, so they must bring the same changes.
        """
        if self.is_committed(batch):
            return False
        old, new = F.col("old_tokens"), F.col("new_tokens")
        deltas = changes.groupBy(*KEYS).agg(
            F.sum(new.isNotNull().cast("long") - old.isNotNull().cast("long")).alias("docs"),
            F.sum(F.coalesce(new, F.lit(0)).cast("long") - F.coalesce(old, F.lit(0)).cast("long")).alias("tokens"))
        folder = f"batches/{uuid.uuid4().hex}"
        deltas.where("docs <> 0 or tokens <> 0").write.parquet(f"{self.path}/{folder}")
        self._commit([(batch, folder)])
        return True

    def _totals(self, now: Snapshot) -> DataFrame:
        folders = [f"{self.path}/{f}" for f in [*now.live.values(), *([f"{now.base}/totals"] if now.base else [])]]
        if not folders:
            return self.spark.createDataFrame([], DELTA)
        return self.spark.read.schema(DELTA).parquet(*folders).groupBy(*KEYS) \
            .agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).where("docs <> 0 or tokens <> 0")

    def totals(self) -> DataFrame:
        """docs and tokens per source, lang and tokenizer over all committed batches."""
        return self._totals(self._snapshot())

    def compact(self, name: str = "base") -> None:
        """Fold the batches of one snapshot into a new base; their ids stay committed.  *name* begins the base's folder name."""
        now, base = self._snapshot(), f"{name}-{uuid.uuid4().hex}"
        self._totals(now).write.parquet(f"{self.path}/{base}/totals")
        ids = self.spark.createDataFrame([(b,) for b in now.live], "batch string")
        (ids.unionByName(self._ids(now.base)) if now.base else ids).write.parquet(f"{self.path}/{base}/ids")
        # one appended row switches over: until it is there, totals read the old base and the batches
        self.spark.createDataFrame([(now.generation + 1, base)], BASE).coalesce(1).write.mode("append").parquet(f"{self.path}/bases")

    def vacuum(self) -> int:
        """Delete the commit rows that the newest base has folded in; returns the number of files deleted.

        Only while no ``totals`` taken before the last ``compact`` is still read.  The folders of the batches stay
        until the path's retention removes them.
        """
        now = self._snapshot()
        if not now.files:
            return 0
        rows = self.spark.read.schema(COMMIT).parquet(*now.files).select("batch", F.col("_metadata.file_path").alias("file")).collect()
        held = {r.file for r in rows if r.batch in now.live}
        paths = [self.spark._jvm.org.apache.hadoop.fs.Path(self.spark._jvm.java.net.URI(f)) for f in now.files if f not in held]
        for path in paths:
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, False)
        return len(paths)


def change(rows: DataFrame, tokenizer: str, old, new) -> DataFrame:
    """Changes of documents (source, lang) under *tokenizer*; *old* and *new* are columns or None."""
    count = lambda x: F.lit(None).cast("long") if x is None else F.col(x)
    return rows.select("source", "lang", F.lit(tokenizer).alias("tokenizer"), count(old).alias("old_tokens"),
                       count(new).alias("new_tokens"))


def revisions(before: DataFrame | None, after: DataFrame | None) -> DataFrame:
    """Changes that turn the documents of *before* into those of *after* (each: source, lang, tokenizer, tokens).

    What *before* counted is taken back and what *after* counts is added; documents in both cancel out in the sums,
    those whose text, source, lang or tokenizer changed move, so no document needs to meet its other state.  None is
    an empty state; null tokens are absent.
    """
    if before is None and after is None:
        raise ValueError("one state is needed")
    none = F.lit(None).cast("long")
    sides = [df.select("source", "lang", "tokenizer", old.alias("old_tokens"), new.alias("new_tokens"))
             for df, old, new in ((before, F.col("tokens"), none), (after, none, F.col("tokens"))) if df is not None]
    return sides[0] if len(sides) == 1 else sides[0].unionByName(sides[1])


def tokenizer_counts(docs: DataFrame, files: dict[str, TokenizerFile], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, source, lang, tokenizer and tokens: the number of ids of every whole text by each of *files* (name: file).

    A null or empty text has 0 tokens; every row counts, also where ids repeat or are null; null source and lang stay
    null; an empty table gives no rows; other columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in small_batches([batch]):
                texts = part.column(3).to_pylist()
                for name, file in files.items():
                    n = pa.array([len(ids) // 4 for ids in encode_in_chunks(file, texts)], pa.int64())
                    yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array([name] * len(texts), pa.string()), n],
                                                     names=["doc_id", "source", "lang", "tokenizer", "tokens"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                       F.col("lang").cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, source string, lang string, tokenizer string, tokens long")


def word_counts(docs: DataFrame) -> DataFrame:
    """doc_id, source, lang, a text digest, and three counts of the whole text.

    ``words``: runs without ASCII white space; ``plain``: those without an @;
    ``marks``: words and ASCII punctuation marks apart, each mark by itself.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    count = lambda pattern: F.regexp_count(text, F.lit(pattern)).cast("long")
    return docs.select(
        "doc_id", "source", "lang", F.md5(text.cast("binary")).alias("digest"),
        count(r"[^\x09-\x0D ]+").alias("words"),
        (count(r"[^\x09-\x0D ]+") - count(r"[^\x09-\x0D @]*@[^\x09-\x0D ]*")).alias("plain"),
        count(r"[^\x09-\x0D -/:-@\[-`{-~]+|[!-/:-@\[-`{-~]").alias("marks"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, lang, md5(coalesce(text, '')) AS digest,
    len(regexp_extract_all(coalesce(text, ''), '[^\x09-\x0D ]+'))
      - len(regexp_extract_all(coalesce(text, ''), '[^\x09-\x0D @]*@[^\x09-\x0D ]*')) AS plain,
    len(regexp_extract_all(coalesce(text, ''), '[^\x09-\x0D -/:-@\[-`{-~]+|[!-/:-@\[-`{-~]')) AS marks
  FROM documents),
kept AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY digest ORDER BY doc_id) = 1)
SELECT source, lang, 'words-1' AS tokenizer, count(*) AS docs, sum(plain)::BIGINT AS tokens FROM kept GROUP BY ALL
UNION ALL
SELECT source, lang, 'words-2', count(*), sum(marks)::BIGINT FROM kept GROUP BY ALL
"""
