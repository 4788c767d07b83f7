"""File sources and sinks: raw CSVs, zip archives, label texts, images.

Every reader declares its schema (no inference pass) and leaves projection
to Catalyst: e.g. the ``binaryFile`` listing never reads file bytes unless
the ``content`` column is used downstream.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agroframe.functions.columns import clean_number
from agroframe.operators.panel import WEATHER
from agroframe.operators.ranking import rank_within
from agroframe.operators.sensor import RENAME, drop_present, rename_sensor, trim_headers
from agroframe.session import materialize, shuffles_dropped
from agroframe.sources.ranges import image_header, open_file, text_lines, zip_directory, zip_entry

PANEL_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("crop", "location", "pest")]
    + [T.StructField("year", T.IntegerType()), T.StructField("standard_week", T.IntegerType()),
       T.StructField("pest_value", T.StringType())]
    + [T.StructField(c, T.StringType()) for c in WEATHER]
    + [T.StructField("unit", T.StringType())])

SENSOR_NUMERIC = [c for c in RENAME.values() if c != "growth_stage"]
# headed CSV that keeps blanks and tells empty text from NULL
CSV_EXACT = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
# Image file extensions.
IMAGE_EXTS = (".jpg", ".jpeg", ".png", ".bmp", ".tif", ".tiff", ".webp")


# ---------------------------------------------------------------- tables
def read_csv_by_name(spark: SparkSession, path: str) -> DataFrame:
    """Every column of a headed CSV as text under its header name.

    The names come from one header line; a file whose header differs makes
    the read fail instead of shifting values into other columns.
    """
    options = {"header": True, "mode": "FAILFAST", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    names = spark.read.options(**options, inferSchema=False).csv(path).columns
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return spark.read.options(**options, enforceSchema=False).schema(schema).csv(path)


def read_panel(spark: SparkSession, path: str, extra: dict[str, str] | None = None) -> DataFrame:
    """Weekly pest-weather CSV, columns found by header name in any order.

    Dirty numeric text stays text until ``clean_panel``; *extra* names more
    columns to keep and their types.
    """
    raw = read_csv_by_name(spark, path)
    raw = raw.toDF(*[c.strip() for c in raw.columns])
    keep = [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in PANEL_SCHEMA]
    return raw.select(*[F.col(c).cast(t).alias(c) for c, t in (extra or {}).items()], *keep)


def read_sensor(spark: SparkSession, path: str, drop=("ph",)) -> DataFrame:
    """S2 + P1-P3: sensor CSV with stray header spaces -> renamed, typed columns.

    Columns are read as text under their header names (no inference pass over the data),
    headers are trimmed and renamed, then known numeric columns are parsed strictly.
    """
    df = drop_present(rename_sensor(trim_headers(read_csv_by_name(spark, path))), list(drop))
    return df.withColumns({c: clean_number(c) for c in SENSOR_NUMERIC if c in df.columns})


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by=None) -> None:
    """Overwrite a table (Parquet by default, CSV with header as an option)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def write_bundle(tables: dict[str, DataFrame], root: str) -> None:
    """The forecast lookup bundle, one Parquet dimension table per entry."""
    for name, df in tables.items():
        write_table(df, f"{root.rstrip('/')}/{name}")


def read_bundle(spark: SparkSession, root: str, names) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{root.rstrip('/')}/{n}") for n in names}


def save_class_list(classes: DataFrame, path: str, fmt: str = "parquet") -> None:
    """(class_id, class_name) list, as Parquet or JSON lines."""
    write_table(classes.select("class_id", "class_name"), path, fmt)


def load_class_list(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.schema("class_id int, class_name string").format(fmt).load(path)


# ---------------------------------------------------------------- archives & label files
ENTRY_SCHEMA = "archive string, name string, size long, compressed long, offset long, method int, flags int, crc long"
PACK_BYTES = 64 << 20  # of compressed entries that one task unpacks


def archive_entries(spark: SparkSession, glob: str) -> DataFrame:
    """One row per file inside each zip archive (directories skipped), with its place there.

    Only an archive's directory is read, by byte ranges and piece by piece, so archives and
    their directories may be of any size; archives are dealt over tasks one by one.  The rows
    are written once: a plan sees how many they are, not how few archives they come from.
    """
    files = spark.read.format("binaryFile").load(glob).select("path", "length")  # the content is not read

    def entries(batches):
        for pdf in batches:
            for path, length in zip(pdf["path"], pdf["length"]):
                with open_file(path) as f:
                    found = ((path, n, size, packed, at, method, flags, crc)
                             for n, at, packed, size, method, flags, crc in zip_directory(f, int(length)) if not n.endswith("/"))
                    while rows := list(itertools.islice(found, 10_000)):
                        yield pd.DataFrame(rows, columns=names)

    names = [c.split()[0] for c in ENTRY_SCHEMA.split(", ")]
    return materialize(files.repartition(_tasks(spark), "path").mapInPandas(entries, ENTRY_SCHEMA), "entries", compression="zstd")


def _tasks(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def _packed(entries: DataFrame) -> DataFrame:
    """*entries* (of ``archive_entries``) dealt over tasks by the bytes to unpack: those of one stretch of an archive lie together, in order."""
    total = entries.agg(F.sum("compressed").alias("b"), F.count("*").alias("n")).first()
    tasks = max(1, -(-(total.b or 0) // PACK_BYTES), min(_tasks(entries.sparkSession), total.n))
    stretch = F.floor(F.col("offset") / min(PACK_BYTES, max(1, (total.b or 0) // tasks)))
    return entries.repartition(int(tasks), "archive", stretch).sortWithinPartitions("archive", "offset")


def _opened(batches):
    """(row, open file) of every entry row; an archive stays open while its rows follow each other."""
    path, f = None, None
    try:
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                if row.archive != path:
                    if f is not None:
                        f.close()
                    path, f = row.archive, open_file(row.archive)
                yield row, f
    finally:
        if f is not None:
            f.close()


def archive_contents(spark: SparkSession, glob: str, pattern: str) -> DataFrame:
    """(archive, name, content) of every entry whose name matches the regular expression *pattern*.

    Tasks get entries by compressed size and read just their byte ranges, so an archive of any
    size is unpacked by many tasks.  An entry is one value (Spark's limit of 2 GB per value); ``archive_lines`` has no such limit.
    """
    def contents(batches):
        for r, f in _opened(batches):
            data = b"".join(zip_entry(f, r.offset, r.compressed, r.method, r.flags, r.crc))
            yield pd.DataFrame({"archive": [r.archive], "name": [r.name], "content": [data]})

    wanted = archive_entries(spark, glob).where(F.col("name").rlike(pattern))
    return _packed(wanted).mapInPandas(contents, "archive string, name string, content binary")


def archive_lines(spark: SparkSession, glob: str, pattern: str, entries: DataFrame | None = None) -> DataFrame:
    """(archive, path, line_no, line) of every text entry that matches *pattern*, streamed: no entry is held whole.

    *entries* are the archives' ``archive_entries`` where they are known already.
    """
    def lines(batches):
        held = []
        for r, f in _opened(batches):
            for i, line in enumerate(text_lines(zip_entry(f, r.offset, r.compressed, r.method, r.flags, r.crc))):
                held.append((r.archive, r.name, i + 1, line))
                if len(held) >= 10_000:
                    yield pd.DataFrame(held, columns=names)
                    held = []
        yield pd.DataFrame(held, columns=names)

    names = ["archive", "path", "line_no", "line"]
    found = archive_entries(spark, glob) if entries is None else entries
    wanted = found.where(F.col("name").rlike(pattern))
    return _packed(wanted).mapInPandas(lines, "archive string, path string, line_no int, line string")


def split_lines(texts: DataFrame, path: str = "path", text: str = "text") -> DataFrame:
    """(path, line_no, line) of text values, split at \\r\\n, \\r and \\n like the line reader."""
    return (texts.select(F.col(path).alias("path"), F.posexplode(F.split(F.col(text), r"\r\n|\r|\n")).alias("_pos", "line"))
            .select("path", (F.col("_pos") + 1).cast("int").alias("line_no"), "line"))


def _labelled(lines: DataFrame) -> DataFrame:
    """Non-blank lines with the split (folder above ``labels``) and stem of their path."""
    parts = F.split("path", "/")
    return (lines.filter(F.col("line").rlike(r"\S"))
            .select("path", F.get(parts, F.size(parts) - 3).alias("split"),
                    F.regexp_replace(F.element_at(parts, -1), r"\.[^.]*$", "").alias("stem"), "line_no", "line"))


LABEL_ENTRY = r"(^|/)labels/[^/]*\.txt$"


def archive_label_lines(spark: SparkSession, glob: str, entries: DataFrame | None = None) -> DataFrame:
    """S6 on archives: the lines of every ``labels/*.txt`` entry, as ``label_lines`` gives them."""
    return _labelled(archive_lines(spark, glob, LABEL_ENTRY, entries))


SORT_BYTES = 4 << 20  # of label text that one task sorts


def label_lines(spark: SparkSession, glob: str) -> DataFrame:
    """One row per non-blank line of every label text file.

    (path, split, stem, line_no, line); ``split`` is the folder above
    ``labels``.  Lines (ended by \\n, \\r\\n or \\r) are read splittably, so a huge
    file is spread over many tasks; line numbers come from the order
    (split start in the file, position in the split), ranked per file with
    the skew-safe ``rank_within``.
    """
    size = spark.read.format("binaryFile").load(glob).agg(F.sum("length")).first()[0] or 0  # the listing; no content is read
    tasks = max(_tasks(spark), -(-size // SORT_BYTES)) if size > 4 * SORT_BYTES else None
    encoded = F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))  # a plus is no blank in a path
    raw = spark.read.text(glob).select(
        F.url_decode(encoded).alias("path"), F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_pos"), F.col("value").alias("line"))
    lines = rank_within(raw, ["path"], ["_start", "_pos"], out="line_no", tasks=tasks).withColumn(
        "line_no", F.col("line_no").cast("int"))
    return _labelled(lines)


def manifest_from_files(spark: SparkSession, root: str, yaml_path: str) -> DataFrame:
    """J7 from files: images and label files under *root* joined on (split, stem), classes from the YAML list."""
    from agroframe.operators.catalogue import build_manifest, majority_class, parse_class_list

    key = F.concat_ws("/", "split", "stem")
    images = image_files(spark, root).select(key.alias("image_id"), "split", "file_name")
    lines = label_lines(spark, f"{root.rstrip('/')}/*/labels/*.txt").select(key.alias("image_id"), "line_no", "line")
    return build_manifest(images, majority_class(lines), parse_class_list(read_yaml_text(spark, yaml_path)))


def manifest_from_archives(spark: SparkSession, glob: str, classes: DataFrame) -> DataFrame:
    """J7 from archives: image and label entries joined on (split, stem); nothing is extracted.

    The archives are read here: entries and majority classes are written, so that the shuffles of the
    label lines are not on disk beside those of the join.
    """
    from agroframe.operators.catalogue import build_manifest, majority_class

    key = F.concat_ws("/", "split", "stem")
    with shuffles_dropped(spark):
        entries = archive_entries(spark, glob)
        lines = archive_label_lines(spark, glob, entries).select(key.alias("image_id"), "line_no", "line")
        majority = materialize(majority_class(lines, by_image=True), "majority", compression="zstd")
    images = _image_paths(entries.select(F.col("name").alias("path"))).select(key.alias("image_id"), "split", "file_name")
    return build_manifest(images, majority, classes)


def read_yaml_text(spark: SparkSession, path: str) -> DataFrame:
    """The text of one small YAML file (e.g. a class list) as a one-row table."""
    return spark.read.text(path, wholetext=True).withColumnRenamed("value", "text")


# ---------------------------------------------------------------- images
def image_files(spark: SparkSession, root: str, exts=IMAGE_EXTS, with_content: bool = False) -> DataFrame:
    """Image paths under *root* (recursive), filtered by extension.

    Adds ``split`` (folder above ``images``), ``file_name`` and ``stem``.
    File bytes are read only with ``with_content=True`` (column pruning).
    """
    df = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
          .select("path", "length", "modificationTime", *(["content"] if with_content else [])))
    return _image_paths(df, exts)


def _image_paths(df: DataFrame, exts=IMAGE_EXTS) -> DataFrame:
    """Rows whose path is an image's, with ``split``, ``file_name`` and ``stem``."""
    low = F.lower("path")
    keep = F.lit(False)
    for e in exts:
        keep = keep | low.endswith(e)
    parts = F.split("path", "/")
    name = F.element_at(parts, -1)
    return (df.filter(keep)
            .withColumns({"split": F.get(parts, F.size(parts) - 3), "file_name": name,
                          "stem": F.regexp_replace(name, r"\.[^.]*$", "")}))


CV_MODES = {1: 0, 3: 16, 4: 24}  # fixed values: the image source's codes of 8-bit images by channels


def image_sizes(spark: SparkSession, root: str, per_folder: int = 5, depth_from_end: int = 2) -> DataFrame:
    """Width / height / channels of a few images per folder, from the files' headers.

    The sample is chosen on the path listing (skew-safe rank per folder, by path);
    tasks then read the first bytes of the chosen files.  Files without a JPEG, PNG, BMP or GIF header are left out.
    """
    files = image_files(spark, root).withColumn(
        "folder", F.array_join(F.slice(F.split("path", "/"), 1, F.size(F.split("path", "/")) - depth_from_end + 1), "/"))
    ranked = rank_within(files.select("folder", "path", "length"), ["folder"], ["path"], out="_r")

    def sizes(batches):
        for pdf in batches:
            rows = []
            for path, length in zip(pdf["path"], pdf["length"]):
                with open_file(path) as f:
                    found = image_header(f, int(length))
                if found:
                    rows.append((path, *found, CV_MODES.get(found[2])))
            yield pd.DataFrame(rows, columns=["path", "width", "height", "channels", "mode"]).astype({"mode": "Int32"})

    chosen = ranked.filter(F.col("_r") <= per_folder).select("path", "length")
    return chosen.repartition(_tasks(spark), "path").mapInPandas(sizes, "path string, width int, height int, channels int, mode int")


def embed_images(files: DataFrame, fn, dim: int, key: str = "path") -> DataFrame:
    """M7: run a user batch function ``fn(list[bytes]) -> (n, dim) array`` over image bytes.

    Runs per Arrow batch in ``mapInPandas`` (the model is loaded once per
    worker by *fn*'s own caching); output is ``array<float>``.
    """
    def run(batches):
        for pdf in batches:
            if len(pdf) == 0:
                continue
            out = np.asarray(fn(list(pdf["content"])), dtype=np.float32)
            if out.shape != (len(pdf), dim):
                raise ValueError(f"embedding function returned {out.shape}, expected {(len(pdf), dim)}")
            yield pd.DataFrame({key: pdf[key], "embedding": list(out)})

    return files.select(key, "content").mapInPandas(run, f"{key} string, embedding array<float>")
