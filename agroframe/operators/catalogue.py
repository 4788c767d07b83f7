"""Image catalogue: file listings, label lines, manifest, leakage, weights.

Per-image work (label lines) is a (image, class) aggregation combined
map-side; per-class and per-source work never gathers a group's rows into
one task: leakage is ``countDistinct(split)`` per key and the group split
ranks the (class, source) *groups*, not the images.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agroframe.functions.columns import clean_int, crop_of, file_kind, folder_key, source_key
from agroframe.operators.ranking import rank_within

# Names the format check looks for.
FORMAT_MARKERS = ("classes.txt", "data.yaml", "labels.csv", "train", "valid", "test")


def file_counts(files: DataFrame, path: str = "path") -> DataFrame:
    """Number of files per kind (image / txt / yaml / csv / other)."""
    return files.groupBy(file_kind(path).alias("kind")).agg(F.count("*").alias("n_files"))


def folder_counts(files: DataFrame, depth: int, shallow: str = "parent", path: str = "path",
                  top: int | None = None) -> DataFrame:
    """Files per folder prefix of *depth* components, largest first."""
    g = (files.select(folder_key(path, depth, shallow).alias("folder")).filter(F.col("folder").isNotNull())
         .groupBy("folder").agg(F.count("*").alias("n_files")))
    return g.orderBy(F.desc("n_files"), "folder").limit(top) if top else g


def guess_format(files: DataFrame, path: str = "path") -> DataFrame:
    """P20: detection (YOLO) if any yaml or (txt > 0.3 * images and txt > 50), else classification."""
    k = file_kind(path)
    g = files.agg(F.count_if(k == "image").alias("n_images"), F.count_if(k == "txt").alias("n_txt"),
                  F.count_if(k == "yaml").alias("n_yaml"), F.count_if(k == "csv").alias("n_csv"),
                  F.count("*").alias("n_files"))
    det = (F.col("n_yaml") > 0) | ((F.col("n_txt") > 0.3 * F.col("n_images")) & (F.col("n_txt") > 50))
    return g.withColumn("format", F.when(det, "detection").otherwise("classification"))


def format_markers(files: DataFrame, path: str = "path", markers=FORMAT_MARKERS) -> DataFrame:
    """P20: first path (in path order) containing each marker, case-insensitive."""
    p = F.lower(F.col(path))
    markers = list(markers)
    wide = files.agg(*[F.min(F.when(p.contains(m.lower()), F.col(path))).alias(f"m{i}")
                       for i, m in enumerate(markers)])
    pairs = ", ".join(f"'{m}', m{i}" for i, m in enumerate(markers))
    return (wide.selectExpr(f"stack({len(markers)}, {pairs}) AS (marker, first_path)")
            .filter(F.col("first_path").isNotNull()))


def parse_class_list(yaml_text: DataFrame, col: str = "text") -> DataFrame:
    """(class_id, class_name) from a YAML text: inline ``names: [...]``, else ``- a`` lines."""
    inline = F.regexp_extract(F.col(col), r"names:\s*\[([^\]]*)\]", 1)
    listed = F.regexp_extract_all(F.col(col), F.lit(r"(?m)^\s*-\s*(.+)$"), 1)
    items = F.when(F.col(col).rlike(r"names:\s*\["), F.split(inline, ",")).otherwise(listed)
    bare = F.regexp_replace("raw", r"^\s+|\s+$", "")
    return (yaml_text.select(F.posexplode(items).alias("class_id", "raw"))
            .select(F.col("class_id").cast("int"),
                    F.regexp_replace(bare, r"""^['"]+|['"]+$""", "").alias("class_name")))


def label_tokens(lines: DataFrame, line: str = "line") -> DataFrame:
    """First token of every non-blank label line, parsed as an int (NULL when bad)."""
    tok = F.regexp_extract(F.col(line), r"\S+", 0)
    return (lines.filter(F.col(line).rlike(r"\S"))
            .withColumns({"_tok": tok, "class_id": clean_int(tok)}))


def class_balance(lines: DataFrame, image: str = "image_id") -> DataFrame:
    """Images containing each class; a file with any bad line is dropped whole."""
    t = label_tokens(lines)
    bad = t.filter(F.col("class_id").isNull()).select(image).distinct()
    good = t.join(bad, image, "left_anti")
    return good.groupBy("class_id").agg(F.countDistinct(image).alias("n_images"))


def _counted(t: DataFrame, image: str, order: str) -> DataFrame:
    """(image, class_id, _n, _first) of each batch of rows, in the task that has them, then dealt by image.

    Spark's own partial counts go by (image, class), and by image in a second shuffle; lines of an
    image that come together are one row per class here, as they are there.
    """
    def count(batches):
        for b in batches:
            g = pa.Table.from_batches([b]).group_by([image, "class_id"], use_threads=False)
            found = g.aggregate([([], "count_all"), (order, "min")]).rename_columns({"count_all": "_n", f"{order}_min": "_first"})
            yield from found.select([image, "class_id", "_n", "_first"]).to_batches()

    f = t.schema
    schema = T.StructType([f[image], f["class_id"], T.StructField("_n", T.LongType()), T.StructField("_first", f[order].dataType)])
    return t.select(image, "class_id", order).mapInArrow(count, schema).repartition(image)


def majority_class(lines: DataFrame, image: str = "image_id", order: str = "line_no", by_image: bool = False) -> DataFrame:
    """Most frequent class per image; ties go to the class seen first.

    Bad lines are skipped one by one.  ``mixed`` = more than one class.  With *by_image*,
    for long image keys, one shuffle by image takes the place of two.
    """
    t = label_tokens(lines).filter(F.col("class_id").isNotNull())
    if by_image:
        per = _counted(t, image, order).groupBy(image, "class_id").agg(F.sum("_n").alias("_n"), F.min("_first").alias("_first"))
    else:
        per = t.groupBy(image, "class_id").agg(F.count("*").alias("_n"), F.min(order).alias("_first"))
    return per.groupBy(image).agg(
        F.max_by("class_id", F.struct(F.col("_n"), -F.col("_first"))).alias("class_id"),
        (F.count("*") > 1).alias("mixed"))


def build_manifest(images: DataFrame, majority: DataFrame, classes: DataFrame,
                   image: str = "image_id") -> DataFrame:
    """J7 + J8: images with a label -> split, path, class, crop, source.

    Images without a label (or without a valid box) drop out of the inner
    join; unknown class ids keep their id as name and an empty crop.  The
    class list is a small dimension: AQE broadcasts it after measuring it.
    """
    j = (images.join(majority, image, "inner")
         .join(classes.select("class_id", F.col("class_name").alias("_name")), "class_id", "left"))
    return j.select(
        "split", image,
        F.concat_ws("/", "split", F.lit("images"), "file_name").alias("path"),
        "class_id",
        F.coalesce(F.col("_name"), F.col("class_id").cast("string")).alias("class_name"),
        crop_of(F.coalesce(F.col("_name"), F.lit(""))).alias("crop"),
        source_key("file_name").alias("source"),
        "mixed")


def leaks(manifest: DataFrame, keys, split: str = "split") -> DataFrame:
    """Keys whose rows sit in more than one split, with the sorted split list."""
    keys = list(keys)
    return (manifest.groupBy(*keys)
            .agg(F.countDistinct(split).alias("n_splits"),
                 F.array_join(F.array_sort(F.collect_set(split)), ",").alias("splits"))
            .filter(F.col("n_splits") > 1))


def class_index(manifest: DataFrame, cls: str = "class_name") -> DataFrame:
    """Class -> dense index in sorted order; unknown ids are classes too, so the ranks are distributed."""
    return (rank_within(manifest.select(cls).distinct(), [], [cls], out="class_index")
            .withColumn("class_index", (F.col("class_index") - 1).cast("int")))


def class_weights(manifest: DataFrame, cls: str = "class_name", split: str = "split") -> DataFrame:
    """Inverse-frequency weights N / (C * max(freq, 1)) from the training rows."""
    idx = class_index(manifest, cls)
    freq = manifest.filter(F.col(split) == "train").groupBy(cls).agg(F.count("*").alias("freq"))
    t = idx.join(freq, cls, "left").na.fill(0, ["freq"])
    tot = t.agg(F.sum("freq").alias("_N"), F.count("*").alias("_C"))
    return (t.crossJoin(tot)
            .withColumn("weight", F.col("_N") / (F.col("_C") * F.greatest(F.col("freq"), F.lit(1))))
            .drop("_N", "_C"))


def rare_classes(manifest: DataFrame, n: int = 8, cls: str = "class_name") -> DataFrame:
    """The *n* training classes with the fewest images (a top-k report)."""
    return (manifest.filter(F.col("split") == "train").groupBy(cls).agg(F.count("*").alias("n_images"))
            .orderBy("n_images", cls).limit(n))
