"""Registered queries of the image-catalogue track (track C)."""

from __future__ import annotations

import io
import itertools
import zipfile

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agroframe.functions.columns import pretty_label, source_key
from agroframe.operators import catalogue as C
from agroframe.operators import splits as SP
from agroframe.plans.registry import finish, fx, query
from agroframe.session import drop_path, materialize, shared_path, shuffles_dropped
from agroframe.sources import files as FS
from agroframe.sources.fixtures import images_and_lines, line_tasks
from agroframe.sources.ranges import write_file
from agroframe.streaming.live import scratch_path

FILES = ("fx_files",)
IMGS = ("fx_images", "fx_box_lines", "fx_classes")
INT_RE = r"[+-]?[0-9]+"

KIND_SQL = ("CASE WHEN regexp_matches(lower(path), '\\.(jpg|jpeg|png|bmp|tif|tiff|webp)$') THEN 'image' "
            "WHEN suffix(lower(path), '.txt') THEN 'txt' WHEN regexp_matches(lower(path), '\\.(yaml|yml)$') "
            "THEN 'yaml' WHEN suffix(lower(path), '.csv') THEN 'csv' ELSE 'other' END")

TOK_CTE = ("tok AS (SELECT image_id, line_no, line, string_split_regex(trim(line), '\\s+')[1] AS t "
           "FROM fx_box_lines WHERE trim(line) <> '')")
MAJ_CTES = [
    TOK_CTE,
    f"per AS (SELECT image_id, cast(t AS int) AS class_id, count(*) AS n, min(line_no) AS first "
    f"FROM tok WHERE regexp_full_match(t, '{INT_RE}') GROUP BY image_id, cast(t AS int))",
    "maj AS (SELECT image_id, class_id, mixed FROM (SELECT image_id, class_id, "
    "row_number() OVER (PARTITION BY image_id ORDER BY n DESC, first) AS rn, "
    "count(*) OVER (PARTITION BY image_id) > 1 AS mixed FROM per) s WHERE rn = 1)",
]
MANIFEST_CTES = MAJ_CTES + [
    "man AS (SELECT i.split, i.image_id, concat_ws('/', i.split, 'images', i.file_name) AS path, m.class_id, "
    "coalesce(c.class_name, cast(m.class_id AS varchar)) AS class_name, "
    "split_part(coalesce(c.class_name, ''), '_', 1) AS crop, split_part(i.file_name, '.rf.', 1) AS source, "
    "m.mixed FROM fx_images i JOIN maj m ON i.image_id = m.image_id "
    "LEFT JOIN fx_classes c ON m.class_id = c.class_id)"]
SPLIT_CTES = MANIFEST_CTES + [
    "grp AS (SELECT class_name, source, min(image_id) AS rep, "
    "md5(concat_ws('|', '42', class_name, source)) AS h FROM man GROUP BY class_name, source)",
    "rk AS (SELECT *, row_number() OVER (PARTITION BY class_name ORDER BY h, source) AS r, "
    "count(*) OVER (PARTITION BY class_name) AS n FROM grp)",
    "rk2 AS (SELECT *, CASE WHEN n >= 3 THEN greatest(1, cast(round_even(n * 0.15, 0) AS bigint)) ELSE 0 END "
    "AS k FROM rk)",
    "rk3 AS (SELECT *, least(k, n - 1) AS n_val, least(k, n - 1 - least(k, n - 1)) AS n_test FROM rk2)",
    "asg AS (SELECT class_name, source, rep, CASE WHEN r <= n_test THEN 'test' WHEN r <= n_test + n_val "
    "THEN 'valid' ELSE 'train' END AS sp FROM rk3)",
    "cs AS (SELECT m.image_id, m.path, m.class_id, m.class_name, m.crop, m.source, a.sp AS split "
    "FROM man m JOIN asg a ON m.class_name = a.class_name AND m.source = a.source "
    "WHERE a.sp = 'train' OR m.image_id = a.rep)",
]


def files(spark, sf) -> DataFrame:
    return fx(spark, sf, "fx_files")


def majority(spark, sf) -> DataFrame:
    return C.majority_class(fx(spark, sf, "fx_box_lines"))


def manifest(spark, sf) -> DataFrame:
    return C.build_manifest(fx(spark, sf, "fx_images"), majority(spark, sf), fx(spark, sf, "fx_classes"))


def clean_split_df(spark, sf) -> DataFrame:
    """Group split of the manifest; the manifest is written once to the
    checkpoint folder because the split reads it twice (groups, join back)."""
    m = materialize(manifest(spark, sf), "manifest")
    return SP.group_split(m, "class_name", "source", row_order="image_id", frac=0.15, seed=42)


# ---------------------------------------------------------------- file listings
@query("file_kinds", f"SELECT {KIND_SQL} AS kind, count(*) AS n_files FROM fx_files GROUP BY 1", FILES)
def file_kinds(spark, sf):
    return C.file_counts(files(spark, sf))


def _folder_sql(depth: int, shallow: str, top: int) -> str:
    deep = f"array_to_string(string_split(path, '/')[1:{depth}], '/')"
    n = "len(string_split(path, '/'))"
    if shallow == "drop":
        f = f"CASE WHEN {n} > {depth} THEN {deep} END"
    else:
        f = f"CASE WHEN {n} > {depth} THEN {deep} ELSE array_to_string(string_split(path, '/')[1:{n} - 1], '/') END"
    return (f"SELECT folder, count(*) AS n_files FROM (SELECT {f} AS folder FROM fx_files) s "
            f"WHERE folder IS NOT NULL GROUP BY folder ORDER BY n_files DESC, folder LIMIT {top}")


@query("folder_counts", _folder_sql(2, "parent", 25), FILES)
def folder_counts(spark, sf):
    """Top 25 folders at depth 2 (shallow paths fall back to their parent)."""
    return C.folder_counts(files(spark, sf), 2, "parent", top=25)


@query("folder_counts_deep", _folder_sql(3, "drop", 30), FILES)
def folder_counts_deep(spark, sf):
    """Top 30 folders at depth 3 (shallow paths dropped)."""
    return C.folder_counts(files(spark, sf), 3, "drop", top=30)


@query("format_guess", f"SELECT n_images, n_txt, n_yaml, n_csv, n_files, CASE WHEN n_yaml > 0 OR "
       f"(n_txt > 0.3 * n_images AND n_txt > 50) THEN 'detection' ELSE 'classification' END AS format "
       f"FROM (SELECT count(*) FILTER (WHERE k = 'image') AS n_images, count(*) FILTER (WHERE k = 'txt') AS n_txt, "
       f"count(*) FILTER (WHERE k = 'yaml') AS n_yaml, count(*) FILTER (WHERE k = 'csv') AS n_csv, "
       f"count(*) AS n_files FROM (SELECT {KIND_SQL} AS k FROM fx_files) s) t", FILES)
def format_guess(spark, sf):
    return C.guess_format(files(spark, sf))


@query("format_markers", " UNION ALL ".join(
    f"SELECT '{m}' AS marker, min(path) FILTER (WHERE contains(lower(path), '{m}')) AS first_path FROM fx_files "
    f"HAVING min(path) FILTER (WHERE contains(lower(path), '{m}')) IS NOT NULL" for m in C.FORMAT_MARKERS), FILES)
def format_markers(spark, sf):
    return C.format_markers(files(spark, sf))


# ---------------------------------------------------------------- class list & labels
@query("class_list", "SELECT class_id, class_name FROM fx_classes", IMGS)
def class_list(spark, sf):
    """Class list written as a YAML file (one small row) and parsed back."""
    cl = fx(spark, sf, "fx_classes")
    text = cl.agg(F.concat(F.lit("train: ../train/images\nnc: "), F.count("*").cast("string"),
                           F.lit("\nnames: [\n  "),
                           F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("class_id", "class_name"))),
                                                    lambda s: F.concat(F.lit("'"), s["class_name"], F.lit("'"))),
                                        ",\n  "),
                           F.lit("\n]\n")).alias("text"))
    path = scratch_path(spark, "yaml")
    text.coalesce(1).write.text(path)
    return C.parse_class_list(FS.read_yaml_text(spark, path))


@query("nice_label", "SELECT class_id, upper(substr(split_part(class_name, '_', 1), 1, 1)) || "
       "lower(substr(split_part(class_name, '_', 1), 2)) AS crop, CASE WHEN d IS NULL OR d = '' OR d = 'healthy' "
       "THEN 'Healthy' ELSE d END AS disease FROM (SELECT class_id, class_name, CASE WHEN strpos(class_name, '_') > 0 "
       "THEN trim(regexp_replace(replace(substr(class_name, strpos(class_name, '_') + 1), '_', ' '), '\\s+', ' ', 'g')) "
       "END AS d FROM fx_classes) s", IMGS)
def nice_label(spark, sf):
    crop, disease = pretty_label("class_name")
    return fx(spark, sf, "fx_classes").select("class_id", crop.alias("crop"), disease.alias("disease"))


@query("source_key", "SELECT image_id, split_part(file_name, '.rf.', 1) AS source FROM fx_images", IMGS)
def source_key_q(spark, sf):
    return fx(spark, sf, "fx_images").select("image_id", source_key("file_name").alias("source"))


@query("box_lines", f"SELECT image_id, line_no, t AS token, CASE WHEN regexp_full_match(t, '{INT_RE}') "
       f"THEN cast(t AS int) END AS class_id FROM tok", IMGS, [TOK_CTE])
def box_lines(spark, sf):
    """Every non-blank label line with its first token parsed to a class id (NULL when bad)."""
    t = C.label_tokens(fx(spark, sf, "fx_box_lines"))
    return t.select("image_id", "line_no", F.col("_tok").alias("token"), "class_id")


@query("class_balance", f"SELECT cast(t AS int) AS class_id, count(DISTINCT image_id) AS n_images FROM tok "
       f"WHERE image_id NOT IN (SELECT image_id FROM tok WHERE NOT regexp_full_match(t, '{INT_RE}')) "
       f"GROUP BY cast(t AS int)", IMGS, [TOK_CTE])
def class_balance(spark, sf):
    return C.class_balance(fx(spark, sf, "fx_box_lines"))


@query("majority_class", "SELECT image_id, class_id, mixed FROM maj", IMGS, MAJ_CTES)
def majority_class(spark, sf):
    return majority(spark, sf)


@query("image_manifest", "SELECT * FROM man", IMGS, MANIFEST_CTES)
def image_manifest(spark, sf):
    return manifest(spark, sf)


ARCHIVE_IMAGES = 25_000  # images (and label files) of one written archive, which one task packs; twice as many at most


def written_archives(spark, sf, parts: int = 16) -> str:
    """The images and label files of the fixtures as zip archives, at least *parts*, in the shared folder; returns their glob.

    Images and label texts are joined where their rows were dealt by key and written small; archives are packed
    from these rows as they lie, so that names and texts pass no shuffle and none is on disk beside the archives.
    """
    parts = max(parts, -(-fx(spark, sf, "fx_images").count() // ARCHIVE_IMAGES))
    images, lines = images_and_lines(spark, sf, max(parts, line_tasks(spark, sf) or 0))
    text = (lines.groupBy("image_id")
            .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda r: r["line"]), "\n").alias("text")))
    rows = shared_path(spark, "archive-rows")
    with shuffles_dropped(spark):
        (images.join(text, "image_id", "left").select(F.spark_partition_id().alias("archive"), "split", "file_name", "text")
         .write.option("compression", "zstd").parquet(rows))
    stem = F.regexp_replace("file_name", r"\.[^.]*$", "")
    files = spark.read.parquet(rows).select(
        "archive", F.concat_ws("/", "split", F.lit("images"), "file_name").alias("picture"),
        F.concat_ws("/", "split", F.lit("labels"), F.concat(stem, F.lit(".txt"))).alias("label"),
        F.encode(F.concat("text", F.lit("\n")), "UTF-8").alias("content"))
    root, most = scratch_path(spark, "archives"), 2 * ARCHIVE_IMAGES

    def pack(batches):
        task, made = TaskContext.get().partitionId(), 0
        found = (r for pdf in batches for r in pdf.itertuples(index=False))
        for archive, own in itertools.groupby(found, lambda r: r.archive):
            while some := list(itertools.islice(own, most)):
                data = io.BytesIO()
                with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as z:
                    for r in some:
                        z.writestr(r.picture, b"")
                        if r.content is not None:  # an image without lines has no label file
                            z.writestr(r.label, bytes(r.content))
                write_file(f"{root}/set{archive}-{task}-{made}.zip", data.getvalue())
                made += 1
                yield pd.DataFrame({"entries": [len(some)]})

    files.mapInPandas(pack, "entries long").agg(F.sum("entries")).collect()
    drop_path(spark, rows)
    return f"{root}/*.zip"


@query("archive_manifest", r"SELECT split, concat_ws('/', split, regexp_replace(split_part(path, '/', 3), '\.[^.]*$', '')) AS image_id, "
       "path, class_id, class_name, crop, source, mixed FROM man", IMGS, MANIFEST_CTES)
def archive_manifest(spark, sf):
    """S5 + S6 + J7: the manifest from zip archives, read by byte ranges.

    The class list is written first: it comes from all order lines, whose shuffle would stay beside the archives,
    which go when they are read.
    """
    with shuffles_dropped(spark):
        classes = materialize(fx(spark, sf, "fx_classes"), "classes")
    glob = written_archives(spark, sf)
    found = FS.manifest_from_archives(spark, glob, classes)
    drop_path(spark, glob.rsplit("/", 1)[0])
    return found


@query("label_file_lines", "SELECT split, source, row_number() OVER (PARTITION BY split, source ORDER BY image_id, line_no)::INT AS line_no, line "
       "FROM (SELECT i.split, split_part(i.file_name, '.rf.', 1) AS source, l.* FROM fx_images i JOIN fx_box_lines l USING (image_id)) x",
       IMGS)
def label_file_lines(spark, sf):
    """Label lines written as one text file per split and source photo, read back with their line numbers."""
    rows = fx(spark, sf, "fx_images").select("image_id", "split", source_key("file_name").alias("source")) \
        .join(fx(spark, sf, "fx_box_lines"), "image_id")
    root = scratch_path(spark, "label-files")
    tasks = line_tasks(spark, sf)
    (rows.repartition(*([tasks] if tasks else []), "split", "source").sortWithinPartitions("split", "source", "image_id", "line_no")
     .select("split", "source", "line").write.partitionBy("split", "source").text(root))
    lines = FS.label_lines(spark, f"{root}/*/*/*.txt")
    part = lambda name: F.regexp_extract("path", f"/{name}=([^/]*)/", 1)
    return lines.select(part("split").alias("split"), part("source").alias("source"), "line_no", "line")


@query("split_sizes", "SELECT split, count(*) AS n_images FROM man GROUP BY split", IMGS, MANIFEST_CTES)
def split_sizes(spark, sf):
    return manifest(spark, sf).groupBy("split").agg(F.count("*").alias("n_images"))


@query("crop_counts", "SELECT crop, count(*) AS n_images FROM cs GROUP BY crop", IMGS, SPLIT_CTES)
def crop_counts(spark, sf):
    return clean_split_df(spark, sf).groupBy("crop").agg(F.count("*").alias("n_images"))


@query("rare_classes", "SELECT class_name, count(*) AS n_images FROM man WHERE split = 'train' "
       "GROUP BY class_name ORDER BY n_images, class_name LIMIT 8", IMGS, MANIFEST_CTES)
def rare_classes(spark, sf):
    return C.rare_classes(manifest(spark, sf), 8)


def _leak_sql(keys: str, src: str = "man") -> str:
    return (f"SELECT {keys}, count(DISTINCT split) AS n_splits, string_agg(DISTINCT split, ',' ORDER BY split) "
            f"AS splits FROM {src} GROUP BY {keys} HAVING count(DISTINCT split) > 1")


@query("leak_naive", _leak_sql("source"), IMGS, MANIFEST_CTES)
def leak_naive(spark, sf):
    return C.leaks(manifest(spark, sf), ["source"])


@query("leak_class_aware", _leak_sql("class_name, source"), IMGS, MANIFEST_CTES)
def leak_class_aware(spark, sf):
    return C.leaks(manifest(spark, sf), ["class_name", "source"])


@query("clean_split", "SELECT image_id, class_name, source, split FROM cs", IMGS, SPLIT_CTES)
def clean_split(spark, sf):
    return clean_split_df(spark, sf).select("image_id", "class_name", "source", "split")


@query("leak_after", f"SELECT count(*) AS n_leaks FROM ({_leak_sql('class_name, source', 'cs')}) s",
       IMGS, SPLIT_CTES)
def leak_after(spark, sf):
    return C.leaks(clean_split_df(spark, sf), ["class_name", "source"]).agg(F.count("*").alias("n_leaks"))


@query("class_index", "SELECT class_name, cast(row_number() OVER (ORDER BY class_name) - 1 AS int) AS class_index "
       "FROM (SELECT DISTINCT class_name FROM cs) s", IMGS, SPLIT_CTES)
def class_index(spark, sf):
    return C.class_index(clean_split_df(spark, sf))


@query("class_weights",
       "SELECT i.class_name, i.class_index, coalesce(f.freq, 0) AS freq, "
       "round(round(sum(coalesce(f.freq, 0)) OVER () / (count(*) OVER () * greatest(coalesce(f.freq, 0), 1)), 9), 6) "
       "AS weight FROM (SELECT class_name, cast(row_number() OVER (ORDER BY class_name) - 1 AS int) AS class_index "
       "FROM (SELECT DISTINCT class_name FROM cs) s) i LEFT JOIN (SELECT class_name, count(*) AS freq FROM cs "
       "WHERE split = 'train' GROUP BY class_name) f ON i.class_name = f.class_name", IMGS, SPLIT_CTES)
def class_weights(spark, sf):
    return finish(C.class_weights(materialize(clean_split_df(spark, sf).select("class_name", "split"))))


@query("label_sample", "SELECT image_id FROM (SELECT DISTINCT image_id FROM fx_box_lines) s "
       "ORDER BY md5(concat_ws('|', '42', cast(image_id AS varchar))), image_id LIMIT 6000", IMGS)
def label_sample(spark, sf):
    """Seeded sample of at most 6000 label files (the sampling operator)."""
    ids = fx(spark, sf, "fx_box_lines").select("image_id").distinct()
    return SP.sample_n(ids, "image_id", 6000, seed=42)


@query("label_sample_classes",
       "SELECT class_id, coalesce(class_name, '??') AS class_name, count(DISTINCT image_id) AS n_images FROM ("
       "SELECT image_id, cast(t AS int) AS class_id FROM tok WHERE image_id IN (SELECT image_id FROM ("
       "SELECT DISTINCT image_id FROM fx_box_lines) s ORDER BY md5(concat_ws('|', '42', cast(image_id AS varchar))), image_id LIMIT 6000) "
       f"AND image_id NOT IN (SELECT image_id FROM tok WHERE NOT regexp_full_match(t, '{INT_RE}'))) x "
       "LEFT JOIN fx_classes USING (class_id) GROUP BY ALL", IMGS, [TOK_CTE])
def label_sample_classes(spark, sf):
    """X4 + A22: images per named class in the sampled label files (the sampling operator); a file with a bad line counts nowhere."""
    lines = fx(spark, sf, "fx_box_lines")
    counts = C.class_balance(lines.join(label_sample(spark, sf), "image_id", "left_semi"))
    names = counts.join(fx(spark, sf, "fx_classes"), "class_id", "left")
    return names.select("class_id", F.coalesce("class_name", F.lit("??")).alias("class_name"), "n_images")


@query("leak_samples",
       "SELECT * FROM (SELECT 'source' AS key_kind, NULL AS class_name, source, splits FROM ("
       + _leak_sql("source") + ") a ORDER BY source LIMIT 10) x UNION ALL "
       "SELECT * FROM (SELECT 'class_source', class_name, source, splits FROM ("
       + _leak_sql("class_name, source") + ") b ORDER BY class_name, source LIMIT 8) y", IMGS, MANIFEST_CTES)
def leak_samples(spark, sf):
    """The first 10 leaking sources and the first 8 leaking (class, source) keys."""
    m = manifest(spark, sf)
    a = (C.leaks(m, ["source"]).orderBy("source").limit(10)
         .select(F.lit("source").alias("key_kind"), F.lit(None).cast("string").alias("class_name"),
                 "source", "splits"))
    b = (C.leaks(m, ["class_name", "source"]).orderBy("class_name", "source").limit(8)
         .select(F.lit("class_source").alias("key_kind"), "class_name", "source", "splits"))
    return a.unionByName(b)


@query("train_subsample", "SELECT image_id FROM cs WHERE split = 'train' "
       "ORDER BY md5(concat_ws('|', '42', cast(image_id AS varchar))), image_id LIMIT 1500", IMGS, SPLIT_CTES)
def train_subsample(spark, sf):
    """Seeded quick subsample of 1500 training images (the sampling operator)."""
    return SP.sample_n(clean_split_df(spark, sf).filter(F.col("split") == "train").select("image_id"),
                       "image_id", 1500, seed=42)
