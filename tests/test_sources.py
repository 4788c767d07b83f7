"""File sources and sinks on files written to a fresh temporary folder."""

import os
import struct
import zipfile
import zlib

import numpy as np
import pytest
from pyspark.ml import PipelineModel

from agroframe.operators import catalogue as C
from agroframe.operators import panel as P
from agroframe.sources import files as FS


def _png(w: int, h: int, rgb) -> bytes:
    raw = b"".join(b"\x00" + bytes(rgb) * w for _ in range(h))

    def chunk(tag, data):
        return struct.pack(">I", len(data)) + tag + data + struct.pack(">I", zlib.crc32(tag + data) & 0xFFFFFFFF)

    return (b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0))
            + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))


def _catalogue(root):
    for split in ("train", "valid"):
        os.makedirs(f"{root}/{split}/images", exist_ok=True)
        os.makedirs(f"{root}/{split}/labels", exist_ok=True)
    files = {"train/images/a_jpg.rf.1.png": (4, 3, (255, 0, 0)), "train/images/b_jpg.rf.2.PNG": (2, 2, (0, 255, 0)),
             "valid/images/a_jpg.rf.3.png": (5, 1, (0, 0, 255))}
    for p, (w, h, c) in files.items():
        with open(f"{root}/{p}", "wb") as f:
            f.write(_png(w, h, c))
    with open(f"{root}/train/labels/a_jpg.rf.1.txt", "w") as f:
        f.write("2 0.5 0.5 0.1 0.1\n3 0.1 0.1 0.1 0.1\n\n2 0 0 0 0\n")
    with open(f"{root}/valid/labels/a_jpg.rf.3.txt", "w") as f:
        f.write("x 1 1 1 1\n1 0 0 0 0\n")
    with open(f"{root}/data.yaml", "w") as f:
        f.write("train: ../train/images\nnc: 4\nnames: ['crop_healthy', 'crop_blight', \"crop_rust\", 'crop_x']\n")
    return files


def test_csv_readers(spark, tmpdir_path):
    p = f"{tmpdir_path}/panel.csv"
    with open(p, "w") as f:
        f.write("crop,location,pest,year,standard_week,pest_value," + ",".join(P.WEATHER) + ",unit\n")
        f.write("Rice,X,Borer,2001,5,9..9," + ",".join(["30"] * 8) + ",no.  per trap\n")
        f.write("Rice,X,Borer,2001,6,12," + ",".join(["-"] + ["30"] * 7) + ",no. per trap\n")
    c = P.clean_panel(FS.read_panel(spark, p)).orderBy("standard_week").collect()
    assert c[0].pest_value is None and c[1].pest_value == 12.0 and c[1].maxt_c is None
    assert c[1].week_id == 2001 * 52 + 5
    s = f"{tmpdir_path}/sensor.csv"
    with open(s, "w") as f:
        f.write(" Temperature [_ C] ,Humidity [%], pH ,Crop Coefficient stage\n20.5,60,7.1,Mid\n1d,NaN,7,Late\n")
    rows = FS.read_sensor(spark, s).collect()
    assert set(rows[0].asDict()) == {"temperature_c", "humidity_pct", "growth_stage"}
    assert rows[0].temperature_c == 20.5 and rows[1].temperature_c is None and rows[1].humidity_pct is None


def test_table_round_trip_and_bundle(spark, tmpdir_path):
    df = spark.createDataFrame([(1, "a", 2.5), (2, "b", None)], "id int, s string, v double")
    FS.write_table(df, f"{tmpdir_path}/t")
    assert sorted(map(tuple, spark.read.parquet(f"{tmpdir_path}/t").collect()), key=str) == \
        sorted(map(tuple, df.collect()), key=str)
    FS.write_table(df, f"{tmpdir_path}/c", fmt="csv")
    assert spark.read.option("header", True).csv(f"{tmpdir_path}/c").count() == 2
    FS.write_bundle({"x": df, "y": df.select("id")}, f"{tmpdir_path}/bundle")
    b = FS.read_bundle(spark, f"{tmpdir_path}/bundle", ["x", "y"])
    assert b["x"].count() == 2 and b["y"].columns == ["id"]
    FS.save_class_list(spark.createDataFrame([(0, "a_b")], "class_id int, class_name string"), f"{tmpdir_path}/cl")
    assert FS.load_class_list(spark, f"{tmpdir_path}/cl").first().class_name == "a_b"
    FS.save_class_list(FS.load_class_list(spark, f"{tmpdir_path}/cl"), f"{tmpdir_path}/cj", fmt="json")
    assert FS.load_class_list(spark, f"{tmpdir_path}/cj", fmt="json").first().class_name == "a_b"


def test_archive_entries(spark, tmpdir_path):
    for k in range(2):
        with zipfile.ZipFile(f"{tmpdir_path}/set{k}.zip", "w") as z:
            z.writestr("ds/", "")
            z.writestr("ds/train/images/a.jpg", b"x" * (10 + k))
            z.writestr("ds/train/labels/a.txt", "1 0 0 0 0\n")
            z.writestr("ds/data.yaml", "names: [a, b]\n")
    e = FS.archive_entries(spark, f"{tmpdir_path}/*.zip")
    assert e.count() == 6
    kinds = {r.kind: r.n_files for r in C.file_counts(e, "name").collect()}
    assert kinds == {"image": 2, "txt": 2, "yaml": 2}
    assert C.guess_format(e, "name").first().format == "detection"


def test_catalogue_files(spark, tmpdir_path):
    files = _catalogue(tmpdir_path)
    imgs = FS.image_files(spark, tmpdir_path)
    assert imgs.count() == 3
    assert {r.split for r in imgs.collect()} == {"train", "valid"}
    lines = FS.label_lines(spark, f"{tmpdir_path}/*/labels/*.txt")
    assert lines.count() == 5                                  # blank line dropped
    maj = C.majority_class(lines.withColumnRenamed("path", "label_path").withColumn(
        "image_id", lines.stem), image="image_id")
    got = {r.image_id: r.class_id for r in maj.collect()}
    assert got == {"a_jpg.rf.1": 2, "a_jpg.rf.3": 1}
    names = C.parse_class_list(FS.read_yaml_text(spark, f"{tmpdir_path}/data.yaml")).orderBy("class_id").collect()
    assert [r.class_name for r in names] == ["crop_healthy", "crop_blight", "crop_rust", "crop_x"]
    sizes = {os.path.basename(r.path): (r.width, r.height, r.channels)
             for r in FS.image_sizes(spark, tmpdir_path).collect()}
    for p, (w, h, _) in files.items():
        assert sizes[os.path.basename(p)][:2] == (w, h)


def test_yaml_dash_list(spark):
    t = spark.createDataFrame([("names:\n  - 'a_b'\n  - c_d\n",)], "text string")
    assert [r.class_name for r in C.parse_class_list(t).orderBy("class_id").collect()] == ["a_b", "c_d"]


def test_embed_images_with_numpy_function(spark, tmpdir_path):
    _catalogue(tmpdir_path)

    def colour_mean(blobs):
        # stand-in embedding: byte histogram summary (no image library needed)
        return np.stack([[np.frombuffer(b, dtype=np.uint8).mean(), len(b)] for b in blobs])

    e = FS.embed_images(FS.image_files(spark, tmpdir_path, with_content=True), colour_mean, 2)
    rows = e.collect()
    assert len(rows) == 3 and all(len(r.embedding) == 2 for r in rows)


def test_model_save_load(spark, tmpdir_path):
    from agroframe.operators.models import health_pipeline
    df = spark.createDataFrame([(float(i % 40), float(i % 7), "a" if i % 2 else "b", int(18 <= i % 40 <= 30))
                                for i in range(200)], "temperature_c double, humidity_pct double, "
                                                      "growth_stage string, health_label int")
    m = health_pipeline(["temperature_c", "humidity_pct"], max_iter=5).fit(df)
    m.write().overwrite().save(f"{tmpdir_path}/model")
    back = PipelineModel.load(f"{tmpdir_path}/model")
    a = [r.prediction for r in m.transform(df).collect()]
    b = [r.prediction for r in back.transform(df).collect()]
    assert a == b


def test_ood_model_save_load(spark, tmpdir_path):
    from agroframe.operators import ood as O
    rng = np.random.default_rng(0)
    df = spark.createDataFrame([(i, rng.normal(size=4).astype(np.float32).tolist(), i % 3) for i in range(60)],
                               "vec_id long, embedding array<float>, label int")
    m = O.fit_ood(df)
    m.threshold, m.median = 12.5, 4.0
    m.save(spark, f"{tmpdir_path}/ood")
    back = O.OodModel.load(spark, f"{tmpdir_path}/ood")
    assert back.labels == m.labels and back.threshold == 12.5
    np.testing.assert_allclose(back.w, m.w)
    a = O.score_ood(df, m).orderBy("vec_id").toPandas().ood_score
    b = O.score_ood(df, back).orderBy("vec_id").toPandas().ood_score
    np.testing.assert_allclose(a, b)


def test_label_lines_of_large_and_odd_files(spark, tmpdir_path):
    os.makedirs(f"{tmpdir_path}/train/labels", exist_ok=True)
    rng = np.random.default_rng(2)
    want = []
    for k, name in enumerate(["img0", "a b%1", "c+d"]):
        end = "\r\n" if k == 1 else "\n"
        lines = [f"{int(rng.integers(0, 30))} 0.5 0.5" if i % 97 else "\t" for i in range(2000 if k == 0 else 5)]
        lines[-1] = "\t7 0 0"
        want += [(name, i + 1, x) for i, x in enumerate(lines) if x.strip()]
        with open(f"{tmpdir_path}/train/labels/{name}.txt", "w", newline="") as f:
            f.write(end.join(lines) + end)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")   # force the big file into many splits
    try:
        got = FS.label_lines(spark, f"{tmpdir_path}/*/labels/*.txt")
        assert sorted(map(tuple, got.select("stem", "line_no", "line").collect())) == sorted(want)
        assert {r.split for r in got.collect()} == {"train"}
        assert C.label_tokens(got).filter("class_id is null").count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_csv_columns_are_found_by_name(spark, tmpdir_path):
    names = ["crop", "location", "pest", "year", "standard_week", "pest_value", *P.WEATHER, "unit"]
    row = ["Rice", "X", "Borer", "2001", "5", "9", *["30"] * 8, "u"]
    order = list(reversed(range(len(names))))
    os.makedirs(f"{tmpdir_path}/d")
    with open(f"{tmpdir_path}/d/a.csv", "w") as f:
        f.write(",".join(names[i] for i in order) + "\n" + ",".join(row[i] for i in order) + "\n")
    got = FS.read_panel(spark, f"{tmpdir_path}/d").first()
    assert (got.crop, got.location, got.pest, got.year, got.unit) == ("Rice", "X", "Borer", 2001, "u")
    with open(f"{tmpdir_path}/d/b.csv", "w") as f:  # a second file with another header must not shift values
        f.write(",".join(names) + "\n" + ",".join(row) + "\n")
    with pytest.raises(Exception, match="(?i)header"):
        FS.read_panel(spark, f"{tmpdir_path}/d").collect()


def test_yaml_list_over_several_lines(spark):
    t = spark.createDataFrame([("nc: 2\nnames: [\n  'a_b',\n\t\"c d\" ]\n",)], "text string")
    assert [r.class_name for r in C.parse_class_list(t).orderBy("class_id").collect()] == ["a_b", "c d"]


def test_archive_contents_feed_labels_and_classes(spark, tmpdir_path):
    with zipfile.ZipFile(f"{tmpdir_path}/s.zip", "w") as z:
        z.writestr("ds/train/images/a.jpg", b"x")
        z.writestr("ds/train/labels/a.txt", "1 0 0\r\n\r2 0 0\n1 0 0\n")
        z.writestr("ds/valid/labels/b.txt", "")
        z.writestr("ds/data.yaml", "names: [a, b]\n")
    lines = FS.archive_label_lines(spark, f"{tmpdir_path}/*.zip")
    assert [(r.split, r.stem, r.line_no, r.line) for r in lines.orderBy("line_no").collect()] == \
        [("train", "a", 1, "1 0 0"), ("train", "a", 3, "2 0 0"), ("train", "a", 4, "1 0 0")]
    yaml = FS.archive_contents(spark, f"{tmpdir_path}/*.zip", r"\.ya?ml$").selectExpr("decode(content, 'UTF-8') text")
    assert [r.class_name for r in C.parse_class_list(yaml).orderBy("class_id").collect()] == ["a", "b"]


def test_manifest_from_files(spark, tmpdir_path):
    _catalogue(tmpdir_path)
    got = FS.manifest_from_files(spark, tmpdir_path, f"{tmpdir_path}/data.yaml").collect()
    assert sorted((r.split, r.path.split("/")[-1], r.class_name, r.mixed) for r in got) == \
        [("train", "a_jpg.rf.1.png", "crop_rust", True), ("valid", "a_jpg.rf.3.png", "crop_blight", False)]
