import hashlib
import os
import random
import struct
import time
import zipfile
import zlib

import numpy as np
import pytest

from agroframe.sources import files as FS
from agroframe.sources import ranges as R


def lines_of(df):
    return sorted((r.split, r.stem, r.line_no, r.line) for r in df.collect())


def test_many_small_archives_equal_the_folder_reader(spark, tmpdir_path):
    rnd = random.Random(1)
    want = []
    for k in range(1000):
        split = ("train", "valid")[k % 2]
        ends = rnd.choice(["\n", "\r\n", "\r"])
        lines = [rnd.choice(["1 0.5 0.5", "", "  ", "ü x", "7"]) for _ in range(rnd.randint(0, 4))]
        text = ends.join(lines) + (ends if rnd.random() < 0.5 else "")
        os.makedirs(f"{tmpdir_path}/d/{split}/labels", exist_ok=True)
        with open(f"{tmpdir_path}/d/{split}/labels/f{k}.txt", "w", newline="", encoding="utf-8") as f:
            f.write(text)
        with zipfile.ZipFile(f"{tmpdir_path}/a{k}.zip", "w", (zipfile.ZIP_DEFLATED, zipfile.ZIP_STORED)[k % 3 == 0]) as z:
            z.writestr(f"set/{split}/labels/f{k}.txt", text.encode())
            z.writestr(f"set/{split}/images/f{k}.jpg", b"x" * k)
            z.writestr("set/", "")
        want.append((f"set/{split}/images/f{k}.jpg", k))
    folder = FS.label_lines(spark, f"{tmpdir_path}/d/*/labels/*.txt")
    assert lines_of(FS.archive_label_lines(spark, f"{tmpdir_path}/*.zip")) == lines_of(folder)
    entries = FS.archive_entries(spark, f"{tmpdir_path}/*.zip")
    assert entries.count() == 2000
    assert sorted((r.name, r.size) for r in entries.where("name LIKE '%.jpg'").collect()) == sorted(want)
    got = {r.name: bytes(r.content) for r in FS.archive_contents(spark, f"{tmpdir_path}/a1*.zip", r"\.jpg$").collect()}
    assert got == {n: b"x" * k for n, k in want if str(k).startswith("1")}


def test_archive_above_two_gigabytes(spark, tmpdir_path, monkeypatch):
    """A sparse zip64 archive: 3 GB of holes between its entries take no disk and are never read."""
    path, names, at = f"{tmpdir_path}/big.zip", [], 0
    central = b""
    with open(path, "wb") as f:
        for k in range(30):
            name, data = f"s/train/labels/f{k}.txt".encode(), f"{k} 0 0\nlast {k}".encode()
            packed = zlib.compressobj(9, zlib.DEFLATED, -15)
            packed = packed.compress(data) + packed.flush()
            f.seek(at)
            f.write(struct.pack("<4sHHHHHLLLHH", b"PK\x03\x04", 45, 0, 8, 0, 0, zlib.crc32(data), len(packed), len(data), len(name), 0) + name + packed)
            wide = struct.pack("<HHQ", 1, 8, at)
            central += struct.pack("<4s4B4HL2L5H2L", b"PK\x01\x02", 45, 0, 45, 0, 0, 8, 0, 0, zlib.crc32(data), len(packed), len(data),
                                   len(name), len(wide), 0, 0, 0, 0, 0xFFFFFFFF) + name + wide
            names.append(name.decode())
            at += 100 << 20
        f.seek(at)
        f.write(central)
        f.write(struct.pack("<4sQHHLLQQQQ", b"PK\x06\x06", 44, 45, 45, 0, 0, 30, 30, len(central), at))
        f.write(struct.pack("<4sLQL", b"PK\x06\x07", 0, at + len(central), 1))
        f.write(struct.pack("<4sHHHHLLH", b"PK\x05\x06", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0))
    assert os.path.getsize(path) > 2.9e9 and zipfile.ZipFile(path).namelist() == names
    got = lines_of(FS.archive_label_lines(spark, path))
    assert got == sorted(x for k in range(30) for x in (("train", f"f{k}", 1, f"{k} 0 0"), ("train", f"f{k}", 2, f"last {k}")))
    monkeypatch.setattr(FS, "PACK_BYTES", 1)  # as many tasks as there are bytes: entries are dealt, not archives
    entries = FS._packed(FS.archive_entries(spark, path))
    assert max(len(p) for p in entries.rdd.glom().collect()) < 15


def test_broken_archives_are_errors(tmpdir_path):
    path = f"{tmpdir_path}/x.zip"
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("a.txt", "hello")
    data = bytearray(open(path, "rb").read())
    data[data.index(b"hello")] ^= 1
    open(path, "wb").write(data)
    with R.open_file(path) as f:
        (name, at, packed, size, method, flags, crc), = R.zip_directory(f, len(data))
        with pytest.raises(ValueError, match="checksum"):
            list(R.zip_entry(f, at, packed, method, flags, crc))
        with pytest.raises(ValueError, match="cannot be read"):
            list(R.zip_entry(f, at, packed, 99, flags, crc))
    open(path, "wb").write(b"no zip at all")
    with R.open_file(path) as f, pytest.raises(ValueError, match="directory"):
        list(R.zip_directory(f, 13))


def test_large_entries_are_streamed():
    rnd = random.Random(5)
    text = "".join(rnd.choice(["ab", "é", "\n", "\r\n", "\r", "€" * 3]) for _ in range(20_000))
    data = text.encode()
    cuts = sorted(rnd.sample(range(len(data)), 300))
    pieces = [data[a:b] for a, b in zip([0, *cuts], [*cuts, len(data)])]
    want = text.replace("\r\n", "\n").replace("\r", "\n").split("\n")
    assert list(R.text_lines(iter(pieces))) == (want[:-1] if not want[-1] else want)


def _png(w, h, kind, extra=b""):
    chunk = lambda n, d: struct.pack(">L", len(d)) + n + d + struct.pack(">L", zlib.crc32(n + d))
    wide = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}[kind]
    body = zlib.compress(b"".join(b"\0" + bytes(w * wide) for _ in range(h)))
    palette = chunk(b"PLTE", bytes(3)) if kind == 3 else b""
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">LLBBBBB", w, h, 8, kind, 0, 0, 0)) + palette + extra + chunk(b"IDAT", body) + chunk(b"IEND", b"")


def _bmp(w, h):
    line = (w * 3 + 3) // 4 * 4
    return struct.pack("<2sLHHLLllHHLLllLL", b"BM", 54 + line * h, 0, 0, 54, 40, w, h, 1, 24, 0, line * h, 0, 0, 0, 0) + bytes(line * h)


def test_sizes_from_headers_as_the_image_source_has_them(spark, tmpdir_path):
    os.makedirs(f"{tmpdir_path}/a/images")
    made = {"g.png": _png(7, 5, 0), "c.png": _png(9, 4, 2), "p.png": _png(3, 8, 3), "t.png": _png(6, 2, 6), "b.bmp": _bmp(11, 13)}
    for name, data in made.items():
        open(f"{tmpdir_path}/a/images/{name}", "wb").write(data)
    open(f"{tmpdir_path}/a/images/zz.jpg", "wb").write(b"no image")
    got = {os.path.basename(r.path): (r.width, r.height, r.channels, r.mode) for r in FS.image_sizes(spark, tmpdir_path, per_folder=9).collect()}
    want = {os.path.basename(r.image.origin): (r.image.width, r.image.height, r.image.nChannels, r.image.mode)
            for r in spark.read.format("image").option("dropInvalid", True).load(f"{tmpdir_path}/a/images").collect()}
    assert got == want and len(got) == 5
    assert FS.image_sizes(spark, tmpdir_path, per_folder=2).count() == 2


def test_jpeg_headers(tmpdir_path):
    segment = lambda mark, body: bytes([0xFF, mark]) + struct.pack(">H", len(body) + 2) + body
    for frame in (0xC0, 0xC2):
        data = (b"\xff\xd8" + segment(0xE0, b"JFIF\0" + bytes(9)) + segment(0xE1, np.random.default_rng(0).bytes(60_000)) + b"\xff"
                + segment(0xC4, bytes(20)) + segment(frame, struct.pack(">BHHB", 8, 480, 640, 3) + bytes(9)) + segment(0xDA, bytes(10)))
        open(f"{tmpdir_path}/x.jpg", "wb").write(data)
        with R.open_file(f"{tmpdir_path}/x.jpg") as f:
            assert R.image_header(f, len(data)) == (640, 480, 3)
    with R.open_file(f"{tmpdir_path}/x.jpg") as f:
        assert R.image_header(f, 40_000) is None  # cut short


def test_few_archives_of_many_entries_are_not_broadcast(spark, tmpdir_path):
    """A plan must not take the entries for as few as the archives that they come from."""
    with zipfile.ZipFile(f"{tmpdir_path}/a.zip", "w") as z:
        for k in range(3000):
            name = hashlib.sha512(str(k).encode()).hexdigest()
            z.writestr(f"train/images/{name}.jpg", b"")
            z.writestr(f"train/labels/{name}.txt", b"1 0.5 0.5 0.1 0.1\n")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "50k")  # far less than the 3000 paths, more than one row a file
    try:
        classes = spark.createDataFrame([(1, "crop_rust")], "class_id int, class_name string")
        found = FS.manifest_from_archives(spark, f"{tmpdir_path}/*.zip", classes)
        assert len(found.collect()) == 3000
        plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert not [x for x in plan.splitlines() if "BroadcastHashJoin [image_id" in x]


def test_archives_grow_in_number_with_the_images(spark, tmpdir_path, monkeypatch):
    from agroframe.plans import catalogue as PC

    for name, schema, rows in (
            ("orders", "o_orderkey long, o_custkey long", [(k, k) for k in range(400)]),
            ("lineitem", "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double, l_quantity double, l_shipdate date",
             [(k, 1, 1, 1, 1.0, 1.0, None) for k in range(400)])):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmpdir_path}/{name}.parquet")
    monkeypatch.setattr(PC, "ARCHIVE_IMAGES", 10, raising=False)
    entries = FS.archive_entries(spark, PC.written_archives(spark, tmpdir_path))
    sizes = [r["count"] for r in entries.groupBy("archive").count().collect()]
    assert sum(sizes) == 800 and len(sizes) > 30 and max(sizes) < 80


def _orders(spark, path, n=2000):
    """Order tables of which every fifth order has no lines, one key comes twice and one is null."""
    orders = [(k, k * 7) for k in range(n)] + [(3, 8), (None, 1)]
    lines = [(k, j, k + j, k * j, 1.0, 1.0, None) for k in range(n) if k % 5 for j in range(1 + k % 4)]
    for name, schema, rows in (
            ("orders", "o_orderkey long, o_custkey long", orders),
            ("lineitem", "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double, l_quantity double, l_shipdate date", lines)):
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}.parquet")


def _shuffled(spark):
    """Names and bytes of the shuffle files on disk."""
    it = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
    files = [it.next() for _ in iter(it.hasNext, False)]
    return {f.getName(): f.length() for f in files if f.getName().startswith("shuffle_") and f.getName().endswith(".data")}


def test_archive_manifest_keeps_no_shuffles_and_no_archives_of_its_steps(spark, tmpdir_path):
    """When the last join begins, only the written tables are on disk: no names in shuffles, no archives."""
    from agroframe.plans import catalogue as PC
    from agroframe.session import ensure_checkpoint_dir

    _orders(spark, tmpdir_path)
    root = ensure_checkpoint_dir(spark).removeprefix("file:")
    archives = [x for x in os.listdir(root) if x.startswith("archives-")]
    before, was = set(_shuffled(spark)), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    found = PC.archive_manifest(spark, tmpdir_path)
    until = time.time() + 20
    while (left := sum(n for k, n in _shuffled(spark).items() if k not in before)) > 20_000 and time.time() < until:
        time.sleep(0.2)  # they go in the background
    assert left <= 20_000  # counts; 2000 names alone are more than 100,000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == was
    assert [x for x in os.listdir(root) if x.startswith("archives-")] == archives
    cols = ["split", "path", "class_id", "class_name", "crop", "source", "mixed"]
    want = PC.image_manifest(spark, tmpdir_path).select(*cols).where("class_id IS NOT NULL")
    got = sorted(map(tuple, found.select(*cols).distinct().collect()), key=str)
    assert got == sorted(map(tuple, want.distinct().collect()), key=str) and len(got) > 1000
    assert found.count() >= len(got)  # read again, without the archives


def test_written_archives_hold_an_entry_for_each_image_and_each_label_file(spark, tmpdir_path):
    from agroframe.plans import catalogue as PC

    _orders(spark, tmpdir_path)
    entries = FS.archive_entries(spark, PC.written_archives(spark, tmpdir_path))
    names = [r.name for r in entries.collect()]
    images = [r for r in PC.fx(spark, tmpdir_path, "fx_images").collect()]
    assert sorted(x for x in names if "labels" not in x) == sorted("/".join(x for x in (r.split, "images", r.file_name) if x) for r in images)
    with_lines = [r for r in images if r.image_id is not None and r.image_id % 5]
    assert sorted(x for x in names if "labels" in x) == sorted(f"{r.split}/labels/{os.path.splitext(r.file_name)[0]}.txt" for r in with_lines)
    assert entries.select("archive").distinct().count() >= 16


def test_majority_by_image_equals_the_plain_one_and_has_one_shuffle(spark):
    from agroframe.operators.catalogue import majority_class

    rnd = random.Random(11)
    rows = [(None if k % 50 == 0 else f"train/img{rnd.randint(0, 60)}", None if k % 31 == 0 else k, rnd.choice(["1 a", "2 b", "3", "x", " ", None, "+2"]))
            for k in range(3000)]
    lines = spark.createDataFrame(rows, "image_id string, line_no int, line string").repartition(7)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "20")  # lines of an image in many batches
    try:
        found = majority_class(lines, by_image=True)
        assert sorted(map(str, found.collect())) == sorted(map(str, majority_class(lines).collect()))
        plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set(key, before)
    assert plan.count("Exchange hashpartitioning(") == 1
    assert sum(r.mixed for r in found.collect()) > 10
