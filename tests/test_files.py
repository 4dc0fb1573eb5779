"""Artifact files: what is written comes back, and what is damaged or foreign is told apart."""

import io
import zipfile

import numpy as np
import pytest
from framequery.functions import geometry as g
from framequery.sources import files
from pyspark.sql import functions as F


def test_image_folders(spark, tmp_path):
    for k, name in enumerate(["b", "a"]):
        (tmp_path / name).mkdir()
        for n in (3, 1, 20 + k):
            (tmp_path / name / f"frame{n:04d}.PNG").write_bytes(b"x")
        (tmp_path / name / "notes.txt").write_bytes(b"x")
    (tmp_path / "empty").mkdir()
    (tmp_path / "a" / "frame0002.tif").write_bytes(b"x")
    (tmp_path / "under" / "a").mkdir(parents=True)
    for name in ("x.png", "x!.png", "x.jpeg.txt"):
        (tmp_path / "under" / "a" / name).write_bytes(b"x")
    found = files.read_frame_folders(spark, str(tmp_path))
    got = sorted((r.stream.split(str(tmp_path))[1], r.frame_idx, r.path.rsplit("/", 1)[1]) for r in found.collect())
    assert got == [
        ("/a", 0, "frame0001.PNG"), ("/a", 1, "frame0002.tif"), ("/a", 2, "frame0003.PNG"), ("/a", 3, "frame0021.PNG"),
        ("/b", 0, "frame0001.PNG"), ("/b", 1, "frame0003.PNG"), ("/b", 2, "frame0020.PNG"), ("/under/a", 0, "x!.png"), ("/under/a", 1, "x.png"),
    ]
    every = spark.createDataFrame([(f"/d/{k:04d}.png",) for k in range(50)], "path string")
    seek = files.frame_folder(every, seek=range(3, 20, 5)).orderBy("frame_idx").collect()
    assert [(r.frame_idx, r.path) for r in seek] == [(n, f"/d/{k:04d}.png") for n, k in enumerate(range(3, 20, 5))]


def archive(frames):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, x in frames:
            raw = io.BytesIO()
            if isinstance(x, bytes):
                raw.write(x)
            else:
                np.save(raw, x)
            z.writestr(name, raw.getvalue())
    return out.getvalue()


def test_damaged_depths_become_nan(spark):
    good = np.arange(6, dtype=np.float32).reshape(2, 3)
    rows = [("a.zip", archive([("000000.npy", good), ("000001.npy", b"broken"), ("000002.npy", good + 1)])), ("b.zip", b"no archive"), ("c.zip", archive([]))]
    df = spark.createDataFrame([(p, bytearray(c)) for p, c in rows], "path string, content binary")
    got = files.read_depth_archives(df).collect()
    assert {r.path for r in got} == {"a.zip"} and len(got) == 18
    for r in got:
        assert np.isnan(r.depth) if r.frame_idx == 1 else r.depth == good[r.r, r.c] + r.frame_idx / 2
    with pytest.raises(Exception, match="pickle|magic|NUMPY|load"):
        files.read_depth_archives(df.where("path = 'a.zip'"), permissive=False).collect()


def test_text_lines(spark, tmp_path):
    rows = [(k, *[float(x) for x in np.random.default_rng(k).normal(size=7)]) for k in range(20)]
    df = spark.createDataFrame(rows, "frame_idx long, " + ", ".join(f"{c} double" for c in g.Pose._fields))
    files.write_lines(df, files.pose_line(), str(tmp_path / "poses"))
    lines = spark.read.text(str(tmp_path / "poses")).unionByName(spark.createDataFrame([("# a comment",), ("1 2 3",), ("",)], "value string"))
    assert sorted(map(tuple, files.read_poses(lines).collect())) == rows
    pairs = spark.createDataFrame([("3: a cat: black",), ("x: y",), (" 4 :PINHOLE ",), (None,)], "value string")
    assert sorted(map(tuple, files.read_pairs(pairs, "id", "what").collect())) == [(3, "a cat: black"), (4, "PINHOLE")]
    cameras = spark.createDataFrame([(1, "PINHOLE"), (2, "MEI")], "frame_idx long, camera string")
    again = files.read_pairs(cameras.select(files.camera_line().alias("value")), "frame_idx", "camera")
    assert sorted(map(tuple, again.collect())) == [(1, "PINHOLE"), (2, "MEI")]


def test_maps(spark, tmp_path):
    points = spark.range(10).select((F.col("id") % 3).alias("kf_idx"), F.col("id").cast("double").alias("depth"))
    edges = spark.createDataFrame([(0, 1), (1, 2)], "i long, j long")
    files.write_map(points, edges, str(tmp_path / "map"))
    p, e = files.read_map(spark, str(tmp_path / "map"))
    assert sorted(map(tuple, p.collect())) == sorted(map(tuple, points.collect())) and sorted(map(tuple, e.collect())) == [(0, 1), (1, 2)]


def test_keyed_lines_take_few_files(spark, tmp_path):
    rows = [(k, n, f"{n}: a\tb") for k in [*range(300), None] for n in range(2)]
    files.write_keyed_lines(spark.createDataFrame(rows, "k long, n long, line string"), F.col("k"), F.col("line"), str(tmp_path / "lines"), 8)
    assert len(list((tmp_path / "lines").glob("folder=*/part-*"))) <= 8
    read = files.read_pairs(files.read_keyed_lines(spark, str(tmp_path / "lines")), "n", "text", F.col("key").cast("long").alias("k"))
    assert sorted(map(str, read.collect())) == sorted(f"Row(k={k}, n={n}, text='a\\tb')" for k, n, _ in rows)
