"""The archive source: round trips, pushed ranges, damaged members, failed writes."""

import io
import os
import zipfile

import numpy as np
import pytest
from framequery.sources import archives
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual, LessThan


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("archives") / "a")
    rows = spark.range(300).select(F.when(F.col("id") < 200, "long/one").otherwise("two").alias("stream"), F.when(F.col("id") < 200, F.col("id")).otherwise(F.col("id") - 200).alias("frame_idx"))
    rows = rows.select("*", F.explode(F.array(*[F.struct(F.lit(r).alias("r"), F.lit(c).alias("c")) for r in range(2) for c in range(3)])).alias("p"))
    archives.write_archives(rows.select("stream", "frame_idx", "p.*", (F.col("frame_idx") * 10 + F.col("p.r") * 3 + F.col("p.c")).alias("value")), path, frames=32)
    return path


def test_round_trip(spark, stored):
    got = archives.read_archives(spark, stored)
    assert got.count() == 300 * 6 and got.where("value != frame_idx * 10 + r * 3 + c").count() == 0
    assert {(r.stream, r["count"]) for r in got.groupBy("stream").count().collect()} == {("long/one", 1200), ("two", 600)}
    assert not [d for d in os.listdir(stored) if d.startswith("_")]


def test_a_range_reads_its_members_alone(spark, stored, monkeypatch):
    reader = archives.ArchiveReader({"path": stored})
    left = list(reader.pushFilters([EqualTo(("stream",), "long/one"), GreaterThanOrEqual(("frame_idx",), 60), LessThan(("frame_idx",), 70), EqualTo(("r",), 0)]))
    assert left == [EqualTo(("r",), 0)]
    spans = reader.partitions()
    assert sorted((s.low, s.high) for s in spans) == [(60, 63), (64, 69)]
    opened = []
    read = zipfile.ZipFile.read
    monkeypatch.setattr(zipfile.ZipFile, "read", lambda z, name: opened.append(name) or read(z, name))
    batches = [b for s in spans for b in reader.read(s)]
    assert sorted(opened) == [f"{k:09d}.npy" for k in range(60, 70)] and sum(b.num_rows for b in batches) == 60
    got = archives.read_archives(spark, stored).where("stream = 'long/one' and frame_idx between 60 and 69 and r = 0")
    assert sorted(r.frame_idx for r in got.select("frame_idx").distinct().collect()) == list(range(60, 70)) and got.count() == 30
    assert archives.read_archives(spark, stored).where("stream = 'none'").count() == 0


def test_damaged_frames(spark, tmp_path):
    def raw(x):
        out = io.BytesIO()
        np.save(out, x)
        return out.getvalue()

    (tmp_path / "s").mkdir()
    members = {0: raw(np.zeros((2, 2), np.float32))[:20], 1: raw(np.ones((2, 3), np.float32)), 2: b"", 3: raw(np.ones((4, 1), np.float32)), 4: raw(np.ones((4, 1)))[:130]}
    with zipfile.ZipFile(tmp_path / "s" / "000000000-000000004-ab.zip", "w") as z:
        for k, content in members.items():
            z.writestr(f"{k:09d}.npy", content)
    got = archives.read_archives(spark, str(tmp_path)).groupBy("frame_idx").agg(F.count(F.lit(1)).alias("n"), F.max("r").alias("r"), F.sum(F.isnan("value").cast("int")).alias("bad"))
    assert sorted(map(tuple, got.collect())) == [(0, 6, 1, 6), (1, 6, 1, 0), (2, 6, 1, 6), (3, 4, 3, 0), (4, 4, 3, 4)]
    late = archives.read_archives(spark, str(tmp_path)).where("frame_idx = 2")
    assert late.count() == 6 and late.where("not isnan(value)").count() == 0
    with pytest.raises(Exception, match="can't be read"):
        archives.read_archives(spark, str(tmp_path), permissive=False).count()


def test_a_failed_write_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "f")
    rows = spark.createDataFrame([("s", k, 0, 0, float(k)) for k in range(10)], "stream string, frame_idx long, r long, c long, value double")
    bad = rows.withColumn("r", F.when(F.col("frame_idx") == 7, F.raise_error(F.lit("no")).cast("long")).otherwise(F.col("r")))
    with pytest.raises(Exception, match="no"):
        archives.write_archives(bad, path, frames=2)
    assert not [f for _, _, found in os.walk(path) for f in found]
