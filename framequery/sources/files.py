"""Artifact files as Spark sources and sinks: image folders, depth archives, and the text files beside them.

Readers start from ``binaryFile`` or ``text`` scans, so files spread over the cluster; what
has to be decoded is decoded in tasks, file by file. Writers are DataFrame writers.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framequery.functions import geometry as g
from framequery.operators import ranges

IMAGES = ("jpg", "jpeg", "png", "bmp", "tif", "tiff")
_POSE = list(g.Pose._fields)


def stem(path: Column) -> Column:
    """A path's file name without its last extension."""
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "")


def folder(path: Column) -> Column:
    """The whole path of the folder that a file lies in; folders of one name under two parents are two."""
    return F.regexp_replace(path, "/[^/]*$", "")


def frame_folder(files: DataFrame, extensions: tuple[str, ...] = IMAGES, seek: range | None = None) -> DataFrame:
    """(stream, frame_idx, path): the image files of (path, ...) in order of path, numbered from 0 in each folder.

    A folder is sorted by ranges of its paths, over as many tasks as it needs. Files with other
    extensions, in any case, are left out; an empty folder gives no rows. ``seek`` picks
    frames by start, stop (-1: the end) and step and numbers them anew.
    """
    kept = files.where(F.lower(F.regexp_extract("path", r"\.([^./]*)$", 1)).isin(*extensions)).select(folder(F.col("path")).alias("stream"), "path")
    found = ranges.numbered(kept, ["stream"], [F.col("path")], "frame_idx").select("stream", "frame_idx", "path")
    if seek is None:
        return found
    picked = found.where((F.col("frame_idx") >= seek.start) & ((F.col("frame_idx") - seek.start) % seek.step == 0))
    picked = picked if seek.stop == -1 else picked.where(F.col("frame_idx") < seek.stop)
    return picked.withColumn("frame_idx", ((F.col("frame_idx") - seek.start) / seek.step).cast("long"))


def read_frame_folders(spark: SparkSession, path: str) -> DataFrame:
    """frame_folder() of every folder below ``path``; contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return frame_folder(files.select("path"))


def depth_archives(pixels: DataFrame, stream: str, frames: int = 64) -> DataFrame:
    """(path, content): zip archives with one array a frame, of at most ``frames`` frames each.

    ``pixels`` has (``stream``, frame_idx, r, c, depth). The rows may go to any store; their
    shape is that of a ``binaryFile`` scan.
    """
    part = F.floor(F.col("frame_idx") / frames).cast("long").alias("part")

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            for frame, own in rows.groupby("frame_idx"):
                grid = np.full((own["r"].max() + 1, own["c"].max() + 1), np.nan, np.float32)
                grid[own["r"], own["c"]] = own["depth"]
                raw = io.BytesIO()
                np.save(raw, grid)
                z.writestr(f"{frame:06d}.npy", raw.getvalue())
        return pd.DataFrame({"path": [f"{rows[stream].iloc[0]}/{rows['part'].iloc[0]:06d}.zip"], "content": [out.getvalue()]})

    return pixels.select(stream, "frame_idx", "r", "c", "depth", part).groupBy(stream, "part").applyInPandas(pack, "path string, content binary")


def read_depth_archives(files: DataFrame, permissive: bool = True) -> DataFrame:
    """(path, frame_idx, r, c, depth) of the archives in (path, content).

    A frame that can't be read becomes NaN throughout, in the shape of the archive's first
    readable frame; with ``permissive`` false it is an error. An archive that can't be opened,
    or without a readable frame, gives no rows when permissive.
    """
    schema = "path string, frame_idx long, r long, c long, depth double"

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                frames: list[tuple[int, np.ndarray | None]] = []
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as z:
                        for name in sorted(z.namelist()):
                            try:
                                frames.append((int(name.split(".")[0]), np.load(io.BytesIO(z.read(name)))))
                            except (ValueError, EOFError, OSError, zipfile.BadZipFile):
                                if not permissive:
                                    raise
                                frames.append((int(name.split(".")[0]), None))
                except zipfile.BadZipFile:
                    if not permissive:
                        raise
                shape = next((x.shape for _, x in frames if x is not None), None)
                for frame, x in frames if shape else ():
                    grid = np.full(shape, np.nan) if x is None else x.astype(float)
                    r, c = np.indices(grid.shape)
                    n = grid.size
                    yield pa.RecordBatch.from_arrays([pa.array([path] * n), pa.array(np.full(n, frame)), pa.array(r.ravel()), pa.array(c.ravel()), pa.array(grid.ravel())], names=["path", "frame_idx", "r", "c", "depth"])

    return files.select("path", "content").mapInArrow(unpack, schema)


def write_lines(rows: DataFrame, line: Column, path: str, by: str | None = None) -> None:
    """One text line a row, in folders by ``by`` if given."""
    out = rows.select(*([by] if by else []), line.alias("value"))
    (out.write.partitionBy(by) if by else out.write).text(path)


def write_keyed_lines(rows: DataFrame, key: Column, line: Column, path: str, folders: int = 256) -> None:
    """One text line a row, a tab after its key, in ``folders`` folders by a hash of the key, however many keys there are.

    A key's lines lie in one folder. A folder a key would mean as many files, each made, moved and
    listed one after another by the driver. Keys hold no tab; an empty one is null when read.
    """
    name = F.coalesce(key.cast("string"), F.lit(""))
    out = rows.select(F.pmod(F.xxhash64(name), F.lit(folders)).cast("int").alias("folder"), F.concat(name, F.lit("\t"), F.coalesce(line, F.lit(""))).alias("value"))
    out.repartition("folder").write.partitionBy("folder").text(path)


def read_keyed_lines(spark: SparkSession, path: str) -> DataFrame:
    """(key, value) of write_keyed_lines()."""
    at = F.instr("value", "\t")
    key = F.substring("value", F.lit(1), at - 1)
    return spark.read.schema("value string, folder int").text(path).select(F.when(key != "", key).alias("key"), F.substring("value", at + 1, F.length("value")).alias("value"))


def pose_line() -> Column:
    """A frame's number and its pose, translation then quaternion with the scalar last."""
    return F.concat_ws(" ", F.col("frame_idx").cast("string"), *[F.col(c).cast("string") for c in _POSE])


def read_poses(lines: DataFrame) -> DataFrame:
    """(frame_idx, tx..qw) of pose_line() lines; comments and lines with another number of fields are left out."""
    parts = F.split(F.trim("value"), r"\s+")
    good = lines.where(~F.col("value").startswith("#") & (F.size(parts) == 1 + len(_POSE)))
    return good.select(parts[0].cast("long").alias("frame_idx"), *[parts[k + 1].cast("double").alias(c) for k, c in enumerate(_POSE)])


def camera_line() -> Column:
    """A frame's number and camera type, as beside an intrinsics file."""
    return F.concat(F.col("frame_idx").cast("string"), F.lit(": "), F.col("camera"))


def read_pairs(lines: DataFrame, key: str, value: str, *also: Column) -> DataFrame:
    """(also, key, value) of "number: text" lines, as phrases and camera types are kept; others are left out."""
    good = lines.where(F.col("value").rlike(r"^\s*\d+\s*:"))
    number = F.regexp_extract("value", r"^\s*(\d+)\s*:", 1).cast("long")
    return good.select(*also, number.alias(key), F.trim(F.regexp_replace("value", r"^\s*\d+\s*:", "")).alias(value))


def write_map(points: DataFrame, edges: DataFrame, path: str) -> None:
    """A map: its points by keyframe and its edges, as Parquet."""
    points.repartition("kf_idx").write.parquet(f"{path}/points")
    edges.write.parquet(f"{path}/edges")


def read_map(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The points and edges of write_map()."""
    return spark.read.parquet(f"{path}/points"), spark.read.parquet(f"{path}/edges")
