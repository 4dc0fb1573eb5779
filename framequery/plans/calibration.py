"""Queries that fit small models to many groups: camera calibration frame by frame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framequery.functions import geometry as g
from framequery.operators import levenberg, rig_bundle, robust
from framequery.sources.frames import edges, grid, poses, sql

from .catalog import query


def up_and_latitude(pixels: DataFrame) -> DataFrame:
    """``pixels`` (u, v, roll, pitch, focal, ...) with the up direction up_u, up_v and sin_lat that such a camera sees there."""
    roll, pitch = F.col("roll"), F.col("pitch")
    up = (F.sin(roll) * F.cos(pitch), -F.cos(roll) * F.cos(pitch), F.sin(pitch))
    x, y = F.col("u") / F.col("focal"), F.col("v") / F.col("focal")
    seen = pixels.select("*", (up[0] - up[2] * x).alias("w_u"), (up[1] - up[2] * y).alias("w_v"), ((up[0] * x + up[1] * y + up[2]) / F.sqrt(x * x + y * y + 1)).alias("sin_lat"))
    size = F.sqrt(F.col("w_u") * F.col("w_u") + F.col("w_v") * F.col("w_v"))
    return seen.select("*", (F.col("w_u") / size).alias("up_u"), (F.col("w_v") / size).alias("up_v")).drop("w_u", "w_v")


@query()
def lm_calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roll, pitch and focal length of every frame, fitted to the up directions and latitudes of its pixels.

    The fields are those of a camera turned as the frame's pose says, disturbed by the pixel's
    value; one pixel in eight of a masked column is far off, which the Huber loss has to bear.
    """
    turned = poses(spark, sf_dir).select("frame_idx", (2 * F.col("qx")).alias("roll"), (2 * F.col("qy")).alias("pitch"), (8 * F.exp(F.col("qz"))).alias("focal"))
    px = grid(spark, sf_dir).select("frame_idx", (F.col("c") - 3.5).alias("u"), (F.col("r") - 3.5).alias("v"), F.col("v").alias("value"), (F.col("r") == F.col("frame_idx") % 8).alias("odd"))
    seen = up_and_latitude(px.join(turned, "frame_idx"))
    off = F.when(F.col("odd") & (F.col("value") > 0.1), 0.3).otherwise(0.0) + 0.003 * F.col("value")
    rows = seen.select("frame_idx", "u", "v", *[(F.col(c) + off).alias(c) for c in ("up_u", "up_v", "sin_lat")])
    start = poses(spark, sf_dir).select("frame_idx", F.array(F.lit(0.0), F.lit(0.0), F.log(F.lit(7.0))).alias("params"))
    found = levenberg.fit(rows, start, "frame_idx", levenberg.perspective_field, levenberg.Settings(scales=(0.01, 0.01)))
    p = F.col("params")
    values = {"roll": p[0], "pitch": p[1], "focal": F.exp(p[2])}
    return found.select("frame_idx", *[(F.round(v, 3) + F.lit(0.0)).alias(c) for c, v in values.items()], g.r6(F.col("cost")).alias("cost"), "converged")


_ANNEALED = """
odd AS (SELECT frame_idx, v + CASE WHEN r = frame_idx % 8 THEN 1.0 ELSE 0.0 END AS x FROM grid),
fit(frame_idx, n, mean, mu, kept) AS (
  SELECT frame_idx, 0, avg(x), 1.0::DOUBLE, 0.0::DOUBLE FROM odd GROUP BY frame_idx
  UNION ALL
  SELECT frame_idx, n + 1, CASE WHEN sum(w) > 0 THEN sum(w * x) / sum(w) ELSE mean END, CASE WHEN n % 2 = 1 THEN least(3 * mu, 1e6) ELSE mu END, sum(w)
  FROM (
    SELECT f.*, x, CASE WHEN r2 < mu / (mu + 1) * 0.09 THEN 1.0
      WHEN r2 <= (mu + 1) / mu * 0.09 THEN greatest(sqrt(0.09 * mu * (mu + 1) / greatest(r2, 1e-12)) - mu, 0.0) ELSE 0.0 END AS w
    FROM fit f JOIN odd USING (frame_idx), LATERAL (SELECT (x - mean) * (x - mean) AS r2) WHERE n < 8
  )
  GROUP BY frame_idx, n, mean, mu
)"""


@query(sql("grid", "SELECT frame_idx, round(mean, 6) + 0.0 AS mean, mu, round(kept, 4) + 0.0 AS kept FROM fit WHERE n = 8", _ANNEALED.strip()).replace("WITH ", "WITH RECURSIVE ", 1))
def gnc_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each frame's mean value under annealed truncated least squares, one of its rows being off by one."""
    off = F.when(F.col("r") == F.col("frame_idx") % 8, 1.0).otherwise(0.0)
    rows = grid(spark, sf_dir).select("frame_idx", (F.col("v") + off).alias("x"))
    found = robust.annealed_mean(rows, "frame_idx", "x", 0.3)
    return found.select("frame_idx", g.r6(F.col("mean")).alias("mean"), "mu", (F.round("kept", 4) + F.lit(0.0)).alias("kept"))


def _scene(spark: SparkSession, sf_dir: str) -> tuple[rig_bundle.Scene, DataFrame, DataFrame]:
    """All keyframes as one graph of a rig of two views, whose second sees what the frame after the keyframe does."""
    cams = poses(spark, sf_dir).where(F.col("frame_idx") % 5 == 0)
    frames = cams.select(F.lit(0).cast("long").alias("graph"), F.floor(F.col("frame_idx") / 5).cast("long").alias("k"), (F.col("frame_idx") == 0).alias("fixed"), *[c.alias(m) for m, c in g.inverse(g.pose()).named().items()])
    rig = spark.createDataFrame([(0, 0, *[0.0] * 6, 1.0), (0, 1, 0.02, 0.0, 0.01, 0.0, 0.0, 0.0, 1.0)], "graph long, v long, " + ", ".join(f"{m} double" for m in g.Pose._fields))
    lens = spark.createDataFrame([(0, v, 64.0, 64.0, 28.0, 28.0) for v in (0, 1)], "graph long, v long, fx double, fy double, cx double, cy double")
    px = grid(spark, sf_dir).where(F.col("frame_idx") % 5 < 2)
    sensed = F.when(F.col("mask"), F.col("disp") * 1.01)
    pixels = px.select(F.lit(0).cast("long").alias("graph"), F.floor(F.col("frame_idx") / 5).cast("long").alias("i"), (F.col("frame_idx") % 5).alias("v"), "r", "c", "disp", F.lit(0.05).alias("eta"), sensed.alias("sens"), F.lit(False).alias("held"))
    along = edges(spark, sf_dir).select(F.lit(0).cast("long").alias("graph"), "i", F.explode(F.array(*[F.lit(v).cast("long") for v in (0, 1)])).alias("vi"), "j")
    pairs = along.select("*", F.col("vi").alias("vj")).unionByName(frames.select("graph", F.col("k").alias("i"), F.lit(0).cast("long").alias("vi"), F.col("k").alias("j"), F.lit(1).cast("long").alias("vj")))
    apart = F.col("j") - F.col("i")
    targets = pairs.join(pixels.select("graph", "i", F.col("v").alias("vi"), "r", "c"), ["graph", "i", "vi"])
    weight = 0.2 + 0.03 * (F.col("r") + F.col("c"))
    targets = targets.select("graph", "i", "vi", "j", "vj", "r", "c", (F.col("c") + 0.03 * apart).alias("tu"), (F.col("r") - 0.02 * apart).alias("tv"), weight.alias("wu"), weight.alias("wv"))
    return rig_bundle.Scene(frames, rig, lens, pixels), pairs, targets


@query()
def rig_bundle_adjust(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every variable but the disparities after two steps: poses (kind 0), rig turns (1) and focal lengths (2)."""
    scene, pairs, targets = _scene(spark, sf_dir)
    s = rig_bundle.Settings(pose=(1e-2, 1.0), alpha=0.05, factor=8.0, rig=True, focal=True, lens=(1e-2, 1.0))
    for _ in range(2):
        scene, _ = rig_bundle.adjusted(scene, pairs, targets, s)
    seven = [(F.round(m, 4) + F.lit(0.0)).alias(m) for m in g.Pose._fields]
    poses_ = scene.frames.select(F.lit(0).alias("kind"), F.col("k").alias("id"), *seven, F.lit(None).cast("double").alias("focal"))
    turns = scene.rig.select(F.lit(1).alias("kind"), F.col("v").alias("id"), *seven, F.lit(None).cast("double").alias("focal"))
    lens = scene.cams.select(F.lit(2).alias("kind"), F.col("v").alias("id"), *[F.lit(None).cast("double").alias(m) for m in g.Pose._fields], (F.round("fx", 3) + F.lit(0.0)).alias("focal"))
    return poses_.unionByName(turns).unionByName(lens)


@query()
def gnc_bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The energy before each step of an annealed adjustment of poses, one target in nine being far off."""
    scene, pairs, targets = _scene(spark, sf_dir)
    off = F.when((F.col("r") * 8 + F.col("c") + F.col("i")) % 9 == 0, 3.0).otherwise(0.0)
    targets = targets.withColumns({"tu": F.col("tu") + off, "tv": F.col("tv") - off})
    s = rig_bundle.Settings(pose=(1e-2, 1.0), factor=8.0, motion_only=True, threshold=0.5)
    mu = pairs.select("graph").distinct().withColumn("mu", F.lit(1.0))
    _, energy, _ = rig_bundle.annealed(scene, pairs, targets, s, mu, 3, 1)
    return energy.select("graph", "step", (F.round("energy", 2) + F.lit(0.0)).alias("energy"))


@query()
def track_bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Poses after one step with two tracked points of every keyframe beside its pixels, each seen by all its neighbours."""
    scene, pairs, targets = _scene(spark, sf_dir)
    from_ = pairs.where("vi = 0 and vj = 0")
    spots = F.explode(F.array(*[F.struct(F.lit(n).cast("long").alias("n"), F.lit(x).alias("x"), F.lit(y).alias("y")) for n, x, y in ((0, 20.5, 12.25), (1, 41.0, 44.75))]))
    tracks = from_.select("graph", "i").distinct().withColumn("s", spots)
    tracks = tracks.select("graph", "i", F.lit(0).cast("long").alias("v"), (2 * F.col("i") + F.col("s.n")).alias("track"), "s.x", "s.y", F.lit(1.0).alias("disp"), F.lit(0.05).alias("eta"))
    apart = F.col("j") - F.col("i")
    seen = tracks.join(from_, ["graph", "i"]).select("graph", "i", "vi", "j", "vj", "track", (F.col("x") + 0.2 * apart).alias("tu"), (F.col("y") - 0.1 * apart).alias("tv"), F.lit(0.05).alias("wu"), F.lit(0.05).alias("wv"))
    scene, targets = rig_bundle.with_tracks(scene, targets, tracks, seen)
    scene, _ = rig_bundle.adjusted(scene, pairs, targets, rig_bundle.Settings(pose=(1e-2, 1.0), alpha=0.05, factor=8.0))
    return scene.frames.select("k", *[(F.round(m, 4) + F.lit(0.0)).alias(m) for m in g.Pose._fields])
