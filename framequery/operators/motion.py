"""How far frames have moved, by dense flow and by tracks, and the points that stand out in them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import neighbourhood as n
from .written import written


def dense_motion(flow: DataFrame, eps: float = 1e-6) -> DataFrame:
    """(frame_idx, motion): of each view of (frame_idx, view_idx, size, weight) the weighted mean, and of a frame's views the least.

    A view without weight has motion 0. Null sizes and weights count as nought.
    """
    size, w = F.coalesce("size", F.lit(0.0)), F.coalesce("weight", F.lit(0.0))
    views = flow.groupBy("frame_idx", "view_idx").agg((F.avg(size * w) / (F.avg(w) + eps)).alias("m"))
    return views.groupBy("frame_idx").agg(F.min("m").alias("motion"))


def track_motion(tracks: DataFrame, lost: float = 0.2, forced: float = 100.0) -> DataFrame:
    """(frame_idx, n, motion): how many points a frame shares with the one before, and their mean shifts summed over views.

    ``tracks`` has (view_idx, frame_idx, kp_id, u, v), one row a point of a view's frame. Where more than the share
    ``lost`` of the points shared one frame earlier are gone, ``forced`` is added. The first frame, and one whose
    predecessor is missing, share nothing and have motion 0.
    """
    old = tracks.select("view_idx", (F.col("frame_idx") + 1).alias("frame_idx"), "kp_id", F.col("u").alias("u0"), F.col("v").alias("v0"))
    shift = F.sqrt((F.col("u") - F.col("u0")) * (F.col("u") - F.col("u0")) + (F.col("v") - F.col("v0")) * (F.col("v") - F.col("v0")))
    views = tracks.join(old, ["view_idx", "frame_idx", "kp_id"]).groupBy("frame_idx", "view_idx").agg(F.count(F.lit(1)).alias("n"), F.avg(shift).alias("d"))
    shared = views.groupBy("frame_idx").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))
    every = tracks.select("frame_idx").distinct().join(shared, "frame_idx", "left").select("frame_idx", F.coalesce("n", F.lit(0)).cast("long").alias("n"), F.coalesce("d", F.lit(0.0)).alias("d"))
    every = written(every, "shared")
    before = every.select((F.col("frame_idx") + 1).alias("frame_idx"), F.col("n").alias("n0"))
    gone = F.col("n0") - F.col("n") > lost * F.col("n0")
    return every.join(before, "frame_idx", "left").select("frame_idx", "n", (F.col("d") + F.when(gone & (F.col("n0") > 0), forced).otherwise(0.0)).alias("motion"))


def refined_peaks(pixels: DataFrame, value: str, radius: int = 1, rounds: int = 2) -> DataFrame:
    """(frame_idx, r, c, value) of peaks: pixels that none within ``radius`` exceeds, and then those that stand out once peaks' surroundings count as nought.

    Each round is a maximum over a neighbourhood, which deals a pixel to its window and groups once.
    """
    px = pixels.select(*n.KEY, F.col(value).alias("x"))
    over = lambda rows, c: n.dilated(rows.select(*n.KEY, c), c, radius).withColumnRenamed(c, "__top")
    state = px.join(over(px, "x"), n.KEY).select(*n.KEY, "x", (F.col("x") == F.col("__top")).cast("int").alias("peak"))
    for _ in range(rounds):
        state = written(state, "peaks")
        hidden = state.join(over(state, "peak").withColumnRenamed("__top", "near"), n.KEY)
        hidden = hidden.withColumn("left", F.when(F.col("near") > 0, 0.0).otherwise(F.col("x")))
        met = hidden.join(over(hidden, "left"), n.KEY)
        again = (F.col("left") == F.col("__top")) & (F.col("near") == 0)
        state = met.select(*n.KEY, "x", F.when(again, 1).otherwise(F.col("peak")).alias("peak"))
    return state.where("peak = 1").select(*n.KEY, F.col("x").alias(value))
