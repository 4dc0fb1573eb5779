"""Operators over the neighbours of a pixel: morphology, reliability, splats, resampling.

Each expands a pixel to its taps and meets them by an equi-join or a grouping on
(frame_idx, r, c), so frames spread over the cluster and no frame has to fit a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framequery.sources.frames import SIDE

KEY = ["frame_idx", "r", "c"]


def offsets(radius: int) -> Column:
    """All (dr, dc) within ``radius``."""
    return F.array(*[F.struct(F.lit(a).alias("dr"), F.lit(b).alias("dc")) for a in range(-radius, radius + 1) for b in range(-radius, radius + 1)])


def scattered(pixels: DataFrame, radius: int, values: list[str], side: int = SIDE) -> DataFrame:
    """Each pixel's values sent to every pixel within ``radius`` inside the frame: no join, one grouping follows."""
    sent = pixels.select("frame_idx", "r", "c", *values, F.explode(offsets(radius)).alias("o"))
    sent = sent.select("frame_idx", (F.col("r") + F.col("o.dr")).alias("r"), (F.col("c") + F.col("o.dc")).alias("c"), *values)
    return sent.where(F.col("r").between(0, side - 1) & F.col("c").between(0, side - 1))


def eroded(pixels: DataFrame, value: str, radius: int = 1) -> DataFrame:
    """Least value of the square around each pixel. Repeating border pixels outward adds no new value, so they are left out."""
    return scattered(pixels, radius, [value]).groupBy(*KEY).agg(F.min(value).alias(value))


def dilated(pixels: DataFrame, value: str, radius: int = 1) -> DataFrame:
    return scattered(pixels, radius, [value]).groupBy(*KEY).agg(F.max(value).alias(value))


def reliable(pixels: DataFrame, threshold: float = 0.1, radius: int = 2) -> DataFrame:
    """(frame_idx, r, c) whose depth varies by less than ``threshold`` of its mean around it.

    The mean counts pixels outside the frame as nought.
    """
    n = (2 * radius + 1) ** 2
    around = scattered(pixels, radius, ["depth"]).groupBy(*KEY).agg(F.max("depth").alias("hi"), F.min("depth").alias("lo"), F.sum("depth").alias("total"))
    return around.where((F.col("hi") - F.col("lo")) / (F.col("total") / n + 1e-8) < threshold).select(*KEY)


def bilinear_taps(u: Column, v: Column) -> Column:
    """The four pixels around (u, v) with their weights."""
    c, r = F.floor(u).cast("long"), F.floor(v).cast("long")
    wu, wv = u - c, v - r
    return F.array(*[F.struct((r + a).alias("r"), (c + b).alias("c"), ((wv if a else 1 - wv) * (wu if b else 1 - wu)).alias("w")) for a in (0, 1) for b in (0, 1)])


def sampled(points: DataFrame, pixels: DataFrame, value: str, keep: list[str]) -> DataFrame:
    """``value`` of the frames at points (frame_idx, u, v): bilinear, pixels outside counting as nought."""
    taps = points.select(*keep, "frame_idx", F.explode(bilinear_taps(F.col("u"), F.col("v"))).alias("t")).select(*keep, "frame_idx", "t.*")
    met = taps.join(pixels.select(*KEY, value), KEY, "left")
    return met.groupBy(*keep).agg(F.sum(F.col("w") * F.coalesce(value, F.lit(0.0))).alias(value))


def splatted(points: DataFrame, value: str, side: int = SIDE) -> DataFrame:
    """Points (frame_idx, u, v, value) spread over the four pixels around them; (value, weight) where any weight falls."""
    taps = points.select("frame_idx", value, F.explode(bilinear_taps(F.col("u"), F.col("v"))).alias("t")).select("frame_idx", value, "t.*")
    inside = taps.where(F.col("r").between(0, side - 1) & F.col("c").between(0, side - 1) & (F.col("w") > 0))
    return inside.groupBy(*KEY).agg((F.sum(F.col(value) * F.col("w")) / F.sum("w")).alias(value), F.sum("w").alias("weight"))


def resized(pixels: DataFrame, values: list[str], size: tuple[int, int], new: tuple[int, int]) -> DataFrame:
    """``values`` of frames of ``size`` (height, width) resampled bilinearly to ``new``, pixel centres aligned, borders repeated."""

    def axis(n0: int, n1: int, at: str) -> Column:
        """Where new pixels lie between old ones: (new, old, weight) pairs."""
        source = lambda k: min(max((k + 0.5) * n0 / n1 - 0.5, 0.0), n0 - 1.0)
        pairs = []
        for k in range(n1):
            low = int(source(k))
            for old, w in ((low, 1 - (source(k) - low)), (min(low + 1, n0 - 1), source(k) - low)):
                pairs.append((k, old, w))
        by_old = [F.array(*[F.struct(F.lit(k).cast("long").alias("k"), F.lit(float(w)).alias("w")) for k, old, w in pairs if old == o and w > 0]).cast("array<struct<k:bigint,w:double>>") for o in range(n0)]
        return F.explode(F.element_at(F.array(*by_old), F.col(at).cast("int") + 1))

    sent = pixels.select("frame_idx", "c", *values, axis(size[0], new[0], "r").alias("y")).select("frame_idx", "y", *values, axis(size[1], new[1], "c").alias("x"))
    w = F.col("y.w") * F.col("x.w")
    return sent.groupBy("frame_idx", F.col("y.k").alias("r"), F.col("x.k").alias("c")).agg(*[F.sum(F.col(v) * w).alias(v) for v in values])


def splatted_whole(points: DataFrame, values: list[str], height: int, width: int) -> DataFrame:
    """Sums of ``values`` times weight, and of the weight, of points (frame_idx, u, v) in image coordinates from 0 to the size.

    The four pixels start at the rounded-half-up corner, so weights may be negative and add
    up to one; a point counts only if all four lie inside. Pixels that get nothing give no
    row. Sums aren't divided.
    """
    c, r = F.floor(F.col("u") + 0.5).cast("long"), F.floor(F.col("v") + 0.5).cast("long")
    wu, wv = F.col("u") - c, F.col("v") - r
    taps = F.array(*[F.struct((r + a).alias("r"), (c + b).alias("c"), ((wv if a else 1 - wv) * (wu if b else 1 - wu)).alias("w")) for a in (0, 1) for b in (0, 1)])
    inside = points.where(c.between(0, width - 2) & r.between(0, height - 2))
    sent = inside.select("frame_idx", *values, F.explode(taps).alias("t")).select("frame_idx", *values, "t.*")
    return sent.groupBy(*KEY).agg(*[F.sum(F.col(x) * F.col("w")).alias(x) for x in values], F.sum("w").alias("weight"))
