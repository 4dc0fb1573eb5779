"""Measures between keyframes: how far pixels move along an edge, and where depths agree.

``pixels`` has (i, r, c, disp) and ``rel`` the pose (i, j, r_tx..r_qw) from keyframe i to j.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framequery.functions import geometry as g

#: Points nearer than this count as out of view here.
LEAST_DEPTH = 0.25
FAR = 1000.0


def _moved(pixels: DataFrame, rel: DataFrame, cam: g.Camera) -> DataFrame:
    """(i, j, r, c, disp, x, y, z, sx, sy, sz): each pixel's homogeneous point after the whole motion, and after its translation alone."""
    m = g.pose("r_")
    ray = cam.ray(F.col("c").cast("double"), F.col("r").cast("double"))
    shift = g.scale(m.t, F.col("disp"))
    whole, shifted = g.add(g.rotate(m.q, ray), shift), g.add(ray, shift)
    return pixels.join(rel, "i").select("i", "j", "r", "c", "disp", *[v.alias(a) for a, v in zip(("x", "y", "z", "sx", "sy", "sz"), (*whole, *shifted), strict=True)])


def frame_distance(pixels: DataFrame, rel: DataFrame, cam: g.Camera, beta: float = 0.3, least: float = 0.75, both_ways: bool = True) -> DataFrame:
    """(i, j, distance): the mean flow of an edge, ``beta`` of it by the whole motion and the rest by translation alone.

    Each part counts where its point lies in view; an edge of which less than the share
    ``least`` does is FAR. ``both_ways`` takes the mean with the edge (j, i), which must be
    among the edges.
    """

    def part(x: str, y: str, z: str, weight: float) -> tuple[Column, Column]:
        du = cam.fx * F.col(x) / F.col(z) + cam.cx - F.col("c")
        dv = cam.fy * F.col(y) / F.col(z) + cam.cy - F.col("r")
        seen = F.col(z) > LEAST_DEPTH
        return F.when(seen, weight * F.sqrt(du * du + dv * dv)).otherwise(0.0), F.when(seen, weight).otherwise(0.0)

    parts = part("x", "y", "z", beta), part("sx", "sy", "sz", 1 - beta)
    sums = _moved(pixels, rel, cam).groupBy("i", "j").agg(F.sum(parts[0][0] + parts[1][0]).alias("way"), F.sum(parts[0][1] + parts[1][1]).alias("seen"), F.count(F.lit(1)).alias("n"))
    d = sums.select("i", "j", F.when(F.col("seen") / (F.col("n") + 1e-8) < least, FAR).otherwise(F.col("way") / F.col("seen")).alias("distance"))
    if not both_ways:
        return d
    back = d.select(F.col("j").alias("i"), F.col("i").alias("j"), F.col("distance").alias("back"))
    return d.join(back, ["i", "j"]).select("i", "j", (0.5 * (F.col("distance") + F.col("back"))).alias("distance"))


def agreements(pixels: DataFrame, rel: DataFrame, cam: g.Camera, height: int, width: int, threshold: float) -> DataFrame:
    """(i, r, c, agree, met): in how many neighbours a pixel falls between four pixels, and one of these has much the same depth."""
    at = _moved(pixels, rel, cam)
    u0, v0 = F.floor(cam.fx * F.col("x") / F.col("z") + cam.cx).cast("long"), F.floor(cam.fy * F.col("y") / F.col("z") + cam.cy).cast("long")
    inside = u0.between(0, width - 2) & v0.between(0, height - 2)
    taps = F.array(*[F.struct((v0 + a).alias("r"), (u0 + b).alias("c")) for a in (0, 1) for b in (0, 1)])
    sent = at.where(inside).select("i", "j", "r", "c", (F.col("z") / F.col("disp")).alias("depth"), F.explode(taps).alias("t"))
    there = pixels.select(F.col("i").alias("j"), F.col("r").alias("tr"), F.col("c").alias("tc"), (1 / F.col("disp")).alias("other"))
    met = sent.select("i", "j", "r", "c", "depth", F.col("t.r").alias("tr"), F.col("t.c").alias("tc")).join(there, ["j", "tr", "tc"])
    by_edge = met.groupBy("i", "j", "r", "c").agg(F.max((F.abs(F.col("depth") - F.col("other")) < threshold).cast("long")).alias("hit"))
    counted = by_edge.groupBy("i", "r", "c").agg(F.sum("hit").alias("agree"), F.count(F.lit(1)).alias("met"))
    zero = F.lit(0).cast("long")
    return pixels.select("i", "r", "c").join(counted, ["i", "r", "c"], "left").select("i", "r", "c", F.coalesce("agree", zero).alias("agree"), F.coalesce("met", zero).alias("met"))
