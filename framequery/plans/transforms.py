"""Queries over similarities, rigs, means and resampled frames."""

from __future__ import annotations

from math import pi

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framequery.functions import geometry as g
from framequery.operators import alignment, resampling
from framequery.operators import neighbourhood as n
from framequery.sources.frames import SIDE, grid, poses, sql

from .catalog import query
from .joins import _ROT

_ROWS = "rot AS (SELECT frame_idx, tx, ty, tz, " + ", ".join(f"{e} AS m{k}" for k, e in _ROT.items()) + " FROM poses)"


@query(sql("poses", "SELECT frame_idx, " + ", ".join(f"round((1.5 + tx) * (m{k}0 * ty + m{k}1 * tz + m{k}2) + t{x}, 6) + 0.0 AS {x}" for k, x in enumerate("xyz")) + " FROM rot", _ROWS))
def sim3_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A point moved by each frame's pose with a scale."""
    s = g.Similarity(g.pose(), 1.5 + F.col("tx"))
    x = g.sim3_act(s, (F.col("ty"), F.col("tz"), F.lit(1.0)))
    return poses(spark, sf_dir).select("frame_idx", *[g.r6(v).alias(a) for a, v in zip("xyz", x, strict=True)])


@query(sql("poses", "SELECT frame_idx, " + ", ".join(f"round(m{k}0 * qx + m{k}1 * qy + m{k}2 * qz, 6) + 0.0 AS p{k}" for k in range(3)) + ", " + ", ".join(f"round(m{k}0 * tx + m{k}1 * ty + m{k}2 * tz + t{a} * (m{o}0 * qx + m{o}1 * qy + m{o}2 * qz) - t{b} * (m{p}0 * qx + m{p}1 * qy + m{p}2 * qz), 6) + 0.0 AS s{k}" for k, a, o, b, p in ((0, "y", 2, "z", 1), (1, "z", 0, "x", 2), (2, "x", 1, "y", 0))) + " FROM rot JOIN (SELECT frame_idx, qx, qy, qz FROM poses) USING (frame_idx)", _ROWS))
def se3_adjoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A twist made of each pose's own numbers, taken through the pose."""
    tau, phi = g.adjoint(g.pose(), (F.col("tx"), F.col("ty"), F.col("tz")), (F.col("qx"), F.col("qy"), F.col("qz")))
    return poses(spark, sf_dir).select("frame_idx", *[g.r6(v).alias(f"p{k}") for k, v in enumerate(phi)], *[g.r6(v).alias(f"s{k}") for k, v in enumerate(tau)])


_VIEWS = [(k, 2 * pi * k / 4, 0.0) for k in range(4)] + [(4, 0.0, pi / 2), (5, 0.0, -pi / 2)]
_RIG = (
    "SELECT frame_idx, view, round(qw * x + qx * w + qy * z - qz * y, 6) + 0.0 AS qx, round(qw * y - qx * z + qy * w + qz * x, 6) + 0.0 AS qy, "
    "round(qw * z + qx * y - qy * x + qz * w, 6) + 0.0 AS qz, round(qw * w - qx * x - qy * y - qz * z, 6) + 0.0 AS qw FROM poses, "
    "(SELECT view, s * cos(yaw / 2) * sin(pitch / 2) AS x, s * sin(yaw / 2) * cos(pitch / 2) AS y, -s * sin(yaw / 2) * sin(pitch / 2) AS z, s * cos(yaw / 2) * cos(pitch / 2) AS w FROM "
    "(SELECT *, CASE WHEN cos(yaw / 2) * cos(pitch / 2) < 0 THEN -1.0::DOUBLE ELSE 1 END AS s FROM (VALUES " + ", ".join(f"({k}::BIGINT, {y!r}::DOUBLE, {p!r}::DOUBLE)" for k, y, p in _VIEWS) + ") v(view, yaw, pitch)))"
)


def rig_views(frames: DataFrame, n_views: int = 4, top: bool = True, bottom: bool = True) -> DataFrame:
    """Each posed frame once for every view of a panorama's rig: ``n_views`` around, one up, one down."""
    views = [(k, 2 * pi * k / n_views, 0.0) for k in range(n_views)]
    views += [(len(views), 0.0, pi / 2)] if top else []
    views += [(len(views), 0.0, -pi / 2)] if bottom else []
    each = F.array(*[F.struct(F.lit(k).cast("long").alias("view"), F.lit(y).alias("yaw"), F.lit(p).alias("pitch")) for k, y, p in views])
    rows = frames.withColumn("__v", F.explode(each))
    zero = F.lit(0.0)
    turned = g.compose(g.pose(), g.Pose(zero, zero, zero, *g.yaw_pitch(F.col("__v.yaw"), F.col("__v.pitch"))))
    return rows.select("frame_idx", F.col("__v.view").alias("view"), *[c.alias(m) for m, c in turned.named().items()])


@query(sql("poses", _RIG))
def rig_poses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rotation of each of six views of every frame."""
    return rig_views(poses(spark, sf_dir)).select("frame_idx", "view", *[g.r6(F.col(c)).alias(c) for c in ("qx", "qy", "qz", "qw")])


@query()
def pose_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mean pose of every fifty frames; a test holds it against an eigenvector."""
    m = alignment.mean_poses(poses(spark, sf_dir).withColumn("block", F.floor(F.col("frame_idx") / 50)), "block")
    return m.select("block", "n", *[g.r6(F.col(c)).alias(c) for c in g.Pose._fields])


_AXIS = "SELECT k, s, floor(s)::BIGINT AS lo, s - floor(s) AS f FROM (SELECT k, least(greatest((k + 0.5) * 8 / 5.0::DOUBLE - 0.5, 0), 7) AS s FROM range(5) t(k))"


@query(sql("grid", "SELECT g.frame_idx, ya.k AS r, xa.k AS c, round(sum(g.depth * ya.w * xa.w), 6) + 0.0 AS depth, sum(CASE WHEN g.mask THEN ya.w * xa.w ELSE 0 END) > 0.9 AS mask FROM grid g JOIN ax ya ON ya.o = g.r JOIN ax xa ON xa.o = g.c GROUP BY ALL", f"ax AS (SELECT k, lo AS o, 1 - f AS w FROM ({_AXIS}) UNION ALL SELECT k, lo + 1, f FROM ({_AXIS}) WHERE f > 0)"))
def resize_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Depths of frames made five pixels wide and high, and masks that hold where over 0.9 of a pixel is masked."""
    px = grid(spark, sf_dir).select("frame_idx", "r", "c", "depth", F.col("mask").cast("double").alias("covered"))
    out = n.resized(px, ["depth", "covered"], (SIDE, SIDE), (5, 5))
    return out.select("frame_idx", "r", "c", g.r6(F.col("depth")).alias("depth"), (F.col("covered") > 0.9).alias("mask"))


_CORNERS = "SELECT frame_idx, disp, x0 + b AS c, y0 + a AS r, (CASE WHEN b = 1 THEN u - x0 ELSE 1 - (u - x0) END) * (CASE WHEN a = 1 THEN w - y0 ELSE 1 - (w - y0) END) AS wt FROM (SELECT *, floor(u + 0.5)::BIGINT AS x0, floor(w + 0.5)::BIGINT AS y0 FROM (SELECT frame_idx, disp, c + 0.8::DOUBLE * v AS u, r - 0.6::DOUBLE * v AS w FROM grid)), (VALUES (0), (1)) a(a), (VALUES (0), (1)) b(b) WHERE x0 BETWEEN 0 AND 6 AND y0 BETWEEN 0 AND 6"


@query(sql("grid", f"SELECT frame_idx, r, c, round(sum(disp * wt), 6) + 0.0 AS disp, round(sum(wt), 6) + 0.0 AS weight FROM ({_CORNERS}) GROUP BY ALL"))
def bilinear_splat_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Undivided sums of points spread over the four pixels from their rounded corner, where all four lie inside."""
    px = grid(spark, sf_dir).select("frame_idx", "disp", (F.col("c") + 0.8 * F.col("v")).alias("u"), (F.col("r") - 0.6 * F.col("v")).alias("v"))
    out = n.splatted_whole(px, ["disp"], SIDE, SIDE)
    return out.select("frame_idx", "r", "c", g.r6(F.col("disp")).alias("disp"), g.r6(F.col("weight")).alias("weight"))


@query(sql("poses", "SELECT frame_idx, " + ", ".join(f"round(t{a} - 0.5 * d{a} + k * e{a}, 6) + 0.0 AS {a}" for a in "xyz") + " FROM ("
    "SELECT *, 1 / n2 - (1 + cos(sqrt(n2))) / (2 * sqrt(n2) * sin(sqrt(n2))) AS k, py * dz - pz * dy AS ex, pz * dx - px * dz AS ey, px * dy - py * dx AS ez FROM ("
    "SELECT *, px * px + py * py + pz * pz AS n2, py * tz - pz * ty AS dx, pz * tx - px * tz AS dy, px * ty - py * tx AS dz FROM ("
    "SELECT frame_idx, tx, ty, tz, 10 * qx AS px, 10 * qy AS py, 10 * qz AS pz FROM poses)))"))  # fmt: skip
def so3_inverse_jacobian(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The inverse left Jacobian of a rotation vector of ten times each pose's, applied to its translation."""
    p = poses(spark, sf_dir)
    x = g.so3_jinv(tuple(10 * F.col(f"q{a}") for a in "xyz"), tuple(F.col(f"t{a}") for a in "xyz"))
    return p.select("frame_idx", *[g.r6(v).alias(a) for a, v in zip("xyz", x, strict=True)])


@query(sql("poses", "SELECT frame_idx, " + ", ".join(f"round({c}, 6) + 0.0 AS {c}" for c in g.Pose._fields) + ", round(exp(5 * tx), 6) + 0.0 AS scale FROM poses"))
def sim3_exp_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exponential of the logarithm gives each similarity back."""
    tau, phi, sigma = g.sim3_log(g.Similarity(g.pose(), F.exp(5 * F.col("tx"))))
    twist = poses(spark, sf_dir).select("frame_idx", *[c.alias(f"x{k}") for k, c in enumerate((*tau, *phi, sigma))])
    x = [F.col(f"x{k}") for k in range(7)]
    s = g.sim3_exp(tuple(x[:3]), tuple(x[3:6]), x[6])
    return twist.select("frame_idx", *[g.r6(c).alias(n) for n, c in s.pose.named().items()], g.r6(s.scale).alias("scale"))


_PANORAMA = (
    "spot AS (SELECT frame_idx, r, c, 8 * (atan2(x, z) / (2 * pi()) + 0.5) - 0.5 AS u, 8 * acos(-y / sqrt(x * x + y * y + z * z)) / pi() - 0.5 AS w FROM ("
    "SELECT frame_idx, r, c, " + ", ".join(f"m{k}0 * (c - 4) / 2.0::DOUBLE + m{k}1 * (r - 4) / 2.0::DOUBLE + m{k}2 AS {x}" for k, x in enumerate("xyz")) + " FROM rot, range(8) a(r), range(8) b(c))), "
    "taps AS (SELECT spot.*, (((floor(u)::BIGINT + ox) % 8) + 8) % 8 AS pc, greatest(0, least(7, floor(w)::BIGINT + oy)) AS pr, "
    "(CASE WHEN ox = 1 THEN u - floor(u) ELSE 1 - u + floor(u) END) * (CASE WHEN oy = 1 THEN w - floor(w) ELSE 1 - w + floor(w) END) AS share FROM spot, range(2) a(ox), range(2) b(oy))"
)


@query(sql("grid poses", "SELECT t.frame_idx, t.r, t.c, round(sum(share * v), 5) + 0.0 AS v FROM taps t JOIN grid p ON p.frame_idx = t.frame_idx AND p.r = pr AND p.c = pc GROUP BY ALL", _ROWS, _PANORAMA))
def panorama_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A perspective view, as each pose turns it, of every frame's grid taken as a panorama that closes on itself."""
    eight = F.sequence(F.lit(0).cast("long"), F.lit(7).cast("long"))
    px = poses(spark, sf_dir).withColumn("r", F.explode(eight)).withColumn("c", F.explode(eight))
    ray = ((F.col("c") - 4) / 2, (F.col("r") - 4) / 2, F.lit(1.0))
    u, w = g.panorama_project(g.rotate(g.pose().q, ray))
    # one struct a row: plain columns would be computed anew wherever they are used
    asked = px.select("frame_idx", "r", "c", F.explode(F.array(F.struct(u.alias("u"), w.alias("w")))).alias("at")).select("frame_idx", "r", "c", "at.u", "at.w")
    found = resampling.panorama_sampled(asked, grid(spark, sf_dir).select("frame_idx", F.col("r").alias("pr"), F.col("c").alias("pc"), "v"), "frame_idx", "v", 8, 8)
    return found.select("frame_idx", "r", "c", (F.round("v", 5) + F.lit(0.0)).alias("v"))
