"""Queries of pose and camera arithmetic, one row in and one row out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framequery.functions import geometry as g
from framequery.sources.frames import grid, poses, sql, streams

from .catalog import query

CAM = g.Camera(8.0, 8.0, 4.0, 4.0)
_MATRIX = {"m00": "1 - 2 * (qy * qy + qz * qz)", "m01": "2 * (qx * qy - qz * qw)", "m02": "2 * (qx * qz + qy * qw)", "m03": "tx", "m10": "2 * (qx * qy + qz * qw)", "m11": "1 - 2 * (qx * qx + qz * qz)", "m12": "2 * (qy * qz - qx * qw)", "m13": "ty", "m20": "2 * (qx * qz - qy * qw)", "m21": "2 * (qy * qz + qx * qw)", "m22": "1 - 2 * (qx * qx + qy * qy)", "m23": "tz"}
_ROUNDED = ", ".join(f"round({e}, 6) + 0.0 AS {n}" for n, e in _MATRIX.items())
_ROTATION = {k: v for k, v in _MATRIX.items() if not k.endswith("3")}
_INVERSE_T = [f"-({' + '.join(f'm{k}{i} * {t}' for k, t in enumerate(('tx', 'ty', 'tz')))})" for i in range(3)]
_WITH_MATRIX = "m AS (SELECT *, " + ", ".join(f"{e} AS {n}" for n, e in _ROTATION.items()) + " FROM poses)"


def _rounded(**columns: Column) -> list[Column]:
    return [g.r6(c).alias(n) for n, c in columns.items()]


@query(sql("poses", f"SELECT frame_idx, {_ROUNDED} FROM poses"))
def pose_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Camera-to-world matrices, three rows of four."""
    return poses(spark, sf_dir).select("frame_idx", *_rounded(**dict(zip(_MATRIX, g.matrix(g.pose()), strict=True))))


@query(sql("poses", "SELECT frame_idx, " + ", ".join(f"round({c}, 6) + 0.0 AS {c}" for c in ("tx", "ty", "tz", "qx", "qy", "qz", "qw")) + " FROM poses"))
def pose_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Poses through their matrices and back; the scalar part of these is positive."""
    p = poses(spark, sf_dir)
    m = p.select("frame_idx", *[c.alias(n) for n, c in zip(_MATRIX, g.matrix(g.pose()), strict=True)])
    q = g.quaternion([F.col(n) for n in _ROTATION])
    return m.select("frame_idx", *_rounded(tx=F.col("m03"), ty=F.col("m13"), tz=F.col("m23"), qx=q[0], qy=q[1], qz=q[2], qw=q[3]))


@query(sql("poses", f"SELECT frame_idx, round({_INVERSE_T[0]}, 6) + 0.0 AS tx, round({_INVERSE_T[1]}, 6) + 0.0 AS ty, round({_INVERSE_T[2]}, 6) + 0.0 AS tz, round(-qx, 6) + 0.0 AS qx, round(-qy, 6) + 0.0 AS qy, round(-qz, 6) + 0.0 AS qz, round(qw, 6) + 0.0 AS qw FROM m", _WITH_MATRIX))
def se3_inverse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return poses(spark, sf_dir).select("frame_idx", *_rounded(**g.inverse(g.pose()).named()))


_NEXT = "pairs AS (SELECT a.*, " + ", ".join(f"b.{c} AS b{c}" for c in ("tx", "ty", "tz", "qx", "qy", "qz", "qw")) + " FROM m a JOIN poses b ON b.frame_idx = a.frame_idx + 1)"


@query(
    sql(
        "poses",
        "SELECT frame_idx, " + ", ".join(f"round(m{i}0 * btx + m{i}1 * bty + m{i}2 * btz + {t}, 6) + 0.0 AS {t}" for i, t in enumerate(("tx", "ty", "tz"))) + ", round(qw * bqx + qx * bqw + qy * bqz - qz * bqy, 6) + 0.0 AS qx, round(qw * bqy - qx * bqz + qy * bqw + qz * bqx, 6) + 0.0 AS qy, round(qw * bqz + qx * bqy - qy * bqx + qz * bqw, 6) + 0.0 AS qz, round(qw * bqw - qx * bqx - qy * bqy - qz * bqz, 6) + 0.0 AS qw FROM pairs",
        _WITH_MATRIX,
        _NEXT,
    )
)
def se3_compose(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each frame's pose after the next one's."""
    p = poses(spark, sf_dir)
    nxt = p.select((F.col("frame_idx") - 1).alias("frame_idx"), *[c.alias(f"b{n}") for n, c in g.pose().named().items()])
    return p.join(nxt, "frame_idx").select("frame_idx", *_rounded(**g.compose(g.pose(), g.pose("b")).named()))


@query(sql("poses", "SELECT frame_idx, " + ", ".join(f"round({c}, 6) + 0.0 AS {c}" for c in ("tx", "ty", "tz", "qx", "qy", "qz", "qw")) + " FROM poses"))
def se3_exp_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exponential of the logarithm gives the pose back."""
    tau, phi = g.se3_log(g.pose())
    twist = poses(spark, sf_dir).select("frame_idx", *[c.alias(f"x{k}") for k, c in enumerate((*tau, *phi))])
    x = [F.col(f"x{k}") for k in range(6)]
    return twist.select("frame_idx", *_rounded(**g.se3_exp(tuple(x[:3]), tuple(x[3:])).named()))


@query(sql("poses", "SELECT frame_idx, round(atan2(s, qw) * 2 / s * qx, 6) + 0.0 AS rx, round(atan2(s, qw) * 2 / s * qy, 6) + 0.0 AS ry, round(atan2(s, qw) * 2 / s * qz, 6) + 0.0 AS rz FROM (SELECT *, sqrt(qx * qx + qy * qy + qz * qz) AS s FROM poses)"))
def so3_logarithm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return poses(spark, sf_dir).select("frame_idx", *_rounded(**dict(zip(("rx", "ry", "rz"), g.so3_log(g.pose().q), strict=True))))


@query(sql("poses", "SELECT frame_idx, " + ", ".join(f"round(m{i}0 * 1 + m{i}1 * 2 + m{i}2 * 3, 6) + 0.0 AS {a}" for i, a in enumerate("xyz")) + ", " + ", ".join(f"round(1.5 * (m{i}0 * 1 + m{i}1 * 2 + m{i}2 * 3) + {t}, 6) + 0.0 AS s{a}" for i, (a, t) in enumerate(zip("xyz", ("tx", "ty", "tz"), strict=True))) + " FROM m", _WITH_MATRIX))
def so3_act(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The point (1, 2, 3) rotated, and under a similarity of scale 1.5."""
    p = g.pose()
    at = g.rotate(p.q, (F.lit(1.0), F.lit(2.0), F.lit(3.0)))
    s = g.add(g.scale(at, 1.5), p.t)
    return poses(spark, sf_dir).select("frame_idx", *_rounded(x=at[0], y=at[1], z=at[2], sx=s[0], sy=s[1], sz=s[2]))


@query(sql("grid", "SELECT frame_idx, r, c, round((c - 4) / 8.0::DOUBLE * depth, 6) + 0.0 AS x, round((r - 4) / 8.0::DOUBLE * depth, 6) + 0.0 AS y, round(depth, 6) + 0.0 AS z FROM grid"))
def iproj_pinhole(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = g.scale(CAM.ray(F.col("c").cast("double"), F.col("r").cast("double")), F.col("depth"))
    return grid(spark, sf_dir).select("frame_idx", "r", "c", *_rounded(x=x[0], y=x[1], z=x[2]))


_POINT = "SELECT frame_idx, r, c, 3 * v AS x, v * v - 0.01 AS y, depth - 0.95 AS z FROM grid"


def _points(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, g.Vec]:
    """Points some of which lie too near or behind."""
    v = F.col("v")
    return grid(spark, sf_dir), (3 * v, v * v - 0.01, F.col("depth") - 0.95)


@query(sql("grid", f"SELECT frame_idx, r, c, round(8 * x / CASE WHEN z < 0.1 THEN 1 ELSE z END + 4, 6) + 0.0 AS u, round(8 * y / CASE WHEN z < 0.1 THEN 1 ELSE z END + 4, 6) + 0.0 AS w, z > 0.1 AS seen FROM ({_POINT})"))
def project_pinhole(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, x = _points(spark, sf_dir)
    u, w, seen = CAM.project(x)
    return df.select("frame_idx", "r", "c", *_rounded(u=u, w=w), seen.alias("seen"))


@query(sql("grid", f"SELECT frame_idx, r, c, round(8 * x / (d + 0.1 * sqrt(x * x + y * y + d * d)) + 4, 6) + 0.0 AS u, round(8 * y / (d + 0.1 * sqrt(x * x + y * y + d * d)) + 4, 6) + 0.0 AS w, z > 0.1 AS seen FROM (SELECT *, CASE WHEN z < 0.1 THEN 1 ELSE z END AS d FROM ({_POINT}))"))
def project_mei(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, x = _points(spark, sf_dir)
    u, w, seen = g.unified_project(CAM, F.lit(0.1), x)
    return df.select("frame_idx", "r", "c", *_rounded(u=u, w=w), seen.alias("seen"))


@query(sql("grid", "SELECT frame_idx, r, c, round(x * f / (f - 0.1) * depth, 6) + 0.0 AS x, round(y * f / (f - 0.1) * depth, 6) + 0.0 AS y, round(depth, 6) + 0.0 AS z FROM (SELECT *, (0.1 + sqrt(1 + 0.99 * (x * x + y * y))) / (1 + x * x + y * y) AS f FROM (SELECT frame_idx, r, c, depth, (c - 4) / 8.0::DOUBLE AS x, (r - 4) / 8.0::DOUBLE AS y FROM grid))"))
def iproj_mei(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = g.scale(g.unified_ray(CAM, F.lit(0.1), F.col("c").cast("double"), F.col("r").cast("double")), F.col("depth"))
    return grid(spark, sf_dir).select("frame_idx", "r", "c", *_rounded(x=x[0], y=x[1], z=x[2]))


@query(sql("grid", "SELECT frame_idx, r, c, round(atan2(x, z) / (2 * pi()) + 0.5, 6) + 0.0 AS u, round(acos(-y / sqrt(x * x + y * y + z * z)) / pi(), 6) + 0.0 AS w FROM (SELECT frame_idx, r, c, (c - 4) / 8.0::DOUBLE AS x, (r - 4) / 8.0::DOUBLE AS y, depth AS z FROM grid)"))
def project_panorama(spark: SparkSession, sf_dir: str) -> DataFrame:
    u, w = g.panorama_project(((F.col("c") - 4) / 8, (F.col("r") - 4) / 8, F.col("depth")))
    return grid(spark, sf_dir).select("frame_idx", "r", "c", *_rounded(u=u, w=w))


@query(sql("grid", "SELECT frame_idx, r, c, round(x / n, 6) + 0.0 AS x, round(y / n, 6) + 0.0 AS y, round(1 / n, 6) + 0.0 AS z FROM (SELECT *, sqrt(x * x + y * y + 1) AS n FROM (SELECT frame_idx, r, c, (c - 4) / 8.0::DOUBLE AS x, (r - 4) / 8.0::DOUBLE AS y FROM grid))"))
def camera_rays(spark: SparkSession, sf_dir: str) -> DataFrame:
    ray = CAM.ray(F.col("c").cast("double"), F.col("r").cast("double"))
    unit = g.scale(ray, 1 / F.sqrt(g.dot(ray, ray)))
    return grid(spark, sf_dir).select("frame_idx", "r", "c", *_rounded(x=unit[0], y=unit[1], z=unit[2]))


@query("SELECT vec_id AS frame_idx, round(8 / (2 * tan((0.5 + 0.01 * (label + 1))::DOUBLE / 2)), 6) + 0.0 AS fx, 4.0::DOUBLE AS cx, round(degrees(2 * atan(8 / (2 * (8 / (2 * tan((0.5 + 0.01 * (label + 1))::DOUBLE / 2)))))), 6) + 0.0 AS fov_degrees FROM embeddings")
def intrinsics_from_fov(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Focal length from a field of view, and the field of view back in degrees."""
    fov = 0.5 + 0.01 * (F.col("label") + 1)
    f = g.focal_from_fov(F.lit(8.0), fov)
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return e.select(F.col("vec_id").alias("frame_idx"), g.r6(f).alias("fx"), F.lit(4.0).alias("cx"), g.r6(F.degrees(2 * F.atan(8 / (2 * f)))).alias("fov_degrees"))


@query(sql("grid", "SELECT frame_idx, r, c, round(depth * 500 / 1000, 6) + 0.0 AS canonical, round(depth * 500 / 504 * 504 / 300, 6) + 0.0 AS focal_scaled FROM grid"))
def depth_canonical_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("depth")
    return grid(spark, sf_dir).select("frame_idx", "r", "c", *_rounded(canonical=d * 500 / 1000, focal_scaled=d * 500 / 504 * 504 / 300))


@query(sql("streams", "SELECT stream_id, frame_idx, round(CASE WHEN x <= 0.5 THEN 1 ELSE 0.5 / x END, 6) + 0.0 AS huber, round(CASE WHEN x <= 2 THEN (1 - x * x / 4) * (1 - x * x / 4) ELSE 0 END, 6) + 0.0 AS tukey, round(CASE WHEN x * x <= 1.0 / 3 * 2 THEN 1 WHEN x * x >= 6 THEN 0 ELSE sqrt(1.5 / (x * x)) - 0.5 END, 6) + 0.0 AS gnc FROM (SELECT stream_id, frame_idx, score / 10 AS x FROM streams)"))
def robust_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights of residuals under three robust kernels."""
    x = F.col("score") / 10
    return streams(spark, sf_dir).select("stream_id", "frame_idx", *_rounded(huber=g.huber(x, 0.5), tukey=g.tukey(x, 2.0), gnc=g.truncated_gnc(x * x, 2.0, 0.5)))


@query(sql("poses", "SELECT frame_idx, round(m00, 9) + 0.0 AS m00, format('{:d} {:.4f} {:.4f} {:.4f} {:.4f}', frame_idx + 1, round(qw, 4) + 0.0, round(-qx, 4) + 0.0, round(-qy, 4) + 0.0, round(-qz, 4) + 0.0) AS line FROM m", _WITH_MATRIX))
def colmap_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Image lines for a reconstruction file: world-to-camera rotation, scalar first."""
    p = g.inverse(g.pose())
    q = [F.round(c, 4) + F.lit(0.0) for c in (p.qw, p.qx, p.qy, p.qz)]
    return poses(spark, sf_dir).select("frame_idx", (F.round(g.matrix(g.pose())[0], 9) + F.lit(0.0)).alias("m00"), F.format_string("%d %.4f %.4f %.4f %.4f", F.col("frame_idx") + 1, *q).alias("line"))
