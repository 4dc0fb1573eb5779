"""Queries that match frames, keyframes, tracks and pixels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framequery.functions import geometry as g
from framequery.operators import frame_graph, lookups
from framequery.sources.frames import SIDE, edges, grid, keyframes, poses, sql, streams, tracks

from .catalog import query

CAM = g.Camera(8.0, 8.0, 4.0, 4.0)
_EKF = "ekf AS (SELECT stream_id, ts, raw_frame_idx FROM streams WHERE phrase = 'signup')"


@query(sql("streams", "SELECT s.stream_id, s.frame_idx, e.raw_frame_idx AS keyframe FROM streams s ASOF LEFT JOIN ekf e ON s.stream_id = e.stream_id AND s.ts >= e.ts", _EKF))
def asof_keyframe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last sign-up at or before each frame of a stream."""
    s = streams(spark, sf_dir).select("stream_id", "frame_idx", "raw_frame_idx", "ts")
    marks = streams(spark, sf_dir).where("phrase = 'signup'")
    return lookups.as_of(s, marks, "stream_id", ["ts", "raw_frame_idx"], "raw_frame_idx", "keyframe").select("stream_id", "frame_idx", "keyframe")


@query(sql("keyframes", "SELECT vec_id AS frame_idx, vec_id // 5 AS k0, least(vec_id // 5 + 1, (SELECT max(kf_idx) FROM keyframes)) AS k1 FROM embeddings"))
def asof_bracket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keyframes on either side of each frame; the last stands for what follows it."""
    k = keyframes(spark, sf_dir)
    last = k.agg(F.max("kf_idx").alias("last"))
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").alias("frame_idx"))
    at = e.withColumn("k0", F.floor(F.col("frame_idx") / 5).cast("long"))
    return at.join(F.broadcast(last)).select("frame_idx", "k0", F.least(F.col("k0") + 1, "last").alias("k1"))


@query(sql("streams", "SELECT a.stream_id, a.frame_idx, round(a.score, 6) + 0.0 AS score_a, round(b.score, 6) + 0.0 AS score_b FROM streams a JOIN streams b ON b.stream_id = a.stream_id + 1 AND a.frame_idx = b.frame_idx WHERE a.stream_id % 2 = 0"))
def zip_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames of an even stream beside those of the next, by position."""
    s = streams(spark, sf_dir).select("stream_id", "frame_idx", "score")
    b = s.select((F.col("stream_id") - 1).alias("stream_id"), "frame_idx", F.col("score").alias("b"))
    return s.where(F.col("stream_id") % 2 == 0).join(b, ["stream_id", "frame_idx"]).select("stream_id", "frame_idx", g.r6(F.col("score")).alias("score_a"), g.r6(F.col("b")).alias("score_b"))


@query(sql("streams", "SELECT a.stream_id, a.frame_idx, a.phrase, b.kp_id FROM streams a LEFT JOIN (SELECT * FROM streams WHERE phrase <> 'error') b ON b.stream_id = a.stream_id AND b.frame_idx = a.frame_idx + 1"))
def zip_left_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each frame with the key point of the next, null where that is missing or an error."""
    s = streams(spark, sf_dir).select("stream_id", "frame_idx", "phrase", "kp_id")
    b = s.where("phrase <> 'error'").select("stream_id", (F.col("frame_idx") - 1).alias("frame_idx"), "kp_id")
    return s.drop("kp_id").join(b, ["stream_id", "frame_idx"], "left")


@query(sql("streams", "SELECT s.stream_id, s.frame_idx, s.phrase, o.o_orderstatus AS attribute FROM streams s JOIN (SELECT o_custkey, o_orderstatus, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS n FROM orders) o ON o.o_custkey = s.stream_id AND o.n = s.frame_idx"))
def assign_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A list of attributes attached to a stream's frames by position."""
    by = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_custkey").alias("stream_id"), (F.row_number().over(by) - 1).cast("long").alias("frame_idx"), F.col("o_orderstatus").alias("attribute"))
    return streams(spark, sf_dir).join(o, ["stream_id", "frame_idx"]).select("stream_id", "frame_idx", "phrase", "attribute")


@query(sql("keyframes edges", "SELECT * FROM edges"))
def edges_neighborhood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edges(spark, sf_dir)


_KNN = "pts AS (SELECT frame_idx, tx, ty, tz FROM poses)"


_NEAREST = sql(
    "poses",
    "SELECT q_id, rank, p_id, round(d2, 6) + 0.0 AS d2 FROM (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY d2, p_id)::BIGINT AS rank FROM ("
    "SELECT a.frame_idx AS q_id, b.frame_idx AS p_id, (a.tx - b.tx) * (a.tx - b.tx) + (a.ty - b.ty) * (a.ty - b.ty) + (a.tz - b.tz) * (a.tz - b.tz) AS d2 "
    "FROM pts a, pts b WHERE a.frame_idx % 10 = 0)) WHERE rank <= 4",
    _KNN,
)


@query(_NEAREST)
def knn_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four camera centres nearest to every tenth one, at any distance, met through grids of growing cells."""
    p = poses(spark, sf_dir)
    q = p.where(F.col("frame_idx") % 10 == 0).select(F.col("frame_idx").alias("q_id"), F.col("tx").alias("q_x"), F.col("ty").alias("q_y"), F.col("tz").alias("q_z"))
    pts = p.select(F.col("frame_idx").alias("p_id"), F.col("tx").alias("p_x"), F.col("ty").alias("p_y"), F.col("tz").alias("p_z"))
    near = lookups.k_nearest_whole(q, pts, 4, 0.01, dense=True)
    return near.select("q_id", F.col("rank").cast("long").alias("rank"), "p_id", g.r6(F.col("d2")).alias("d2"))


@query(_NEAREST)
def knn_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as knn_exact, which once kept a radius."""
    return knn_exact(spark, sf_dir)


@query(sql("tracks", "SELECT a.view_idx, a.kp_id, a.frame_idx, count(*) AS n, round(avg(b.u - a.u), 6) + 0.0 AS du FROM tracks a JOIN tracks b ON a.view_idx = b.view_idx AND a.kp_id = b.kp_id AND b.frame_idx = a.frame_idx + 1 GROUP BY ALL"))
def track_correspondences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key points that a view sees in a frame and the next, and how far they move."""
    t = tracks(spark, sf_dir)
    b = t.select("view_idx", "kp_id", (F.col("frame_idx") - 1).alias("frame_idx"), F.col("u").alias("ub"))
    return t.join(b, ["view_idx", "kp_id", "frame_idx"]).groupBy("view_idx", "kp_id", "frame_idx").agg(F.count(F.lit(1)).alias("n"), g.r6(F.avg(F.col("ub") - F.col("u"))).alias("du"))


@query(sql("tracks", "SELECT a.view_idx, a.frame_idx, count(*) AS n FROM tracks a JOIN tracks b ON a.view_idx = b.view_idx AND a.kp_id = b.kp_id AND b.frame_idx = a.frame_idx + 1 JOIN tracks c ON a.view_idx = c.view_idx AND a.kp_id = c.kp_id AND c.frame_idx = a.frame_idx + 2 GROUP BY ALL"))
def track_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many key points a view keeps over three frames; all joins share one partitioning."""
    t = tracks(spark, sf_dir).select("view_idx", "kp_id", "frame_idx")
    shifted = lambda k: t.withColumn("frame_idx", F.col("frame_idx") - k)
    key = ["view_idx", "kp_id", "frame_idx"]
    return t.join(shifted(1), key).join(shifted(2), key).groupBy("view_idx", "frame_idx").agg(F.count(F.lit(1)).alias("n"))


@query(sql("tracks", "SELECT a.view_idx, a.frame_idx AS i, b.frame_idx AS j, count(*) AS n FROM tracks a JOIN tracks b ON a.view_idx = b.view_idx AND a.kp_id = b.kp_id AND abs(a.frame_idx - b.frame_idx) BETWEEN 1 AND 2 GROUP BY ALL"))
def edges_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges between frames at most two apart that share key points."""
    t = tracks(spark, sf_dir).select("view_idx", "kp_id", F.col("frame_idx").alias("i"))
    near = t.select("view_idx", "kp_id", "i", F.explode(F.transform(F.array(*[F.lit(d) for d in (-2, -1, 1, 2)]), lambda d: F.col("i") + d)).alias("j"))
    return near.join(t.withColumnRenamed("i", "j"), ["view_idx", "kp_id", "j"], "left_semi").groupBy("view_idx", "i", "j").agg(F.count(F.lit(1)).alias("n"))


def _relative(i: str, j: str) -> g.Pose:
    return g.compose(g.inverse(g.pose(j)), g.pose(i))


_ROT = {"00": "1 - 2 * (qy * qy + qz * qz)", "01": "2 * (qx * qy - qz * qw)", "02": "2 * (qx * qz + qy * qw)", "10": "2 * (qx * qy + qz * qw)", "11": "1 - 2 * (qx * qx + qz * qz)", "12": "2 * (qy * qz - qx * qw)", "20": "2 * (qx * qz - qy * qw)", "21": "2 * (qy * qz + qx * qw)", "22": "1 - 2 * (qx * qx + qy * qy)"}
FLOW_VIEWS = "grid poses keyframes edges"
_FLOW = [
    "rot AS (SELECT frame_idx, tx, ty, tz, " + ", ".join(f"{e} AS m{n}" for n, e in _ROT.items()) + " FROM poses)",
    "world AS (SELECT e.i, e.j, p.r, p.c, p.disp, " + ", ".join(f"a.m{k}0 * ((p.c - 4) / 8.0::DOUBLE) + a.m{k}1 * ((p.r - 4) / 8.0::DOUBLE) + a.m{k}2 + p.disp * (a.t{x} - b.t{x}) AS w{x}" for k, x in enumerate("xyz")) + ", b.* EXCLUDE (frame_idx, tx, ty, tz) FROM edges e JOIN rot a ON a.frame_idx = 5 * e.i JOIN rot b ON b.frame_idx = 5 * e.j JOIN grid p ON p.frame_idx = 5 * e.i)",
    "cam AS (SELECT i, j, r, c, disp, " + ", ".join(f"m0{k} * wx + m1{k} * wy + m2{k} * wz AS {x}" for k, x in enumerate("xyz")) + " FROM world)",
    "flow AS (SELECT i, j, r, c, disp, 8 * x / CASE WHEN z < 0.1 THEN 1 ELSE z END + 4 AS u, 8 * y / CASE WHEN z < 0.1 THEN 1 ELSE z END + 4 AS w, z > 0.1 AS seen FROM cam)",
]


def reprojected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(i, j, r, c, disp, u, w, seen): where each pixel of keyframe i falls in keyframe j.

    Homogeneous points are moved with their disparity as fourth coordinate. The pose table
    has one row a frame and meets the edges by equi-joins on the frame.
    """
    p = poses(spark, sf_dir).where(F.col("frame_idx") % 5 == 0)
    named = lambda k: p.select(F.floor(F.col("frame_idx") / 5).cast("long").alias(k), *[c.alias(f"{k}_{n}") for n, c in g.pose().named().items()])
    rel = edges(spark, sf_dir).join(named("i"), "i").join(named("j"), "j")
    rel = rel.select("i", "j", *[c.alias(f"r_{n}") for n, c in _relative("i_", "j_").named().items()])
    px = grid(spark, sf_dir).where(F.col("frame_idx") % 5 == 0).select(F.floor(F.col("frame_idx") / 5).cast("long").alias("i"), "r", "c", "disp")
    ray = CAM.ray(F.col("c").cast("double"), F.col("r").cast("double"))
    m = g.pose("r_")
    moved = g.add(g.rotate(m.q, ray), g.scale(m.t, F.col("disp")))
    met = px.join(rel, "i").select("i", "j", "r", "c", "disp", *[v.alias(n) for n, v in zip(("x", "y", "z"), moved, strict=True)])
    u, w, seen = CAM.project((F.col("x"), F.col("y"), F.col("z")))
    return met.select("i", "j", "r", "c", "disp", u.alias("u"), w.alias("w"), seen.alias("seen"))


@query(sql(FLOW_VIEWS, "SELECT i, j, r, c, round(u, 5) + 0.0 AS u, round(w, 5) + 0.0 AS w, seen FROM flow", *_FLOW))
def reproject_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reprojected(spark, sf_dir).select("i", "j", "r", "c", (F.round("u", 5) + F.lit(0.0)).alias("u"), (F.round("w", 5) + F.lit(0.0)).alias("w"), "seen")


def _graph(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The keyframes' pixels (i, r, c, disp) and the edges' relative poses."""
    p = poses(spark, sf_dir).where(F.col("frame_idx") % 5 == 0)
    named = lambda k: p.select(F.floor(F.col("frame_idx") / 5).cast("long").alias(k), *[c.alias(f"{k}_{n}") for n, c in g.pose().named().items()])
    rel = edges(spark, sf_dir).join(named("i"), "i").join(named("j"), "j")
    px = grid(spark, sf_dir).where(F.col("frame_idx") % 5 == 0).select(F.floor(F.col("frame_idx") / 5).cast("long").alias("i"), "r", "c", "disp")
    return px, rel.select("i", "j", *[c.alias(f"r_{n}") for n, c in _relative("i_", "j_").named().items()])


_SHIFT = "shift AS (SELECT e.i, e.j, " + ", ".join(f"b.m0{k} * (a.tx - b.tx) + b.m1{k} * (a.ty - b.ty) + b.m2{k} * (a.tz - b.tz) AS s{k}" for k in range(3)) + " FROM edges e JOIN rot a ON a.frame_idx = 5 * e.i JOIN rot b ON b.frame_idx = 5 * e.j)"
_BOTH = "parts AS (SELECT i, j, r, c, x, y, z, 0.3::DOUBLE AS w FROM cam UNION ALL SELECT i, j, r, c, (c - 4) / 8.0::DOUBLE + disp * s0, (r - 4) / 8.0::DOUBLE + disp * s1, 1 + disp * s2, 0.7::DOUBLE FROM cam JOIN shift USING (i, j))"
_WAYS = (
    "ways AS (SELECT i, j, CASE WHEN sum(CASE WHEN z > 0.25 THEN w ELSE 0 END) / (sum(w) + 1e-8) < 0.75 THEN 1000 "
    "ELSE sum(CASE WHEN z > 0.25 THEN w * sqrt((8 * x / z + 4 - c) * (8 * x / z + 4 - c) + (8 * y / z + 4 - r) * (8 * y / z + 4 - r)) ELSE 0 END) "
    "/ sum(CASE WHEN z > 0.25 THEN w ELSE 0 END) END AS d FROM parts GROUP BY i, j)"
)


@query(sql(FLOW_VIEWS, "SELECT a.i, a.j, round((a.d + b.d) / 2, 5) + 0.0 AS distance FROM ways a JOIN ways b ON a.i = b.j AND a.j = b.i", *_FLOW, _SHIFT, _BOTH, _WAYS))
def frame_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean flow of every edge and its reverse, 0.3 of it by the whole motion, the rest by translation alone."""
    d = frame_graph.frame_distance(*_graph(spark, sf_dir), CAM)
    return d.select("i", "j", (F.round("distance", 5) + F.lit(0.0)).alias("distance"))


_MET = (
    "hits AS (SELECT p.i, p.j, p.r, p.c, max(CASE WHEN abs(p.z / p.disp - 1 / g.disp) < 0.1 THEN 1 ELSE 0 END) AS hit FROM "
    "(SELECT *, floor(8 * x / z + 4)::BIGINT AS u0, floor(8 * y / z + 4)::BIGINT AS v0 FROM cam) p "
    "JOIN grid g ON g.frame_idx = 5 * p.j AND g.r BETWEEN p.v0 AND p.v0 + 1 AND g.c BETWEEN p.u0 AND p.u0 + 1 WHERE p.u0 BETWEEN 0 AND 6 AND p.v0 BETWEEN 0 AND 6 GROUP BY ALL)"
)


@query(sql(FLOW_VIEWS, "SELECT k.frame_idx // 5 AS i, k.r, k.c, coalesce(sum(hit), 0)::BIGINT AS agree, count(hit) AS met FROM grid k LEFT JOIN hits h ON h.i = k.frame_idx // 5 AND h.r = k.r AND h.c = k.c WHERE k.frame_idx % 5 = 0 GROUP BY ALL", *_FLOW, _MET))
def depth_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In how many neighbouring keyframes one of the four pixels around a pixel's place has much the same depth."""
    return frame_graph.agreements(*_graph(spark, sf_dir), CAM, SIDE, SIDE, 0.1)


@query(sql("keyframes edges", "SELECT i, j FROM edges e WHERE NOT EXISTS (SELECT 1 FROM edges a WHERE a.i = e.i AND a.j = e.j AND (a.i + a.j) % 3 = 0)"))
def edges_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New edges without those in the graph already."""
    e = edges(spark, sf_dir)
    return e.join(e.where((F.col("i") + F.col("j")) % 3 == 0), ["i", "j"], "left_anti")


@query(sql("keyframes edges grid", "SELECT e.i, e.j, v.view_idx AS vi, coalesce(x.other, v.view_idx) AS vj FROM edges e, (SELECT DISTINCT view_idx FROM grid) v LEFT JOIN (VALUES (0::BIGINT, 1::BIGINT)) x(view_idx, other) ON x.view_idx = v.view_idx AND (e.i + e.j) % 2 = 0"))
def edges_multiview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges repeated for each of two views; for even sums view 0 looks across to view 1."""
    views = F.array(F.lit(0), F.lit(1)).cast("array<bigint>")
    e = edges(spark, sf_dir).withColumn("vi", F.explode(views))
    return e.withColumn("vj", F.when((F.col("vi") == 0) & ((F.col("i") + F.col("j")) % 2 == 0), F.lit(1).cast("long")).otherwise(F.col("vi")))
