"""Queries on factor graphs kept as logs, boxes that suppress one another, motion scores and peaks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framequery.functions import geometry as g
from framequery.operators import boxes, factor_log, motion
from framequery.sources.frames import grid, sql, streams, tracks

from .catalog import query


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stream as a graph's log: what a frame does follows from its phrase, with which keyframes from its key point."""
    s = streams(spark, sf_dir)
    at = (F.col("kp_id") % 24).cast("long")
    pairs = F.array(*[F.struct((at + a).alias("i"), (at + b).alias("j")) for a, b in ((0, 1), (1, 0), (0, 2), (2, 5))])
    op = F.when(F.col("phrase") == "error", "retire").when(F.col("phrase") == "signup", "drop").when(F.col("phrase") == "purchase", "use").when(F.col("phrase") == "view", "age").otherwise("add")
    n = F.when(F.col("phrase") == "error", F.lit(2).cast("long")).otherwise(at)
    return s.select(F.col("stream_id").alias("graph"), F.col("frame_idx").alias("seq"), op.alias("op"), F.when(op == "add", pairs).alias("pairs"), n.alias("n"))


@query()
def factor_graph_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every version of every edge, at most 12 active ones a graph."""
    return factor_log.replay(_events(spark, sf_dir), 12)


@query()
def factor_graph_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The edges left after all events."""
    return factor_log.edges_at(factor_log.replay(_events(spark, sf_dir), 12))


#: A walk over each frame's boxes from the best down, with the lists of those kept and gone.
_BOXES = (
    "b AS (SELECT frame_idx, r * 8 + c AS id, v AS score, 2 * c - 1.5 * abs(v) - 1 AS x0, 2 * r - 1.0 AS y0, 2 * c + 1.5 * abs(v) + 1 AS x1, 2 * r + 1.0 + abs(v) AS y1 FROM grid), "
    "p AS (SELECT a.frame_idx, a.id AS better, w.id AS worse FROM b a JOIN b w ON a.frame_idx = w.frame_idx AND (a.score > w.score OR (a.score = w.score AND a.id < w.id)), "
    "LATERAL (SELECT greatest(least(a.x1, w.x1) - greatest(a.x0, w.x0), 0) * greatest(least(a.y1, w.y1) - greatest(a.y0, w.y0), 0) AS met) "
    "WHERE met > 0.12 * ((a.x1 - a.x0) * (a.y1 - a.y0) + (w.x1 - w.x0) * (w.y1 - w.y0) - met)), "
    "ranked AS (SELECT frame_idx, id, row_number() OVER (PARTITION BY frame_idx ORDER BY score DESC, id) AS n FROM b), "
    "worse AS (SELECT p.frame_idx, p.better, list(p.worse) AS below FROM p GROUP BY ALL), "
    "walk(frame_idx, n, kept, gone) AS (SELECT DISTINCT frame_idx, 0::BIGINT, []::BIGINT[], []::BIGINT[] FROM b UNION ALL "
    "SELECT w.frame_idx, r.n, CASE WHEN list_contains(w.gone, r.id) THEN w.kept ELSE list_append(w.kept, r.id) END, "
    "CASE WHEN list_contains(w.gone, r.id) THEN w.gone ELSE list_concat(w.gone, coalesce(o.below, [])) END "
    "FROM walk w JOIN ranked r ON r.frame_idx = w.frame_idx AND r.n = w.n + 1 LEFT JOIN worse o ON o.frame_idx = r.frame_idx AND o.better = r.id)"
)


@query(sql("grid", "SELECT frame_idx, unnest(kept) AS id FROM walk WHERE n = 64", _BOXES).replace("WITH ", "WITH RECURSIVE ", 1))
def box_suppression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The boxes of every frame, one about each pixel and as wide as its value is large, that suppression keeps."""
    wide = 1.5 * F.abs("v") + 1
    b = grid(spark, sf_dir).select("frame_idx", (F.col("r") * 8 + F.col("c")).alias("id"), F.col("v").alias("score"), (2 * F.col("c") - wide).alias("x0"), (2 * F.col("r") - 1.0).alias("y0"), (2 * F.col("c") + wide).alias("x1"), (2 * F.col("r") + 1.0 + F.abs("v")).alias("y1"))
    return boxes.suppressed(b, "frame_idx", 0.12).select("frame_idx", "id")


@query(sql("grid", "SELECT frame_idx, round(min(m), 6) + 0.0 AS motion FROM (SELECT frame_idx // 2 AS frame_idx, frame_idx % 2 AS view, avg(abs(v) * mask::INT) / (avg(mask::INT) + 1e-6) AS m FROM grid GROUP BY ALL) GROUP BY ALL"))
def motion_of_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The least of the masked mean sizes of a frame's two views, which are two grids that follow each other."""
    px = grid(spark, sf_dir).select(F.floor(F.col("frame_idx") / 2).alias("frame_idx"), (F.col("frame_idx") % 2).alias("view_idx"), F.abs("v").alias("size"), F.col("mask").cast("double").alias("weight"))
    found = motion.dense_motion(px)
    return found.select("frame_idx", g.r6(F.col("motion")).alias("motion"))


_SHARED = (
    "views AS (SELECT a.frame_idx, a.view_idx, count(*) AS n, avg(sqrt((a.u - b.u) * (a.u - b.u) + (a.v - b.v) * (a.v - b.v))) AS d FROM tracks a JOIN tracks b ON a.view_idx = b.view_idx AND a.kp_id = b.kp_id AND b.frame_idx = a.frame_idx - 1 GROUP BY ALL), "
    "every AS (SELECT f.frame_idx, coalesce(sum(n), 0)::BIGINT AS n, coalesce(sum(d), 0) AS d FROM (SELECT DISTINCT frame_idx FROM tracks) f LEFT JOIN views USING (frame_idx) GROUP BY ALL)"
)


@query(sql("tracks", "SELECT a.frame_idx, a.n, round(a.d + CASE WHEN b.n > 0 AND b.n - a.n > 0.2 * b.n THEN 100 ELSE 0 END, 5) + 0.0 AS motion FROM every a LEFT JOIN every b ON b.frame_idx = a.frame_idx - 1", _SHARED))
def motion_of_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points shared with the frame before and their mean shifts summed over views; 100 more where over a fifth went lost."""
    found = motion.track_motion(tracks(spark, sf_dir))
    return found.select("frame_idx", "n", (F.round("motion", 5) + F.lit(0.0)).alias("motion"))


def _peaks_sql() -> str:
    near = "b.frame_idx = a.frame_idx AND abs(a.r - b.r) <= 1 AND abs(a.c - b.c) <= 1"
    views = [f"p0 AS (SELECT a.frame_idx, a.r, a.c, a.v, a.v = max(b.v) AS peak FROM grid a JOIN grid b ON {near} GROUP BY a.frame_idx, a.r, a.c, a.v)"]
    for k in range(2):
        views.append(f"h{k} AS (SELECT a.frame_idx, a.r, a.c, a.v, a.peak, bool_or(b.peak) AS hidden, CASE WHEN bool_or(b.peak) THEN 0 ELSE a.v END AS x FROM p{k} a JOIN p{k} b ON {near} GROUP BY a.frame_idx, a.r, a.c, a.v, a.peak)")
        views.append(f"p{k + 1} AS (SELECT a.frame_idx, a.r, a.c, a.v, a.peak OR (a.x = max(b.x) AND NOT a.hidden) AS peak FROM h{k} a JOIN h{k} b ON {near} GROUP BY a.frame_idx, a.r, a.c, a.v, a.peak, a.x, a.hidden)")
    return sql("grid", "SELECT frame_idx, r, c, round(v, 6) + 0.0 AS v FROM p2 WHERE peak", *views)


@query(_peaks_sql())
def keypoint_refined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Peaks of every frame after two rounds in which the surroundings of peaks count as nought."""
    return motion.refined_peaks(grid(spark, sf_dir), "v").select("frame_idx", "r", "c", g.r6(F.col("v")).alias("v"))
