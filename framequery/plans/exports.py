"""Queries that select what is kept of a map and write its lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framequery.functions import geometry as g
from framequery.operators import neighbourhood as n
from framequery.operators import ranges, sequences
from framequery.sources.frames import edges, grid, sql, streams, table

from .catalog import query
from .depth_maps import _TAPS
from .joins import _FLOW, _MET, FLOW_VIEWS, depth_filter, reprojected

_KEPT = (
    "SELECT a.i, a.r, a.c FROM (SELECT i, r, c, sum(hit) AS agree FROM hits GROUP BY ALL) a JOIN grid g ON g.frame_idx = 5 * a.i AND g.r = a.r AND g.c = a.c "
    "JOIN (SELECT frame_idx, avg(disp) AS mean FROM grid GROUP BY ALL) m USING (frame_idx) WHERE agree >= 2 AND mask AND disp > 0.5 * mean"
)


@query(sql(FLOW_VIEWS, _KEPT, *_FLOW, _MET))
def map_extract(spark: SparkSession, sf_dir: str, share: float = 0.5, least: int = 2) -> DataFrame:
    """Keyframe pixels that ``least`` neighbours confirm, unmasked and of more than ``share`` of their frame's mean disparity."""
    px = grid(spark, sf_dir).where(F.col("frame_idx") % 5 == 0).withColumn("i", F.floor(F.col("frame_idx") / 5))
    mean = px.groupBy("i").agg(F.avg("disp").alias("mean"))
    kept = px.where("mask").join(mean, "i").where(F.col("disp") > share * F.col("mean")).select("i", "r", "c")
    return kept.join(depth_filter(spark, sf_dir).where(F.col("agree") >= least), ["i", "r", "c"], "left_semi")


@query(sql("grid", "SELECT row_number() OVER (ORDER BY frame_idx, r, c) AS point_id, frame_idx, r, c FROM grid WHERE frame_idx % 5 = 0 AND mask"))
def colmap_points_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Map points numbered from 1 over all keyframes, by ranges of (frame, row, column)."""
    px = grid(spark, sf_dir).where((F.col("frame_idx") % 5 == 0) & F.col("mask")).select("frame_idx", "r", "c")
    found = ranges.numbered(px, [], [F.col("frame_idx"), F.col("r"), F.col("c")], "n")
    return found.select((F.col("n") + 1).alias("point_id"), "frame_idx", "r", "c")


@query("SELECT label AS view, format('{:d} PINHOLE 8 8 {:.1f} {:.1f} 4 4', label + 1, 8 + label / 10.0::DOUBLE, 8 + (arg_min(vec_id, vec_id) % 10) / 10.0::DOUBLE) AS line FROM embeddings GROUP BY label")
def colmap_cameras(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One camera line a view, from its first frame."""
    first = table(spark, sf_dir, "embeddings").groupBy("label").agg(F.min("vec_id").alias("first"))
    return first.select(F.col("label").alias("view"), F.format_string("%d PINHOLE 8 8 %.1f %.1f 4 4", F.col("label") + 1, 8 + F.col("label") / 10, 8 + F.col("first") % 10 / 10).alias("line"))


@query(sql("keyframes edges", "SELECT i, j FROM edges WHERE j % 10 <> 0"))
def ba_fixed_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges whose target is free: keyframes held fixed are anti-joined away."""
    fixed = table(spark, sf_dir, "embeddings").where(F.col("vec_id") % 50 == 0).select(F.floor(F.col("vec_id") / 5).alias("j"))
    return edges(spark, sf_dir).join(fixed, "j", "left_anti").select("i", "j")


@query(sql(FLOW_VIEWS, f"SELECT i, r, c, round(sum(disp * wt) / sum(wt), 5) + 0.0 AS disp FROM (SELECT i, tr AS r, tc AS c, disp, wt FROM ({_TAPS.format('SELECT i, u, w, disp FROM flow WHERE seen AND j = i + 1')}) t WHERE wt > 1e-6) WHERE r BETWEEN 0 AND 7 AND c BETWEEN 0 AND 7 GROUP BY ALL", *_FLOW))
def reproject_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each keyframe's disparities splatted where they fall in the next keyframe."""
    f = reprojected(spark, sf_dir).where("seen AND j = i + 1").select("i", "disp", F.explode(n.bilinear_taps(F.col("u"), F.col("w"))).alias("t")).select("i", "disp", "t.*").withColumnRenamed("w", "wt")
    inside = f.where((F.col("wt") > 1e-6) & F.col("r").between(0, 7) & F.col("c").between(0, 7))
    return inside.groupBy("i", "r", "c").agg((F.round(F.sum(F.col("disp") * F.col("wt")) / F.sum("wt"), 5) + F.lit(0.0)).alias("disp"))


@query(sql("streams", "SELECT stream_id, frame_idx, round(sum(x * wt) / sum(wt), 6) + 0.0 AS faded FROM (SELECT *, CASE WHEN w > 0 AND p < 8 THEN p / 7.0::DOUBLE WHEN p >= 22 AND p < 30 AND more THEN 1 - (p - 22) / 7.0::DOUBLE WHEN p >= 30 AND more THEN 0 ELSE 1 END AS wt FROM (SELECT s.stream_id, frame_idx, w, frame_idx - 22 * w AS p, score + 0.5::DOUBLE * w AS x, n > 22 * (w + 1) AS more FROM streams s JOIN (SELECT stream_id, count(*) AS n FROM streams GROUP BY ALL) USING (stream_id), range(1000) t(w) WHERE frame_idx >= w * 22 AND frame_idx < w * 22 + 32)) GROUP BY ALL"))
def vda_crossfade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles of 32 cross-faded over the first eight frames of each overlap, ends of the fade included."""
    s = streams(spark, sf_dir).select("stream_id", "frame_idx", "score")
    count = s.groupBy("stream_id").agg(F.count(F.lit(1)).alias("n"))
    rows = s.join(count, "stream_id").withColumn("w", F.explode(sequences.window_of(F.col("frame_idx"), 32, 10)))
    p, more = F.col("frame_idx") - 22 * F.col("w"), F.col("n") > 22 * (F.col("w") + 1)
    weight = F.when((F.col("w") > 0) & (p < 8), p / 7).when((p >= 22) & (p < 30) & more, 1 - (p - 22) / 7).when((p >= 30) & more, 0.0).otherwise(1.0)
    x = F.col("score") + 0.5 * F.col("w")
    return rows.groupBy("stream_id", "frame_idx").agg(g.r6(F.sum(x * weight) / F.sum(weight)).alias("faded"))
