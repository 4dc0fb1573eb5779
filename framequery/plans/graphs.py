"""Queries that maintain a graph of edges between keyframes, and pick peaks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framequery.functions import geometry as g
from framequery.operators import neighbourhood as n
from framequery.sources.frames import edges, grid, poses, sql, streams

from .catalog import query

_AGED = "aged AS (SELECT i, j, (i * 7 + j * 3) % 30 AS age FROM edges)"


def _aged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edges(spark, sf_dir).withColumn("age", (F.col("i") * 7 + F.col("j") * 3) % 30)


@query(sql("keyframes edges", "SELECT i, j, age, CASE WHEN age > 25 THEN 'aged out' WHEN n > 4 THEN 'evicted' ELSE 'active' END AS state FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY age, j) AS n FROM aged)", _AGED))
def edges_evict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges too old, or beyond the four youngest of their keyframe, leave the active set."""
    place = F.row_number().over(Window.partitionBy("i").orderBy("age", "j"))
    state = F.when(F.col("age") > 25, "aged out").when(place > 4, "evicted").otherwise("active")
    return _aged(spark, sf_dir).select("i", "j", "age", state.alias("state"))


@query(sql("keyframes edges", "SELECT i - CASE WHEN i >= 40 THEN 1 ELSE 0 END AS i, j - CASE WHEN j >= 40 THEN 1 ELSE 0 END AS j FROM edges WHERE i <> 40 AND j <> 40"))
def edges_reindex(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges after keyframe 40 is taken out: its own go, later ids move down."""
    down = lambda c: F.col(c) - F.when(F.col(c) >= 40, 1).otherwise(0)
    return edges(spark, sf_dir).where("i <> 40 AND j <> 40").select(down("i").alias("i"), down("j").alias("j"))


@query(sql("keyframes edges", "SELECT i, j FROM edges WHERE (i + j) % 3 = 0 UNION ALL SELECT j, i FROM edges WHERE (i + j) % 3 = 0"))
def edges_bidirectional(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = edges(spark, sf_dir).where((F.col("i") + F.col("j")) % 3 == 0)
    return e.unionByName(e.select(F.col("j").alias("i"), F.col("i").alias("j")))


@query(sql("grid", "SELECT frame_idx, r, c, rank FROM (SELECT *, row_number() OVER (PARTITION BY frame_idx ORDER BY v DESC, r, c)::BIGINT AS rank FROM (SELECT a.frame_idx, a.r, a.c, a.v FROM grid a JOIN grid b ON a.frame_idx = b.frame_idx AND abs(a.r - b.r) <= 1 AND abs(a.c - b.c) <= 1 GROUP BY ALL HAVING a.v = max(b.v))) WHERE rank <= 5"))
def keypoint_nms_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five greatest pixels of a frame that no neighbour exceeds."""
    px = grid(spark, sf_dir).select(*n.KEY, "v")
    peaks = px.join(n.dilated(px, "v").withColumnRenamed("v", "top"), n.KEY).where("v = top")
    best = F.row_number().over(Window.partitionBy("frame_idx").orderBy(F.desc("v"), "r", "c"))
    return peaks.withColumn("rank", best.cast("long")).where("rank <= 5").select(*n.KEY, "rank")


@query(sql("keyframes edges poses", "SELECT i, arg_max(j, (d, -j)) AS farthest FROM (SELECT e.i, e.j, sqrt((a.tx - b.tx) * (a.tx - b.tx) + (a.ty - b.ty) * (a.ty - b.ty) + (a.tz - b.tz) * (a.tz - b.tz)) AS d FROM edges e JOIN poses a ON a.frame_idx = 5 * e.i JOIN poses b ON b.frame_idx = 5 * e.j) GROUP BY ALL"))
def secondary_keyframe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The linked keyframe farthest from each, ties to the smaller id."""
    p = poses(spark, sf_dir).where(F.col("frame_idx") % 5 == 0)
    at = lambda k: p.select(F.floor(F.col("frame_idx") / 5).alias(k), *[F.col(t).alias(f"{k}_{t}") for t in ("tx", "ty", "tz")])
    step = tuple(F.col(f"i_{t}") - F.col(f"j_{t}") for t in ("tx", "ty", "tz"))
    d = edges(spark, sf_dir).join(at("i"), "i").join(at("j"), "j").withColumn("d", F.sqrt(g.dot(step, step)))
    return d.groupBy("i").agg(F.max_by("j", F.struct("d", (-F.col("j")).alias("near"))).alias("farthest"))


@query(sql("streams", "SELECT stream_id, w, list_sort(list(DISTINCT raw_frame_idx))::VARCHAR AS members FROM (SELECT stream_id, raw_frame_idx, frame_idx // 10 AS w FROM streams WHERE phrase = 'signup') GROUP BY ALL"))
def window_keyframes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyframes of each window, once each and in order."""
    s = streams(spark, sf_dir).where("phrase = 'signup'").groupBy("stream_id", F.floor(F.col("frame_idx") / 10).alias("w")).agg(F.sort_array(F.collect_set("raw_frame_idx")).alias("m"))
    return s.select("stream_id", "w", F.concat(F.lit("["), F.array_join(F.col("m").cast("array<string>"), ", "), F.lit("]")).alias("members"))
