"""Queries on what models give for frames: tiles to chain, features to correlate, trajectories to align."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framequery.functions import geometry as g
from framequery.operators import correlation, tiles, trajectories
from framequery.sources.frames import edges, grid, poses, sql, table

from .catalog import query

_TILES = (
    "n AS (SELECT max(vec_id) AS last, max(vec_id) // 22 + 1 AS tiles FROM embeddings), "
    "shown AS (SELECT k AS tile, p AS place, least(CASE WHEN k > 0 AND p = 0 THEN 22 * (k - 1) WHEN k > 0 AND p = 1 THEN 22 * (k - 1) + 12 ELSE 22 * k + p END, last) AS frame_idx "
    "FROM n, range(tiles) a(k), range(32) b(p)), "
    "t AS (SELECT tile, place, r * 8 + c AS px, (0.8::DOUBLE + 0.1::DOUBLE * (tile % 5)) * depth - 0.05::DOUBLE * (tile % 3) AS x FROM shown JOIN grid USING (frame_idx)), "
    "chain(tile, px, ref0, ref1, scale, shift) AS ("
    "SELECT 0::BIGINT, a.px, a.x, b.x, 1.0::DOUBLE, 0.0::DOUBLE FROM t a JOIN t b ON a.px = b.px AND b.tile = 0 AND b.place = 12 WHERE a.tile = 0 AND a.place = 0 UNION ALL "
    "SELECT tile, px, ref0, greatest(k * scale + shift, 0), scale, shift FROM (SELECT tile, px, ref0, k, (n * pq - p * q) / (n * pp - p * p) AS scale, (pp * q - p * pq) / (n * pp - p * p) AS shift FROM ("
    "SELECT c.tile + 1 AS tile, c.px, ref0, k.x AS k, 2 * count(*) OVER () AS n, sum(a.x + b.x) OVER () AS p, sum(ref0 + ref1) OVER () AS q, "
    "sum(a.x * a.x + b.x * b.x) OVER () AS pp, sum(a.x * ref0 + b.x * ref1) OVER () AS pq "
    "FROM chain c JOIN t a ON a.tile = c.tile + 1 AND a.place = 0 AND a.px = c.px JOIN t b ON b.tile = c.tile + 1 AND b.place = 1 AND b.px = c.px JOIN t k ON k.tile = c.tile + 1 AND k.place = 12 AND k.px = c.px))), "
    "fits AS (SELECT DISTINCT tile, scale, shift FROM chain), "
    "aligned AS (SELECT tile, place, px, 22 * tile + place AS frame_idx, CASE WHEN tile = 0 THEN x ELSE greatest(x * scale + shift, 0) END AS x FROM t JOIN fits USING (tile))"
)


@query(
    sql(
        "grid",
        "SELECT a.frame_idx, a.px // 8 AS r, a.px % 8 AS c, round(CASE WHEN b.x IS NULL THEN a.x ELSE a.x * (1 - (b.place - 2) / 7.0::DOUBLE) + b.x * (b.place - 2) / 7.0::DOUBLE END, 4) + 0.0 AS depth "
        "FROM aligned a LEFT JOIN aligned b ON b.tile = a.tile + 1 AND b.frame_idx = a.frame_idx AND b.px = a.px AND b.place BETWEEN 2 AND 9, n "
        "WHERE a.frame_idx <= last AND (a.tile = 0 OR a.place >= 10)",
        _TILES,
    ).replace("WITH ", "WITH RECURSIVE ", 1)
)
def chained_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Depths of all frames, seen in tiles each with a scale and shift of its own, brought to one scale and blended."""
    last = table(spark, sf_dir, "embeddings").agg(F.max("vec_id").alias("last"))  # one row
    frames = grid(spark, sf_dir).groupBy("frame_idx").agg(F.transform(F.sort_array(F.collect_list(F.struct((F.col("r") * 8 + F.col("c")).alias("px"), "depth"))), lambda x: x["depth"]).alias("grid"))
    one = frames.select(F.lit(0).alias("stream"), "frame_idx", "grid").crossJoin(F.broadcast(last))
    shown = tiles.tiled(one, "stream", "frame_idx", "last")
    seen = shown.select("stream", "tile", "place", F.transform("grid", lambda x: x * (0.8 + 0.1 * (F.col("tile") % 5)) - 0.05 * (F.col("tile") % 3)).alias("grid"))
    found = tiles.blended(seen, tiles.chain(seen, "stream", "grid"), "stream", "grid").join(F.broadcast(last), F.col("frame") <= F.col("last"))
    px = found.select(F.col("frame").alias("frame_idx"), F.posexplode("grid").alias("px", "x"))
    return px.select("frame_idx", F.floor(F.col("px") / 8).alias("r"), (F.col("px") % 8).cast("long").alias("c"), (F.round("x", 4) + F.lit(0.0)).alias("depth"))


_LOOKUP = (
    "f AS (SELECT frame_idx // 5 AS k, r, c, a.v, b.v AS w FROM grid a JOIN (SELECT frame_idx, r, c, v FROM grid) b USING (frame_idx, r, c) WHERE frame_idx % 5 = 0), "
    "lv AS (SELECT 0 AS level, k, r, c, v, 2 * v * v AS w FROM f UNION ALL SELECT 1, k, r // 2, c // 2, avg(v), avg(2 * v * v) FROM f GROUP BY ALL), "
    "q AS (SELECT i, j, r, c, v, 2 * v * v AS w, c + 0.25 * (j - i) + 0.3 * v AS x, r + 0.2 * v AS y FROM edges JOIN f ON k = i), "
    "s AS (SELECT q.i, q.j, q.r, q.c, q.v, q.w, level, dx, dy, floor(x / (level + 1)) AS fx, floor(y / (level + 1)) AS fy, x / (level + 1) - floor(x / (level + 1)) AS ax, y / (level + 1) - floor(y / (level + 1)) AS ay FROM q, range(2) l(level), range(-1, 2) a(dx), range(-1, 2) b(dy)), "
    "taps AS (SELECT s.*, ox, oy, (CASE WHEN ox = 1 THEN ax ELSE 1 - ax END) * (CASE WHEN oy = 1 THEN ay ELSE 1 - ay END) AS share FROM s, range(2) a(ox), range(2) b(oy))"
)


@query(
    sql(
        "grid keyframes edges",
        "SELECT t.i, t.j, t.r, t.c, (t.level * 9 + (dx + 1) * 3 + dy + 1)::BIGINT AS place, round(sum(coalesce(share * (t.v * lv.v + t.w * lv.w) / 16, 0)), 5) + 0.0 AS corr "
        "FROM taps t LEFT JOIN lv ON lv.level = t.level AND lv.k = t.j AND lv.c = fx + dx + ox AND lv.r = fy + dy + oy GROUP BY ALL",
        _LOOKUP,
    )
)
def correlation_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products of the keyframes' features (a value and twice its square), two levels, 3 x 3 about drifting coordinates."""
    px = grid(spark, sf_dir).where(F.col("frame_idx") % 5 == 0).select(F.floor(F.col("frame_idx") / 5).cast("long").alias("k"), "r", "c", "v")
    flat = F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("r", "c", "v"))), lambda x: F.array(x["v"], 2 * x["v"] * x["v"])))
    maps = px.groupBy(F.col("k").alias("frame")).agg(flat.alias("data")).select("frame", F.lit(8).alias("h"), F.lit(8).alias("w"), F.lit(2).alias("dim"), "data")
    coords = edges(spark, sf_dir).join(px, F.col("k") == F.col("i"))
    coords = coords.select("i", "j", "r", "c", (F.col("c") + 0.25 * (F.col("j") - F.col("i")) + 0.3 * F.col("v")).alias("u"), (F.col("r") + 0.2 * F.col("v")).alias("v"))
    found = correlation.looked_up(maps, coords, 2, 1).select("i", "j", "r", "c", F.posexplode("corr").alias("place", "corr"))
    return found.select("i", "j", "r", "c", F.col("place").cast("long").alias("place"), (F.round("corr", 5) + F.lit(0.0)).alias("corr"))


@query("SELECT vec_id // 50 AS track, count(*) AS n, 2.0::DOUBLE AS scale, 1.0::DOUBLE AS tx, 0.0::DOUBLE AS ty, -3.0::DOUBLE AS tz, round(0.1 + 0.01 * (vec_id // 50), 3)::DOUBLE AS arm_x, -0.2::DOUBLE AS arm_y, 0.05::DOUBLE AS arm_z, 0.0::DOUBLE AS error FROM embeddings GROUP BY ALL")
def lever_arms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The transform and lever arm of every track of fifty frames whose sensor's point went where an arm of its own puts it."""
    p = poses(spark, sf_dir).withColumn("track", F.floor(F.col("frame_idx") / 50))
    arm = (0.1 + 0.01 * F.col("track"), F.lit(-0.2), F.lit(0.05))
    at = g.act(g.pose(), arm)
    turned = (2 * at[1] + 1, -2 * at[0], 2 * at[2] - 3)
    rows = p.select("track", *g.Pose._fields, *[c.alias(f"b{k}") for k, c in enumerate(turned)])
    found = trajectories.lever_arms(rows, "track")
    return found.select("track", "n", *[(F.round(c, 3) + F.lit(0.0)).alias(c) for c in ("scale", "tx", "ty", "tz", "arm_x", "arm_y", "arm_z", "error")])
