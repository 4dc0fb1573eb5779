"""Queries over depth grids: points, masks, resampling, alignment."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framequery.functions import geometry as g
from framequery.operators import neighbourhood as n
from framequery.operators import ranges
from framequery.sources.frames import grid, poses, sql

from .catalog import query

CAM = g.Camera(8.0, 8.0, 4.0, 4.0)

_RELIABLE = """reliable AS (SELECT a.frame_idx, a.r, a.c FROM grid a JOIN grid b ON a.frame_idx = b.frame_idx AND abs(a.r - b.r) <= 2 AND abs(a.c - b.c) <= 2
GROUP BY ALL HAVING (max(b.depth) - min(b.depth)) / (sum(b.depth) / 25 + 1e-8) < 0.1)"""


def _world() -> str:
    """The SQL of act(pose, (x, y, z)), for rows with x, y, z and a pose."""
    cx, cy, cz = "(qy * z - qz * y)", "(qz * x - qx * z)", "(qx * y - qy * x)"
    rows = [("x", "tx", cx, f"(qy * {cz} - qz * {cy})"), ("y", "ty", cy, f"(qz * {cx} - qx * {cz})"), ("z", "tz", cz, f"(qx * {cy} - qy * {cx})")]
    return ", ".join(f"round({v} + 2 * (qw * {c} + {cc}) + {t}, 6) + 0.0 AS w{v}" for v, t, c, cc in rows)


@query(sql("grid poses", f"SELECT g.frame_idx, g.r, g.c, {_world()} FROM (SELECT *, (c - 4) / 8 * depth AS x, (r - 4) / 8 * depth AS y, depth AS z FROM grid WHERE frame_idx % 4 = 0) g JOIN reliable USING (frame_idx, r, c) JOIN poses USING (frame_idx)", _RELIABLE))
def points_from_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """World points of the reliable pixels of every fourth frame."""
    px = grid(spark, sf_dir).where(F.col("frame_idx") % 4 == 0)
    kept = px.join(n.reliable(px), n.KEY, "left_semi").join(poses(spark, sf_dir), "frame_idx")
    x = g.scale(CAM.ray(F.col("c").cast("double"), F.col("r").cast("double")), F.col("depth"))
    wx, wy, wz = g.act(g.pose(), x)
    return kept.select("frame_idx", "r", "c", g.r6(wx).alias("wx"), g.r6(wy).alias("wy"), g.r6(wz).alias("wz"))


@query(sql("grid", "SELECT * FROM reliable", _RELIABLE))
def reliable_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return n.reliable(grid(spark, sf_dir))


@query(sql("grid", "SELECT a.frame_idx, a.r, a.c, min(CASE WHEN b.mask THEN 1 ELSE 0 END)::BIGINT AS mask FROM grid a JOIN grid b ON a.frame_idx = b.frame_idx AND abs(a.r - b.r) <= 1 AND abs(a.c - b.c) <= 1 GROUP BY ALL"))
def mask_erode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return n.eroded(grid(spark, sf_dir).withColumn("mask", F.col("mask").cast("long")), "mask")


@query(sql("grid", "SELECT a.frame_idx, a.r, a.c, max(CASE WHEN b.mask THEN 1 ELSE 0 END)::BIGINT AS mask FROM grid a JOIN grid b ON a.frame_idx = b.frame_idx AND abs(a.r - b.r) <= 1 AND abs(a.c - b.c) <= 1 GROUP BY ALL"))
def mask_dilate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return n.dilated(grid(spark, sf_dir).withColumn("mask", F.col("mask").cast("long")), "mask")


@query(sql("grid", "SELECT frame_idx, r // 4 AS br, c // 4 AS bc, (avg(CASE WHEN r % 4 IN (1, 2) AND c % 4 IN (1, 2) THEN CASE WHEN mask THEN 1.0 ELSE 0.0 END END) > 0.9) = FALSE AS masked FROM grid GROUP BY ALL"))
def mask_downsample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks whose mask, read at the four middle pixels as a bilinear shrink does, is not full."""
    middle = F.col("r").isin(1, 2, 5, 6) & F.col("c").isin(1, 2, 5, 6)
    return grid(spark, sf_dir).where(middle).groupBy("frame_idx", F.floor(F.col("r") / 4).alias("br"), F.floor(F.col("c") / 4).alias("bc")).agg((~(F.avg(F.col("mask").cast("double")) > 0.9)).alias("masked"))


@query(sql("grid", "SELECT frame_idx, r // 8 AS br, c // 8 AS bc, round(CASE WHEN depth > 0 THEN 1 / depth ELSE 0 END, 6) + 0.0 AS disp_sens FROM grid WHERE r % 8 = 3 AND c % 8 = 3"))
def disp_sens_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    px = grid(spark, sf_dir).where((F.col("r") % 8 == 3) & (F.col("c") % 8 == 3))
    return px.select("frame_idx", F.floor(F.col("r") / 8).alias("br"), F.floor(F.col("c") / 8).alias("bc"), g.r6(F.when(F.col("depth") > 0, 1 / F.col("depth")).otherwise(0.0)).alias("disp_sens"))


@query(sql("grid", "SELECT frame_idx, r, c, round(greatest(0, least(1, (depth - min(depth) OVER w) / nullif(max(depth) OVER w - min(depth) OVER w, 0))), 6) + 0.0 AS shade FROM grid WINDOW w AS (PARTITION BY frame_idx)"))
def depth_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Depth scaled to the range of its frame."""
    w = Window.partitionBy("frame_idx")
    lo, hi = F.min("depth").over(w), F.max("depth").over(w)
    return grid(spark, sf_dir).select("frame_idx", "r", "c", g.r6(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.try_divide(F.col("depth") - lo, hi - lo)))).alias("shade"))


@query(sql("grid", "SELECT frame_idx, r // 2 AS r, c // 2 AS c, round(v, 6) + 0.0 AS v FROM grid WHERE r % 2 = 0 AND c % 2 = 0"))
def resize_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half size by nearest pixels: output k reads input 2k."""
    px = grid(spark, sf_dir).where((F.col("r") % 2 == 0) & (F.col("c") % 2 == 0))
    return px.select("frame_idx", F.floor(F.col("r") / 2).alias("r"), F.floor(F.col("c") / 2).alias("c"), g.r6(F.col("v")).alias("v"))


@query(sql("grid", "SELECT frame_idx, r - 1 AS r, c - 2 AS c, round(v, 6) + 0.0 AS v, 4.0::DOUBLE - 2 AS cx, 4.0::DOUBLE - 1 AS cy FROM grid WHERE r BETWEEN 1 AND 5 AND c BETWEEN 2 AND 6"))
def crop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows 1-5 and columns 2-6, the principal point moved along."""
    px = grid(spark, sf_dir).where(F.col("r").between(1, 5) & F.col("c").between(2, 6))
    return px.select("frame_idx", (F.col("r") - 1).alias("r"), (F.col("c") - 2).alias("c"), g.r6(F.col("v")).alias("v"), F.lit(2.0).alias("cx"), F.lit(3.0).alias("cy"))


_UV = "SELECT frame_idx, r, c, c + 0.8 * v AS u, r - 0.6 * v AS w FROM grid"
_TAPS = "SELECT p.*, floor(w)::BIGINT + a AS tr, floor(u)::BIGINT + b AS tc, (CASE WHEN a = 1 THEN w - floor(w) ELSE 1 - (w - floor(w)) END) * (CASE WHEN b = 1 THEN u - floor(u) ELSE 1 - (u - floor(u)) END) AS wt FROM ({}) p, (VALUES (0), (1)) x(a), (VALUES (0), (1)) y(b)"


@query(sql("grid", f"SELECT t.frame_idx, t.r, t.c, round(sum(wt * coalesce(g.disp, 0)), 6) + 0.0 AS disp FROM ({_TAPS.format(_UV)}) t LEFT JOIN grid g ON g.frame_idx = t.frame_idx AND g.r = tr AND g.c = tc GROUP BY ALL"))
def grid_sample_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    px = grid(spark, sf_dir)
    at = px.select("frame_idx", F.col("r").alias("r0"), F.col("c").alias("c0"), (F.col("c") + 0.8 * F.col("v")).alias("u"), (F.col("r") - 0.6 * F.col("v")).alias("v"))
    at = at.withColumn("f0", F.col("frame_idx"))
    out = n.sampled(at, px, "disp", ["f0", "r0", "c0"])
    return out.select(F.col("f0").alias("frame_idx"), F.col("r0").alias("r"), F.col("c0").alias("c"), g.r6(F.col("disp")).alias("disp"))


@query(sql("grid", f"SELECT frame_idx, tr AS r, tc AS c, round(sum(disp * wt) / sum(wt), 6) + 0.0 AS disp, round(sum(wt), 6) + 0.0 AS weight FROM ({_TAPS.format(_UV.replace(' FROM grid', ', disp FROM grid'))}) t WHERE tr BETWEEN 0 AND 7 AND tc BETWEEN 0 AND 7 AND wt > 0 GROUP BY ALL"))
def bilinear_splat(spark: SparkSession, sf_dir: str) -> DataFrame:
    px = grid(spark, sf_dir).select("frame_idx", "disp", (F.col("c") + 0.8 * F.col("v")).alias("u"), (F.col("r") - 0.6 * F.col("v")).alias("v"))
    return n.splatted(px, "disp").select("frame_idx", "r", "c", g.r6(F.col("disp")).alias("disp"), g.r6(F.col("weight")).alias("weight"))


@query(sql("grid", "SELECT frame_idx, r + dr AS r, c + dc AS c, arg_max(instance, r * 8 + c) AS instance FROM grid, (VALUES (0, 0), (0, 1), (1, 0), (0, -1), (-1, 0)) s(dr, dc) WHERE mask AND r + dr BETWEEN 0 AND 7 AND c + dc BETWEEN 0 AND 7 GROUP BY ALL"))
def stencil_scatter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each masked pixel drawn as a cross; where crosses overlap the later pixel's stays."""
    cross = F.array(*[F.struct(F.lit(a).alias("dr"), F.lit(b).alias("dc")) for a, b in ((0, 0), (0, 1), (1, 0), (0, -1), (-1, 0))])
    drawn = grid(spark, sf_dir).where("mask").select("frame_idx", "instance", (F.col("r") * 8 + F.col("c")).alias("ord"), "r", "c", F.explode(cross).alias("o"))
    drawn = drawn.select("frame_idx", "instance", "ord", (F.col("r") + F.col("o.dr")).alias("r"), (F.col("c") + F.col("o.dc")).alias("c"))
    return drawn.where(F.col("r").between(0, 7) & F.col("c").between(0, 7)).groupBy("frame_idx", "r", "c").agg(F.max_by("instance", "ord").alias("instance"))


@query(sql("grid", "SELECT frame_idx, round(avg(hit), 6) + 0.0 AS score FROM (SELECT frame_idx, r // 2 AS br, c // 2 AS bc, max(CASE WHEN v > 0.1 THEN 1.0 ELSE 0.0 END)::DOUBLE AS hit FROM grid GROUP BY ALL) GROUP BY ALL"))
def uv_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of blocks in which any pixel is set."""
    blocks = grid(spark, sf_dir).groupBy("frame_idx", F.floor(F.col("r") / 2).alias("br"), F.floor(F.col("c") / 2).alias("bc")).agg(F.max((F.col("v") > 0.1).cast("double")).alias("hit"))
    return blocks.groupBy("frame_idx").agg(g.r6(F.avg("hit")).alias("score"))


_PAIRED = "paired AS (SELECT a.frame_idx, a.r, a.c, a.depth AS x, b.depth AS y, a.disp AS dx, a.mask FROM grid a JOIN grid b ON b.frame_idx = a.frame_idx + 1 AND a.r = b.r AND a.c = b.c)"


def paired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Depth x of a frame and y of the next at the same pixel."""
    px = grid(spark, sf_dir)
    nxt = px.select((F.col("frame_idx") - 1).alias("frame_idx"), "r", "c", F.col("depth").alias("y"))
    return px.select("frame_idx", "r", "c", F.col("depth").alias("x"), F.col("disp").alias("dx"), "mask").join(nxt, n.KEY)


@query(sql("grid", "SELECT frame_idx, round(quantile_disc(y / x, 0.5), 6) + 0.0 AS scale FROM paired WHERE mask GROUP BY ALL", _PAIRED))
def median_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lower median of the ratio of depths."""
    return paired(spark, sf_dir).where("mask").groupBy("frame_idx").agg(g.r6(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY y / x)")).alias("scale"))


_FIT = "sum(x * x) AS a00, sum(x) AS a01, sum(1.0) AS a11, sum(x * y) AS b0, sum(y) AS b1"


@query(sql("grid", f"SELECT frame_idx, round((a11 * b0 - a01 * b1) / (a00 * a11 - a01 * a01), 6) + 0.0 AS scale, round((a00 * b1 - a01 * b0) / (a00 * a11 - a01 * a01), 6) + 0.0 AS shift FROM (SELECT frame_idx, {_FIT} FROM paired WHERE mask GROUP BY ALL) WHERE a00 * a11 - a01 * a01 > 1e-12", _PAIRED))
def scale_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Least-squares scale and shift from a frame's depth to the next; five sums a frame."""
    s = paired(spark, sf_dir).where("mask").groupBy("frame_idx").agg(F.sum(F.col("x") * F.col("x")).alias("a00"), F.sum("x").alias("a01"), F.sum(F.lit(1.0)).alias("a11"), F.sum(F.col("x") * F.col("y")).alias("b0"), F.sum("y").alias("b1"))
    det = F.col("a00") * F.col("a11") - F.col("a01") * F.col("a01")
    s = s.where(det > 1e-12)
    return s.select("frame_idx", g.r6((F.col("a11") * F.col("b0") - F.col("a01") * F.col("b1")) / det).alias("scale"), g.r6((F.col("a00") * F.col("b1") - F.col("a01") * F.col("b0")) / det).alias("shift"))


@query(sql("grid", "SELECT frame_idx, round(sum(x * y) / (sum(x * x) + 1e-6), 6) + 0.0 AS scale FROM paired WHERE mask GROUP BY ALL", _PAIRED))
def scale_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paired(spark, sf_dir).where("mask").groupBy("frame_idx").agg(g.r6(F.sum(F.col("x") * F.col("y")) / (F.sum(F.col("x") * F.col("x")) + 1e-6)).alias("scale"))


@query(sql("grid", "SELECT frame_idx, round(regr_slope(1 / y, dx), 6) + 0.0 AS slope, round(regr_intercept(1 / y, dx), 6) + 0.0 AS intercept FROM paired JOIN bounds USING (frame_idx) WHERE mask AND dx > xl AND dx < xh AND 1 / y > yl AND 1 / y < yh GROUP BY ALL", _PAIRED, "bounds AS (SELECT frame_idx, quantile_cont(dx, 0.1) AS xl, quantile_cont(dx, 0.9) AS xh, quantile_cont(1 / y, 0.1) AS yl, quantile_cont(1 / y, 0.9) AS yh FROM paired WHERE mask GROUP BY ALL)"))
def align_inv_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line from a frame's inverse depth to the next's, over pixels strictly between both's outer deciles."""
    p = paired(spark, sf_dir).where("mask").withColumn("iy", 1 / F.col("y"))
    q = lambda c, at: F.percentile(c, F.lit(at))
    bounds = p.groupBy("frame_idx").agg(q("dx", 0.1).alias("xl"), q("dx", 0.9).alias("xh"), q("iy", 0.1).alias("yl"), q("iy", 0.9).alias("yh"))
    kept = p.join(bounds, "frame_idx").where((F.col("dx") > F.col("xl")) & (F.col("dx") < F.col("xh")) & (F.col("iy") > F.col("yl")) & (F.col("iy") < F.col("yh")))
    return kept.groupBy("frame_idx").agg(g.r6(F.regr_slope("iy", "dx")).alias("slope"), g.r6(F.regr_intercept("iy", "dx")).alias("intercept"))


@query(sql("grid", "SELECT frame_idx, round(avg(abs(x - y) / y), 6) + 0.0 AS abs_rel, round(sqrt(avg((ln(x) - ln(y)) * (ln(x) - ln(y)))), 6) + 0.0 AS rmse_log, round(avg(CASE WHEN greatest(x / y, y / x) < 1.05 THEN 1.0 ELSE 0.0 END), 6) + 0.0 AS delta1, count(*) AS n FROM paired WHERE mask GROUP BY ALL", _PAIRED))
def depth_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y = F.col("x"), F.col("y")
    logs = F.ln(x) - F.ln(y)
    return paired(spark, sf_dir).where("mask").groupBy("frame_idx").agg(
        g.r6(F.avg(F.abs(x - y) / y)).alias("abs_rel"), g.r6(F.sqrt(F.avg(logs * logs))).alias("rmse_log"),
        g.r6(F.avg((F.greatest(x / y, y / x) < 1.05).cast("double"))).alias("delta1"), F.count(F.lit(1)).alias("n"),
    )


@query(sql("grid", "SELECT view_idx, round(quantile_cont(depth, 0.02), 6) + 0.0 AS lo, round(quantile_cont(depth, 0.98), 6) + 0.0 AS hi FROM grid WHERE mask GROUP BY ALL"))
def depth_range_quantile(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ranges.quantiles(grid(spark, sf_dir).where("mask"), "view_idx", "depth", [0.02, 0.98])
    at = lambda share: g.r6(F.max(F.when(F.col("share") == share, F.col("value"))))
    return found.groupBy("view_idx").agg(at(0.02).alias("lo"), at(0.98).alias("hi"))

