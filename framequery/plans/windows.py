"""Queries over ordered frames: folds, overlapping windows, prediction, stateful choices."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framequery.functions import geometry as g
from framequery.operators import sequences
from framequery.sources.frames import grid, poses, sql, streams, table

from .catalog import query


_EMA = (
    "ema AS (SELECT stream_id, frame_idx, ln(1 + score) AS m FROM streams WHERE frame_idx = 0 UNION ALL "
    "SELECT s.stream_id, s.frame_idx, 0.9::DOUBLE * m + 0.1::DOUBLE * ln(1 + s.score) FROM ema e JOIN streams s ON s.stream_id = e.stream_id AND s.frame_idx = e.frame_idx + 1)"
)


@query(sql("streams", "SELECT stream_id, frame_idx, round(m, 4) + 0.0 AS ema FROM ema", _EMA).replace("WITH ", "WITH RECURSIVE ", 1))
def ema_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running average of the logarithm of each stream's scores, over all frames."""
    s = streams(spark, sf_dir).select("stream_id", "frame_idx", "score")
    return sequences.smoothed(s, "stream_id", "frame_idx", F.ln(1 + F.col("score")), 0.9, "ema", block=64, position=F.col("frame_idx")).select("stream_id", "frame_idx", (F.round("ema", 4) + F.lit(0.0)).alias("ema"))


@query(sql("streams", "SELECT stream_id, frame_idx, w FROM streams, range(2000) t(w) WHERE frame_idx >= w * 7 AND frame_idx < w * 7 + 10"))
def window_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of ten frames that overlap by three."""
    return streams(spark, sf_dir).select("stream_id", "frame_idx", F.explode(sequences.window_of(F.col("frame_idx"), 10, 3)).alias("w"))


@query(
    sql(
        "streams",
        "SELECT stream_id, frame_idx, round(sum(x * wt) / sum(wt), 6) + 0.0 AS blended FROM (SELECT *, CASE WHEN w > 0 AND p < 3 THEN (p + 1) / 4.0::DOUBLE WHEN p >= 7 THEN 1 - (p - 6) / 4.0::DOUBLE ELSE 1 END AS wt FROM (SELECT stream_id, frame_idx, w, frame_idx - 7 * w AS p, score + 0.5::DOUBLE * w AS x FROM streams, range(2000) t(w) WHERE frame_idx >= w * 7 AND frame_idx < w * 7 + 10)) GROUP BY ALL",
    )
)
def window_blend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-window values cross-faded where windows overlap."""
    s = streams(spark, sf_dir).select("stream_id", "frame_idx", "score", F.explode(sequences.window_of(F.col("frame_idx"), 10, 3)).alias("w"))
    out = sequences.blended(s, "stream_id", "frame_idx", "w", F.col("score") + 0.5 * F.col("w"), 10, 3, "blended")
    return out.select("stream_id", "frame_idx", g.r6(F.col("blended")).alias("blended"))


@query(sql("streams", "SELECT stream_id, w, min(frame_idx) AS first, max(frame_idx) AS last, 32 - count(*) AS padded FROM streams, range(1000) t(w) WHERE frame_idx >= w * 22 AND frame_idx < w * 22 + 32 GROUP BY ALL"))
def vda_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles of 32 frames that overlap by ten, and how many frames repeat the last to fill one."""
    s = streams(spark, sf_dir).select("stream_id", "frame_idx", F.explode(sequences.window_of(F.col("frame_idx"), 32, 10)).alias("w"))
    return s.groupBy("stream_id", "w").agg(F.min("frame_idx").alias("first"), F.max("frame_idx").alias("last"), (32 - F.count(F.lit(1))).alias("padded"))


_Q = ("qx", "qy", "qz", "qw")


@query(sql("poses", "SELECT frame_idx, " + ", ".join(f"round(t{a} + 0.5 * (t{a} - p{a}), 6) + 0.0 AS n{a}" for a in "xyz") + " FROM (SELECT *, lag(tx) OVER w AS px, lag(ty) OVER w AS py, lag(tz) OVER w AS pz FROM poses WINDOW w AS (PARTITION BY frame_idx // 100 ORDER BY frame_idx)) WHERE px IS NOT NULL"))
def position_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half a step on at constant velocity, for translations."""
    w = Window.partitionBy(F.floor(F.col("frame_idx") / 100)).orderBy("frame_idx")
    n = [g.r6(F.col(f"t{a}") + 0.5 * (F.col(f"t{a}") - F.lag(f"t{a}").over(w))).alias(f"n{a}") for a in "xyz"]
    return poses(spark, sf_dir).select("frame_idx", *n).where("nx is not null")


@query()
def pose_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half a step on at constant velocity: exp(log(p2 p1^-1) / 2) p2."""
    w = Window.partitionBy(F.floor(F.col("frame_idx") / 100)).orderBy("frame_idx")
    before = poses(spark, sf_dir).select("*", *[F.lag(n).over(w).alias(f"a_{n}") for n in g.Pose._fields]).where("a_tx is not null")
    step = before.select("frame_idx", *g.Pose._fields, *[c.alias(f"d_{n}") for n, c in g.compose(g.pose(), g.inverse(g.pose("a_"))).named().items()])
    tau, phi = g.se3_log(g.pose("d_"))
    twist = step.select("frame_idx", *g.Pose._fields, *[(0.5 * c).alias(f"x{k}") for k, c in enumerate((*tau, *phi))])
    half = g.se3_exp(tuple(F.col(f"x{k}") for k in range(3)), tuple(F.col(f"x{k}") for k in range(3, 6)))
    moved = twist.select("frame_idx", *g.Pose._fields, *[c.alias(f"h_{n}") for n, c in half.named().items()])
    return moved.select("frame_idx", *[g.r6(c).alias(n) for n, c in g.compose(g.pose("h_"), g.pose()).named().items()])


@query()
def pose_interp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Poses between keyframes, along the twist from the keyframe before to the one after."""
    p = poses(spark, sf_dir)
    k = F.floor(F.col("frame_idx") / 5)
    key = p.where(F.col("frame_idx") % 5 == 0)
    a = key.select(k.alias("k"), *[F.col(n).alias(f"a_{n}") for n in g.Pose._fields])
    b = key.select((k - 1).alias("k"), *[F.col(n).alias(f"b_{n}") for n in g.Pose._fields])
    pair = a.join(b, "k")
    step = pair.select("k", *[f"a_{n}" for n in g.Pose._fields], *[c.alias(f"d_{n}") for n, c in g.compose(g.pose("b_"), g.inverse(g.pose("a_"))).named().items()])
    tau, phi = g.se3_log(g.pose("d_"))
    twist = step.select("k", *[f"a_{n}" for n in g.Pose._fields], *[c.alias(f"x{j}") for j, c in enumerate((*tau, *phi))])
    frames = p.select("frame_idx", k.alias("k"), (F.col("frame_idx") % 5 / (5 + 1e-3)).alias("s")).join(twist, "k")
    part = g.se3_exp(tuple(F.col(f"x{j}") * F.col("s") for j in range(3)), tuple(F.col(f"x{j}") * F.col("s") for j in range(3, 6)))
    moved = frames.select("frame_idx", *[f"a_{n}" for n in g.Pose._fields], *[c.alias(f"h_{n}") for n, c in part.named().items()])
    return moved.select("frame_idx", *[g.r6(c).alias(n) for n, c in g.compose(g.pose("h_"), g.pose("a_")).named().items()])


@query(sql("grid", "SELECT frame_idx, coalesce(last_value(CASE WHEN share >= 0.5 THEN scale END IGNORE NULLS) OVER (PARTITION BY frame_idx // 50 ORDER BY frame_idx), 1) AS scale FROM (SELECT frame_idx, avg(CASE WHEN mask THEN 1.0 ELSE 0.0 END) AS share, round(quantile_disc(depth, 0.5), 6) + 0.0 AS scale FROM grid GROUP BY ALL)"))
def pano_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Median depth of each frame, or the last good one's where too few pixels are valid; 1 before any."""
    f = grid(spark, sf_dir).groupBy("frame_idx").agg(F.avg(F.col("mask").cast("double")).alias("share"), g.r6(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY depth)")).alias("m"))
    upto = Window.partitionBy(F.floor(F.col("frame_idx") / 50)).orderBy("frame_idx").rowsBetween(Window.unboundedPreceding, 0)
    return f.select("frame_idx", F.coalesce(F.last(F.when(F.col("share") >= 0.5, F.col("m")), ignorenulls=True).over(upto), F.lit(1.0)).alias("scale"))


@query(sql("streams", "SELECT stream_id, frame_idx, (frame_idx + 1) % n AS ahead, (frame_idx - 1 + n) % n AS behind FROM streams JOIN (SELECT stream_id, count(*) AS n FROM streams GROUP BY ALL) USING (stream_id)"))
def timestep_mod(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = streams(spark, sf_dir).select("stream_id", "frame_idx")
    n = s.groupBy("stream_id").agg(F.count(F.lit(1)).alias("n"))
    return s.join(n, "stream_id").select("stream_id", "frame_idx", F.pmod(F.col("frame_idx") + 1, "n").alias("ahead"), F.pmod(F.col("frame_idx") - 1, "n").alias("behind"))


@query(sql("streams", "SELECT stream_id, frame_idx, CASE WHEN frame_idx = 0 THEN 'detect' WHEN frame_idx % 5 = 0 THEN 'detect and track' ELSE 'track' END AS action, frame_idx // 16 AS chunk, frame_idx // 4 AS batch, frame_idx + 1 IN (16, 64, 256) AS triggers FROM streams"))
def detector_cadence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each frame sets off: detection, in-fill chunk, encoder batch, backend pass."""
    i = F.col("frame_idx")
    action = F.when(i == 0, "detect").when(i % 5 == 0, "detect and track").otherwise("track")
    return streams(spark, sf_dir).select("stream_id", "frame_idx", action.alias("action"), F.floor(i / 16).alias("chunk"), F.floor(i / 4).alias("batch"), (i + 1).isin(16, 64, 256).alias("triggers"))


_WALK = """RECURSIVE n AS (SELECT *, max(frame_idx) OVER (PARTITION BY stream_id) AS last FROM streams), walk AS (SELECT stream_id, frame_idx, score AS ref, TRUE AS taken, last FROM n WHERE frame_idx = 0 UNION ALL SELECT n.stream_id, n.frame_idx, CASE WHEN abs(n.score - w.ref) > 60 THEN n.score ELSE w.ref END, abs(n.score - w.ref) > 60, n.last FROM walk w JOIN n ON n.stream_id = w.stream_id AND n.frame_idx = w.frame_idx + 1)"""


@query("WITH RECURSIVE " + sql("streams", "").removeprefix("WITH ").strip() + ", " + _WALK.removeprefix("RECURSIVE ") + " SELECT stream_id, frame_idx FROM walk WHERE taken OR frame_idx = last")
def keyframe_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames whose score is more than 60 from the last one taken, and each stream's first and last."""
    return sequences.select_keyframes(streams(spark, sf_dir), "stream_id", "frame_idx", "score", 60.0)


@query("SELECT user_id AS stream_id, time_bucket(INTERVAL 1 DAY, ts) AS day, count(*) AS n, round(sum(value), 4) + 0.0 AS total FROM events GROUP BY ALL")
def event_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily totals of a stream; streaming.replay runs the same over a replayed source."""
    w = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("stream_id"), F.window("ts", "1 day")).agg(F.count(F.lit(1)).alias("n"), (F.round(F.sum("value"), 4) + F.lit(0.0)).alias("total"))
    return w.select("stream_id", F.col("window.start").alias("day"), "n", "total")
