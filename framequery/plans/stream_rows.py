"""Queries over streams and metadata: selection, attributes, strings, sinks' text lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framequery.functions import geometry as g
from framequery.operators import ranges
from framequery.sources.frames import grid, poses, sql, streams, table

from .catalog import query


@query(sql("streams", "SELECT stream_id, frame_idx, raw_frame_idx, (frame_idx - 2) // 3 AS new_idx FROM streams WHERE frame_idx >= 2 AND frame_idx < 50 AND (frame_idx - 2) % 3 = 0"))
def scan_seek_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames 2, 5, 8, ... below 50 of every stream, numbered anew."""
    i = F.col("frame_idx")
    s = streams(spark, sf_dir).where((i >= 2) & (i < 50) & ((i - 2) % 3 == 0))
    return s.select("stream_id", "frame_idx", "raw_frame_idx", F.floor((i - 2) / 3).alias("new_idx"))


@query("SELECT path, regexp_extract(path, '([^/]+)_info\\.pkl$', 1) AS stem, row_number() OVER (PARTITION BY source ORDER BY path) - 1 AS n FROM (SELECT source, source || '/' || doc_id::VARCHAR || CASE WHEN doc_id % 3 = 0 THEN '_info.pkl' ELSE '.tmp' END AS path FROM documents) WHERE path LIKE '%\\_info.pkl' ESCAPE '\\'")
def stream_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Artifact paths of each folder in order, with their stems."""
    suffix = F.when(F.col("doc_id") % 3 == 0, "_info.pkl").otherwise(".tmp")
    p = table(spark, sf_dir, "documents").select("source", F.concat("source", F.lit("/"), F.col("doc_id").cast("string"), suffix).alias("path")).where(F.col("path").endswith("_info.pkl"))
    n = F.row_number().over(Window.partitionBy("source").orderBy("path")) - 1
    return p.select("path", F.regexp_extract("path", r"([^/]+)_info\.pkl$", 1).alias("stem"), n.cast("long").alias("n"))


@query("SELECT DISTINCT source AS tar_name, CASE WHEN source LIKE 'src10%' THEN 'a' WHEN source LIKE 'src1%' THEN 'b' END AS repo FROM documents WHERE source LIKE 'src1%'")
def meta_prefix_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.col("source")
    repo = F.when(name.startswith("src10"), "a").when(name.startswith("src1"), "b").otherwise(F.raise_error(F.concat(F.lit("no repository for "), name)))
    return table(spark, sf_dir, "documents").where(name.startswith("src1")).select(name.alias("tar_name"), repo.alias("repo")).distinct()


@query("SELECT regexp_extract(url, '://([^/]+)/', 1) AS link, count(*) AS n, string_agg(page_id::VARCHAR, ',' ORDER BY page_id) AS pages FROM pages GROUP BY ALL")
def meta_group_by_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages").select(F.regexp_extract("url", "://([^/]+)/", 1).alias("link"), "page_id")
    return p.groupBy("link").agg(F.count(F.lit(1)).alias("n"), F.array_join(F.sort_array(F.collect_list("page_id")).cast("array<string>"), ",").alias("pages"))


@query("SELECT event_id, round(secs + dur, 3) + 0.0 AS stop_s, round(dur, 3) + 0.0 AS duration FROM (SELECT event_id, hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS secs, (event_id % 90 + 1)::DOUBLE AS dur FROM events)")
def clip_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clips written as HH:MM:SS-HH:MM:SS, read back to seconds."""
    start = F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts")
    written = lambda s: F.format_string("%02d:%02d:%02d", F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60)
    clips = table(spark, sf_dir, "events").select("event_id", F.concat(written(start), F.lit("-"), written(start + F.col("event_id") % 90 + 1)).alias("clip"))

    def seconds(t):
        p = F.split(t, ":")
        return p[0].cast("double") * 3600 + p[1].cast("double") * 60 + p[2].cast("double")

    a, b = seconds(F.split("clip", "-")[0]), seconds(F.split("clip", "-")[1])
    return clips.select("event_id", (F.round(b, 3) + F.lit(0.0)).alias("stop_s"), (F.round(b - a, 3) + F.lit(0.0)).alias("duration"))


@query(sql("streams", "SELECT stream_id, kp_id, arg_max(phrase, frame_idx) AS phrase FROM streams GROUP BY ALL"))
def phrases_union_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streams(spark, sf_dir).groupBy("stream_id", "kp_id").agg(F.max_by("phrase", "frame_idx").alias("phrase"))


@query(sql("streams", "SELECT stream_id, frame_idx, kp_id::VARCHAR || ': ' || phrase AS line, kp_id AS id, phrase FROM streams"))
def phrases_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines 'id: phrase' taken apart again."""
    s = streams(spark, sf_dir).select("stream_id", "frame_idx", F.concat(F.col("kp_id").cast("string"), F.lit(": "), "phrase").alias("line"))
    p = F.split("line", ":", 2)
    return s.select("stream_id", "frame_idx", "line", F.trim(p[0]).cast("long").alias("id"), F.trim(p[1]).alias("phrase"))


@query(sql("streams", "SELECT stream_id, frame_idx, concat_ws(',', CASE WHEN phrase <> 'error' THEN 'phrase' END, CASE WHEN score > 50 THEN 'score' END, CASE WHEN kp_id % 2 = 0 THEN 'kp_id' END) AS present FROM streams"))
def attributes_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of the attributes a frame has."""
    has = [F.when(F.col("phrase") != "error", F.lit("phrase")), F.when(F.col("score") > 50, F.lit("score")), F.when(F.col("kp_id") % 2 == 0, F.lit("kp_id"))]
    return streams(spark, sf_dir).select("stream_id", "frame_idx", F.array_join(F.array_compact(F.array(*has)), ",").alias("present"))


@query(sql("streams", "SELECT stream_id, frame_idx // 256 AS block, string_agg(kp_id::VARCHAR, ',' ORDER BY frame_idx) AS kp_ids, count(*) AS n FROM streams GROUP BY ALL"))
def stream_attribute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One attribute of a stream as lists in frame order, 256 frames each, so that no list grows with its stream."""
    in_order = F.sort_array(F.collect_list(F.struct("frame_idx", "kp_id")))
    blocks = streams(spark, sf_dir).groupBy("stream_id", F.floor(F.col("frame_idx") / 256).alias("block"))
    return blocks.agg(F.array_join(F.transform(in_order, lambda x: x["kp_id"].cast("string")), ",").alias("kp_ids"), F.count(F.lit(1)).alias("n"))


@query("SELECT vec_id AS frame_idx, round(8 * (4 + label) / 8.0::DOUBLE, 6) + 0.0 AS fx, round(8 * (5 + label) / 8.0::DOUBLE, 6) + 0.0 AS fy, round(4 * (4 + label) / 8.0::DOUBLE, 6) + 0.0 AS cx, round(4 * (5 + label) / 8.0::DOUBLE, 6) + 0.0 AS cy, 1.0::DOUBLE AS fx_eighth FROM embeddings")
def resize_intrinsics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intrinsics of frames resized to (5 + label) x (4 + label), each axis by its own factor."""
    w, h = (4 + F.col("label")) / 8, (5 + F.col("label")) / 8
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("frame_idx"), g.r6(8 * w).alias("fx"), g.r6(8 * h).alias("fy"), g.r6(4 * w).alias("cx"), g.r6(4 * h).alias("cy"), F.lit(1.0).alias("fx_eighth"))


@query("SELECT p_partkey, h1 AS h, w1 AS w, h1 // 8 * 8 AS h_crop, w1 // 8 * 8 AS w_crop, (h1 % 8) // 2 AS top, (w1 % 8) // 2 AS \"left\" FROM (SELECT p_partkey, floor(h * sqrt(384 * 512 / (h * w)))::BIGINT AS h1, floor(w * sqrt(384 * 512 / (h * w)))::BIGINT AS w1 FROM (SELECT p_partkey, (p_size * 20 + 100)::DOUBLE AS h, (p_size * 30 + 64)::DOUBLE AS w FROM part))")
def standard_resize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes scaled to one area, then cropped about the centre to multiples of eight."""
    h, w = (F.col("p_size") * 20 + 100).cast("double"), (F.col("p_size") * 30 + 64).cast("double")
    k = F.sqrt(F.lit(384 * 512) / (h * w))
    s = table(spark, sf_dir, "part").select("p_partkey", F.floor(h * k).alias("h"), F.floor(w * k).alias("w"))
    down = lambda x, n: F.floor(x / n)
    return s.select("p_partkey", "h", "w", (down(F.col("h"), 8) * 8).alias("h_crop"), (down(F.col("w"), 8) * 8).alias("w_crop"), down(F.col("h") % 8, 2).alias("top"), down(F.col("w") % 8, 2).alias("left"))


@query(sql("streams", "SELECT s.stream_id, s.frame_idx FROM streams s JOIN (SELECT stream_id, least(3, (count(*) - 1) // 2) AS gap FROM streams GROUP BY ALL) n USING (stream_id) WHERE s.frame_idx IN (0, gap, 2 * gap)"))
def sample_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three frames of a stream, a gap apart, for estimating its camera."""
    s = streams(spark, sf_dir).select("stream_id", "frame_idx")
    gap = s.groupBy("stream_id").agg(F.least(F.lit(3), F.floor((F.count(F.lit(1)) - 1) / 2)).alias("gap"))
    return s.join(gap, "stream_id").where(F.col("frame_idx").isin(0) | (F.col("frame_idx") == F.col("gap")) | (F.col("frame_idx") == 2 * F.col("gap"))).select("stream_id", "frame_idx")


@query(sql("grid", "SELECT g.frame_idx, g.r, g.c FROM grid g WHERE instance > 0 AND instance % 5 = 1"))
def sky_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pixels of instances whose phrase is 'sky'; the small phrase table is one row a frame and instance."""
    px = grid(spark, sf_dir).select("frame_idx", "r", "c", "instance")
    phrases = px.where("instance > 0").select("frame_idx", "instance").distinct().withColumn("phrase", F.when(F.col("instance") % 5 == 1, "sky").otherwise("thing"))
    return px.join(phrases.where("phrase = 'sky'"), ["frame_idx", "instance"], "left_semi").select("frame_idx", "r", "c")


@query(sql("grid", "SELECT frame_idx, r, c, round(v, 6) + 0.0 AS v FROM grid WHERE frame_idx % 3 = 0 AND r % 2 = 0 AND c % 2 = 0"))
def subsample(spark: SparkSession, sf_dir: str) -> DataFrame:
    px = grid(spark, sf_dir).where((F.col("frame_idx") % 3 == 0) & (F.col("r") % 2 == 0) & (F.col("c") % 2 == 0))
    return px.select("frame_idx", "r", "c", g.r6(F.col("v")).alias("v"))


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity * (l_tax * 100 + 1) <= 64 * 0.9::DOUBLE AND greatest(l_discount, l_tax) > 0.03")
def box_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes not larger than a share of the frame whose best score passes; pushed into the scan as far as it goes."""
    area = F.col("l_quantity") * (F.col("l_tax") * 100 + 1)
    return table(spark, sf_dir, "lineitem").where((area <= 64 * 0.9) & (F.greatest("l_discount", "l_tax") > 0.03)).select("l_orderkey", "l_linenumber")


@query("SELECT o_orderkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l_returnflag = 'R')")
def skip_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streams that are not in the list of those done."""
    done = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return table(spark, sf_dir, "orders").select("o_orderkey").join(done, "o_orderkey", "left_anti")


@query(sql("streams", "SELECT stream_id, string_agg(phrase || '.', '' ORDER BY phrase) AS caption FROM (SELECT DISTINCT stream_id, phrase FROM streams) GROUP BY ALL"))
def caption_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streams(spark, sf_dir).groupBy("stream_id").agg(F.concat(F.array_join(F.sort_array(F.collect_set("phrase")), "."), F.lit(".")).alias("caption"))


@query("SELECT p_partkey, split_part(name, '_', 1) AS kind, split_part(split_part(name, '_', 2), '-', 1) AS model, CASE WHEN split_part(name, '_', 2) LIKE '%-%' THEN split_part(split_part(name, '_', 2), '-', 2) END AS size FROM (SELECT p_partkey, lower(p_brand) || '_' || replace(lower(p_type), ' ', '-') AS name FROM part)")
def model_name_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names like 'kind_model-size' taken apart."""
    name = F.concat(F.lower("p_brand"), F.lit("_"), F.replace(F.lower("p_type"), F.lit(" "), F.lit("-")))
    p = table(spark, sf_dir, "part").select("p_partkey", F.split(name, "_").alias("parts"))
    tail = F.split(F.col("parts")[1], "-")
    return p.select("p_partkey", F.col("parts")[0].alias("kind"), tail[0].alias("model"), F.try_element_at(tail, F.lit(2)).alias("size"))


@query(sql("streams", "SELECT stream_id, frame_idx, count(*) FILTER (WHERE seen) AS present FROM (SELECT s.stream_id, s.frame_idx, p.kp_id % 2 = s.frame_idx % 2 AS seen FROM streams s JOIN (SELECT DISTINCT stream_id, kp_id FROM streams WHERE phrase = 'click') p USING (stream_id)) GROUP BY ALL"))
def phrases_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many of a stream's clicked ids are present in each frame: a map of phrases, filtered by id."""
    s = streams(spark, sf_dir)
    ids = s.where("phrase = 'click'").groupBy("stream_id").agg(F.collect_set("kp_id").alias("ids"))
    return s.join(ids, "stream_id").select("stream_id", "frame_idx", F.size(F.filter("ids", lambda i: i % 2 == F.col("frame_idx") % 2)).cast("long").alias("present"))


@query(sql("grid", "SELECT frame_idx, string_agg(n::VARCHAR, ',' ORDER BY run) AS rle, sum(CASE WHEN on_ THEN n ELSE 0 END)::BIGINT AS area FROM (SELECT frame_idx, run, bool_or(mask) AS on_, count(*) AS n FROM (SELECT frame_idx, mask, sum(step) OVER (PARTITION BY frame_idx ORDER BY c * 8 + r) AS run FROM (SELECT *, CASE WHEN mask = lag(mask, 1, NOT mask) OVER (PARTITION BY frame_idx ORDER BY c * 8 + r) THEN 0 ELSE 1 END AS step FROM grid)) GROUP BY frame_idx, run) GROUP BY ALL"))
def mask_rle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run lengths of each mask down its columns, and its area: gaps and islands."""
    order = Window.partitionBy("frame_idx").orderBy(F.col("c") * 8 + F.col("r"))
    step = F.when(F.col("mask") == F.lag("mask").over(order), 0).otherwise(1)
    runs = grid(spark, sf_dir).withColumn("step", step).withColumn("run", F.sum("step").over(order)).groupBy("frame_idx", "run").agg(F.count(F.lit(1)).alias("n"), F.bool_or("mask").alias("on"))
    in_order = F.transform(F.sort_array(F.collect_list(F.struct("run", "n"))), lambda x: x["n"].cast("string"))
    return runs.groupBy("frame_idx").agg(F.array_join(in_order, ",").alias("rle"), F.sum(F.when(F.col("on"), F.col("n")).otherwise(0)).alias("area"))


@query("SELECT o_orderkey, coalesce(camera, 'pinhole') AS camera, CASE coalesce(camera, 'pinhole') WHEN 'mei' THEN 5 ELSE 4 END::BIGINT AS dims FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey, 'mei' AS camera FROM lineitem WHERE l_linenumber = 5) ON l_orderkey = o_orderkey")
def intrinsics_default_camera(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Camera kinds from a table that may lack rows, which then mean a pinhole of four numbers."""
    kinds = table(spark, sf_dir, "lineitem").where("l_linenumber = 5").select(F.col("l_orderkey").alias("o_orderkey"), F.lit("mei").alias("kind")).distinct()
    camera = F.coalesce("kind", F.lit("pinhole"))
    return table(spark, sf_dir, "orders").select("o_orderkey").join(kinds, "o_orderkey", "left").select("o_orderkey", camera.alias("camera"), F.when(camera == "mei", 5).otherwise(4).cast("long").alias("dims"))


@query(sql("grid poses", "SELECT kf, view_idx, n, sum(n) OVER (PARTITION BY view_idx ORDER BY kf) - n AS start FROM (SELECT frame_idx // 5 AS kf, view_idx, count(*) FILTER (WHERE mask) AS n FROM grid WHERE frame_idx % 5 = 0 GROUP BY ALL)"))
def map_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Masked points of each keyframe, and how many come before them in its view."""
    n = grid(spark, sf_dir).where(F.col("frame_idx") % 5 == 0).groupBy(F.floor(F.col("frame_idx") / 5).alias("kf"), "view_idx").agg(F.sum(F.col("mask").cast("long")).alias("n"))
    return ranges.running_sum(n, ["view_idx"], [F.col("kf")], "n", "start")


@query(sql("poses", "SELECT round(sum(d), 5) + 0.0 AS length, count(*) AS steps, track FROM (SELECT frame_idx // 50 AS track, sqrt((tx - ax) * (tx - ax) + (ty - ay) * (ty - ay) + (tz - az) * (tz - az)) AS d FROM (SELECT *, lag(tx) OVER w AS ax, lag(ty) OVER w AS ay, lag(tz) OVER w AS az FROM poses WINDOW w AS (PARTITION BY frame_idx // 50 ORDER BY frame_idx))) WHERE d IS NOT NULL GROUP BY track"))
def trajectory_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length of the path over each 50 frames."""
    p = poses(spark, sf_dir).withColumn("track", F.floor(F.col("frame_idx") / 50))
    w = Window.partitionBy("track").orderBy("frame_idx")
    step = [F.col(a) - F.lag(a).over(w) for a in ("tx", "ty", "tz")]
    d = p.select("track", F.sqrt(g.dot(tuple(step), tuple(step))).alias("d")).where("d is not null")
    return d.groupBy("track").agg((F.round(F.sum("d"), 5) + F.lit(0.0)).alias("length"), F.count(F.lit(1)).alias("steps"))
