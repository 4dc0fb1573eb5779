"""The frame model over the given tables: grids, poses, streams, tracks, edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framequery.operators.scatter import numbered

#: Side of the square grid that an embedding is.
SIDE = 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(frame_idx, view_idx, r, c, v, disp, depth, mask, instance): one row a pixel."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "label", F.posexplode("embedding").alias("p", "e"))
    v = F.col("e").cast("double")
    disp = 1 + 0.15 * v
    return e.select(
        F.col("vec_id").alias("frame_idx"), (F.col("label") % 2).cast("long").alias("view_idx"), F.floor(F.col("p") / SIDE).cast("long").alias("r"), (F.col("p") % SIDE).cast("long").alias("c"),
        v.alias("v"), disp.alias("disp"), (1 / disp).alias("depth"), (v > -0.1).alias("mask"), F.when(v > 0, F.col("label") + 1).otherwise(0).cast("long").alias("instance"),
    )


def poses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(frame_idx, tx..qw): small motions, camera to world."""
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("frame_idx"), *[(0.1 * F.col("embedding")[k].cast("double")).alias(f"e{k}") for k in range(6)])
    n = F.sqrt(F.col("e3") * F.col("e3") + F.col("e4") * F.col("e4") + F.col("e5") * F.col("e5") + 1)
    return e.select("frame_idx", *[F.col(f"e{k}").alias(f"t{a}") for k, a in enumerate("xyz")], *[(F.col(f"e{k + 3}") / n).alias(f"q{a}") for k, a in enumerate("xyz")], (1 / n).alias("qw"))


def keyframes(spark: SparkSession, sf_dir: str, every: int = 5) -> DataFrame:
    return table(spark, sf_dir, "embeddings").where(F.col("vec_id") % every == 0).select(F.floor(F.col("vec_id") / every).cast("long").alias("kf_idx"), F.col("vec_id").alias("frame_idx"))


def edges(spark: SparkSession, sf_dir: str, radius: int = 3) -> DataFrame:
    """(i, j): keyframes at most ``radius`` apart, both ways, found by offset rather than by pairing all."""
    k = keyframes(spark, sf_dir).select(F.col("kf_idx"))
    offsets = F.array(*[F.lit(d) for d in range(-radius, radius + 1) if d])
    near = k.select(F.col("kf_idx").alias("i"), F.explode(F.transform(offsets, lambda d: F.col("kf_idx") + d)).alias("j"))
    return near.join(k, near["j"] == k["kf_idx"], "left_semi")


def streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(stream_id, frame_idx, raw_frame_idx, ts, phrase, score, kp_id): one row a frame, numbered from 0."""
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type", "value", "props")
    e = numbered(e, "user_id", F.date_trunc("day", "ts"), [F.col("ts"), F.col("event_id")], "frame_idx")
    return e.select(
        F.col("user_id").alias("stream_id"), "frame_idx", F.col("event_id").alias("raw_frame_idx"), "ts",
        F.col("event_type").alias("phrase"), F.col("value").alias("score"), F.get_json_object("props", "$.k").cast("long").alias("kp_id"),
    )


def tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(view_idx, frame_idx, kp_id, u, v): the earliest observation of each key point in a frame of a view."""
    e = table(spark, sf_dir, "events").select((F.col("user_id") % 4).alias("view_idx"), (F.dayofmonth("ts") - 1).cast("long").alias("frame_idx"), F.get_json_object("props", "$.k").cast("long").alias("kp_id"), F.struct("event_id", F.col("value").alias("u"), F.hour("ts").cast("double").alias("v")).alias("o"))
    first = e.groupBy("view_idx", "frame_idx", "kp_id").agg(F.min("o").alias("o"))
    return first.select("view_idx", "frame_idx", "kp_id", "o.u", "o.v")


#: The same views for the DuckDB oracles.
SQL = {
    "grid": "grid AS (SELECT frame_idx, view_idx, r, c, v, 1 + 0.15 * v AS disp, 1 / (1 + 0.15 * v) AS depth, v > -0.1 AS mask, CASE WHEN v > 0 THEN label + 1 ELSE 0 END::BIGINT AS instance FROM (SELECT vec_id AS frame_idx, label, (label % 2)::BIGINT AS view_idx, (p // 8)::BIGINT AS r, (p % 8)::BIGINT AS c, embedding[p + 1]::DOUBLE AS v FROM embeddings, range(64) t(p)))",
    "poses": "poses AS (SELECT frame_idx, e0 AS tx, e1 AS ty, e2 AS tz, e3 / n AS qx, e4 / n AS qy, e5 / n AS qz, 1 / n AS qw FROM (SELECT *, sqrt(e3 * e3 + e4 * e4 + e5 * e5 + 1) AS n FROM (SELECT vec_id AS frame_idx, " + ", ".join(f"0.1::DOUBLE * embedding[{k + 1}]::DOUBLE AS e{k}" for k in range(6)) + " FROM embeddings)))",
    "keyframes": "keyframes AS (SELECT vec_id // 5 AS kf_idx, vec_id AS frame_idx FROM embeddings WHERE vec_id % 5 = 0)",
    "edges": "edges AS (SELECT a.kf_idx AS i, b.kf_idx AS j FROM keyframes a, keyframes b WHERE abs(a.kf_idx - b.kf_idx) BETWEEN 1 AND 3)",
    "streams": "streams AS (SELECT user_id AS stream_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS frame_idx, event_id AS raw_frame_idx, ts, event_type AS phrase, value AS score, json_extract_string(props, '$.k')::BIGINT AS kp_id FROM events)",
    "tracks": "tracks AS (SELECT view_idx, frame_idx, kp_id, u, v FROM (SELECT user_id % 4 AS view_idx, day(ts) - 1 AS frame_idx, json_extract_string(props, '$.k')::BIGINT AS kp_id, value AS u, hour(ts)::DOUBLE AS v, row_number() OVER (PARTITION BY user_id % 4, day(ts) - 1, json_extract_string(props, '$.k')::BIGINT ORDER BY event_id) AS n FROM events) WHERE n = 1)",
}


def sql(views: str, body: str, *more: str) -> str:
    """DuckDB SQL: ``body`` with the named views, and ``more`` of them, before it."""
    return "WITH " + ", ".join([*(SQL[v] for v in views.split()), *more]) + " " + body
