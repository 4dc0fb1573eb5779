"""Grouped reductions, block algebra, metrics and masks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framequery.functions import geometry as g
from framequery.operators import scatter
from framequery.sources.frames import edges, grid, poses, sql, streams, table

from .catalog import query


@query("SELECT l_suppkey AS idx, round(sum(l_quantity), 3) + 0.0 AS total FROM lineitem GROUP BY ALL")
def scatter_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("idx")).agg((F.round(F.sum("l_quantity"), 3) + F.lit(0.0)).alias("total"))


@query("SELECT l_orderkey AS idx, round(product(1 - l_discount), 6) + 0.0 AS product FROM lineitem GROUP BY ALL")
def scatter_mul(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("idx")).agg(g.r6(F.product(1 - F.col("l_discount"))).alias("product"))


@query("SELECT l_suppkey AS idx, floor(sum(l_linenumber) / count(*))::BIGINT AS mean FROM lineitem GROUP BY ALL")
def scatter_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scatter.scatter_mean(table(spark, sf_dir, "lineitem").withColumnRenamed("l_suppkey", "idx"), "idx", F.col("l_linenumber"), integral=True)


@query("SELECT l_partkey AS idx, round(min(l_extendedprice), 3) + 0.0 AS least, arg_min(l_orderkey * 10 + l_linenumber, (l_extendedprice, l_orderkey, l_linenumber)) AS at FROM lineitem GROUP BY ALL")
def scatter_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Least value and where it is, ties to the smaller key."""
    at = F.min(F.struct(F.col("l_extendedprice"), "l_orderkey", "l_linenumber"))
    m = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("idx")).agg(at.alias("m"))
    return m.select("idx", (F.round("m.l_extendedprice", 3) + F.lit(0.0)).alias("least"), (F.col("m.l_orderkey") * 10 + F.col("m.l_linenumber")).alias("at"))


@query("SELECT l_partkey AS idx, round(max(l_extendedprice), 3) + 0.0 AS most FROM lineitem GROUP BY ALL")
def scatter_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("idx")).agg((F.round(F.max("l_extendedprice"), 3) + F.lit(0.0)).alias("most"))


@query("SELECT c_custkey AS idx, count(o_orderkey) AS n, coalesce(max(o_orderkey), 0) AS last FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY ALL")
def scatter_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A slot for every customer, noughts where there is no order."""
    reduced = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("idx")).agg(F.count(F.lit(1)).alias("n"), F.max("o_orderkey").alias("last"))
    return scatter.dense(reduced, "idx", table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("idx")), ["n", "last"])


_A = "a AS (SELECT l_suppkey % 7 AS i, l_partkey % 5 AS j, l_linenumber % 2 AS \"row\", l_orderkey % 2 AS col, l_quantity AS x FROM lineitem WHERE l_returnflag = 'A')"
_B = "b AS (SELECT l_suppkey % 5 AS i, l_partkey % 6 AS j, l_orderkey % 2 AS \"row\", l_linenumber % 2 AS col, l_discount AS x FROM lineitem WHERE l_returnflag = 'R')"
_C = "ca AS (SELECT i, j, \"row\", col, sum(x) AS x FROM a GROUP BY ALL), cb AS (SELECT i, j, \"row\", col, sum(x) AS x FROM b GROUP BY ALL)"


def _blocks(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two sparse block matrices, duplicate entries summed before they meet."""
    l = table(spark, sf_dir, "lineitem")  # noqa: E741
    m = lambda c, n, out: (F.col(c) % n).cast("long").alias(out)
    a = l.where("l_returnflag = 'A'").select(m("l_suppkey", 7, "i"), m("l_partkey", 5, "j"), m("l_linenumber", 2, "row"), m("l_orderkey", 2, "col"), F.col("l_quantity").alias("x"))
    b = l.where("l_returnflag = 'R'").select(m("l_suppkey", 5, "i"), m("l_partkey", 6, "j"), m("l_orderkey", 2, "row"), m("l_linenumber", 2, "col"), F.col("l_discount").alias("x"))
    whole = lambda d: d.groupBy("i", "j", "row", "col").agg(F.sum("x").alias("x"))
    return whole(a), whole(b)


def _small(d: DataFrame) -> DataFrame:
    return d.withColumn("x", F.round("x", 3) + F.lit(0.0))


@query(f"WITH {_A}, {_B}, {_C} SELECT i, j, \"row\"::BIGINT AS \"row\", col::BIGINT AS col, round(sum(x), 3) + 0.0 AS x FROM (SELECT * FROM ca UNION ALL SELECT * FROM cb) GROUP BY ALL")
def block_add(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _small(scatter.block_add(*_blocks(spark, sf_dir)))


@query(f"WITH {_A}, {_B}, {_C} SELECT ca.i, cb.j, ca.\"row\"::BIGINT AS \"row\", cb.col::BIGINT AS col, round(sum(ca.x * cb.x), 3) + 0.0 AS x FROM ca JOIN cb ON ca.j = cb.i AND ca.col = cb.\"row\" GROUP BY ALL")
def block_matmul(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _small(scatter.block_matmul(*_blocks(spark, sf_dir)))


@query(f"WITH {_A}, {_B}, {_C}, v AS (SELECT i, \"row\", sum(x) AS x FROM cb GROUP BY ALL) SELECT ca.i, ca.\"row\"::BIGINT AS \"row\", round(sum(ca.x * v.x), 3) + 0.0 AS x FROM ca JOIN v ON ca.j = v.i AND ca.col = v.\"row\" GROUP BY ALL")
def block_matvec(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = _blocks(spark, sf_dir)
    return _small(scatter.block_matvec(a, b.groupBy("i", "row").agg(F.sum("x").alias("x"))))


@query(f"WITH {_A}, {_B}, {_C} SELECT i, \"row\"::BIGINT AS \"row\", round(sum(x), 3) + 0.0 AS x FROM (SELECT i, \"row\", x FROM ca UNION ALL SELECT i, \"row\", -x FROM cb) GROUP BY ALL")
def block_vec_add(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Difference of two block vectors, the matrices' row sums."""
    a, b = (d.select("i", "row", "x") for d in _blocks(spark, sf_dir))
    return _small(a.unionByName(b.withColumn("x", -F.col("x"))).groupBy("i", "row").agg(F.sum("x").alias("x")))


@query("WITH s AS (SELECT DISTINCT l_partkey AS p, l_suppkey AS s FROM lineitem) SELECT p, s, dense_rank() OVER (ORDER BY p) - 1 AS \"row\", dense_rank() OVER (ORDER BY s) - 1 AS col FROM s")
def block_ravel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense row and column numbers of sparse indices."""
    e = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("p"), F.col("l_suppkey").alias("s")).distinct()
    return e.join(scatter.dense_number(e, "p", "row"), "p").join(scatter.dense_number(e, "s", "col"), "s").select("p", "s", "row", "col")


@query(sql("grid", "SELECT frame_idx, min(score) AS score FROM (SELECT frame_idx, r // 4 AS half, round(sum(CASE WHEN mask THEN abs(v) ELSE 0 END) / greatest(sum(CASE WHEN mask THEN 1 ELSE 0 END), 1), 6) + 0.0 AS score FROM grid GROUP BY ALL) GROUP BY ALL"))
def motion_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Least of the masked means of the two halves of each frame."""
    on = F.col("mask").cast("double")
    half = grid(spark, sf_dir).groupBy("frame_idx", F.floor(F.col("r") / 4).alias("half")).agg(g.r6(F.sum(on * F.abs("v")) / F.greatest(F.sum(on), F.lit(1.0))).alias("score"))
    return half.groupBy("frame_idx").agg(F.min("score").alias("score"))


@query(sql("grid", "SELECT frame_idx, round(count(*) FILTER (WHERE v > 0.05) / nullif(count(*) FILTER (WHERE v > -0.05), 0), 6) + 0.0 AS stability FROM grid GROUP BY ALL"))
def stability_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    over = lambda t: F.sum((F.col("v") > t).cast("double"))
    return grid(spark, sf_dir).groupBy("frame_idx").agg(g.r6(F.try_divide(over(0.05), over(-0.05))).alias("stability"))


@query(sql("grid", "SELECT frame_idx, instance, min(r) AS r0, min(c) AS c0, max(r) AS r1, max(c) AS c1, count(*) AS area FROM grid WHERE instance > 0 GROUP BY ALL"))
def mask_bbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid(spark, sf_dir).where("instance > 0").groupBy("frame_idx", "instance").agg(F.min("r").alias("r0"), F.min("c").alias("c0"), F.max("r").alias("r1"), F.max("c").alias("c1"), F.count(F.lit(1)).alias("area"))


@query(sql("grid", "SELECT frame_idx, count(DISTINCT instance) AS distinct_ids, max(instance) AS n_objects FROM grid GROUP BY ALL"))
def object_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct ids and the number of objects, which is the greatest id."""
    return grid(spark, sf_dir).groupBy("frame_idx").agg(F.count_distinct("instance").alias("distinct_ids"), F.max("instance").alias("n_objects"))


@query(sql("poses", "SELECT track, " + ", ".join(f"round(quantile_cont(t{a}, 0.02), 6) + 0.0 AS lo_{a}, round(quantile_cont(t{a}, 0.98), 6) + 0.0 AS hi_{a}" for a in "xyz") + " FROM (SELECT *, frame_idx // 100 AS track FROM poses) GROUP BY ALL"))
def bbox_quantile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Box of the camera centres of each 100 frames without the outer two hundredths on each axis."""
    ends = [g.r6(F.percentile(f"t{a}", F.lit(q))).alias(f"{n}_{a}") for a in "xyz" for n, q in (("lo", 0.02), ("hi", 0.98))]
    return poses(spark, sf_dir).groupBy(F.floor(F.col("frame_idx") / 100).alias("track")).agg(*ends)


_Q = ("qx", "qy", "qz", "qw")


@query(sql("poses", "SELECT frame_idx // 20 AS track, " + ", ".join(f"round(avg({a} * {b}), 6) + 0.0 AS {a}{b}" for k, a in enumerate(_Q) for b in _Q[k:]) + ", round(avg(tx), 6) + 0.0 AS tx FROM poses GROUP BY ALL"))
def quat_outer_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten sums whose leading eigenvector is the mean rotation of each 20 frames."""
    outer = [g.r6(F.avg(F.col(a) * F.col(b))).alias(a + b) for k, a in enumerate(_Q) for b in _Q[k:]]
    return poses(spark, sf_dir).groupBy(F.floor(F.col("frame_idx") / 20).alias("track")).agg(*outer, g.r6(F.avg("tx")).alias("tx"))


_T = ("tx", "ty", "tz")


@query(sql("poses", "SELECT a.frame_idx // 50 AS track, count(*) AS n, " + ", ".join(f"round(covar_pop(a.{x}, b.{y}), 6) + 0.0 AS c_{x}_{y}" for x in _T for y in _T) + " FROM poses a JOIN poses b ON b.frame_idx = a.frame_idx + 1 GROUP BY ALL"))
def align_cov(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross-covariance of two paths, from which a small decomposition gives their alignment."""
    a = poses(spark, sf_dir).select("frame_idx", *_T)
    b = a.select((F.col("frame_idx") - 1).alias("frame_idx"), *[F.col(t).alias(f"b_{t}") for t in _T])
    return a.join(b, "frame_idx").groupBy(F.floor(F.col("frame_idx") / 50).alias("track")).agg(F.count(F.lit(1)).alias("n"), *[g.r6(F.covar_pop(x, f"b_{y}")).alias(f"c_{x}_{y}") for x in _T for y in _T])


@query(sql("keyframes edges grid", "SELECT i, j, round(avg(abs(g.v) + 0.01 * j), 6) + 0.0 AS weight FROM edges JOIN grid g ON g.frame_idx = 5 * i GROUP BY ALL"))
def edge_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean weight of each edge's grid. The grid is averaged once a frame, before it meets the edges."""
    mean = grid(spark, sf_dir).where(F.col("frame_idx") % 5 == 0).groupBy(F.floor(F.col("frame_idx") / 5).alias("i")).agg(F.avg(F.abs("v")).alias("m"))
    return edges(spark, sf_dir).join(mean, "i").select("i", "j", g.r6(F.col("m") + 0.01 * F.col("j")).alias("weight"))


@query(sql("keyframes edges poses", "SELECT i, arg_min(j, (d, j)) AS best, round(min(d), 6) + 0.0 AS d FROM (SELECT e.i, e.j, sqrt((a.tx - b.tx) * (a.tx - b.tx) + (a.ty - b.ty) * (a.ty - b.ty) + (a.tz - b.tz) * (a.tz - b.tz)) AS d FROM edges e JOIN poses a ON a.frame_idx = 5 * e.i JOIN poses b ON b.frame_idx = 5 * e.j) GROUP BY ALL"))
def best_cross_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest linked keyframe of each."""
    p = poses(spark, sf_dir).where(F.col("frame_idx") % 5 == 0)
    at = lambda k: p.select(F.floor(F.col("frame_idx") / 5).alias(k), *[F.col(t).alias(f"{k}_{t}") for t in _T])
    step = tuple(F.col(f"i_{t}") - F.col(f"j_{t}") for t in _T)
    d = edges(spark, sf_dir).join(at("i"), "i").join(at("j"), "j").select("i", F.struct(F.sqrt(g.dot(step, step)).alias("d"), "j").alias("o"))
    return d.groupBy("i").agg(F.min("o").alias("o")).select("i", F.col("o.j").alias("best"), g.r6(F.col("o.d")).alias("d"))


@query(sql("streams", "SELECT stream_id, round(avg(abs(d)), 6) + 0.0 AS motion, count(*) FILTER (WHERE lost) AS n_lost FROM (SELECT stream_id, score - lag(score) OVER w AS d, kp_id <> lag(kp_id) OVER w AS lost FROM streams WINDOW w AS (PARTITION BY stream_id ORDER BY frame_idx)) WHERE d IS NOT NULL GROUP BY ALL"))
def sparse_motion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean displacement of a stream's track, and how often the tracked point changes."""
    w = Window.partitionBy("stream_id").orderBy("frame_idx")
    d = streams(spark, sf_dir).select("stream_id", (F.col("score") - F.lag("score").over(w)).alias("d"), (F.col("kp_id") != F.lag("kp_id").over(w)).alias("lost")).where("d is not null")
    return d.groupBy("stream_id").agg(g.r6(F.avg(F.abs("d"))).alias("motion"), F.sum(F.col("lost").cast("long")).alias("n_lost"))
