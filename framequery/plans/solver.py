"""Queries of the bundle adjustment's parts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framequery.functions import geometry as g
from framequery.operators import bundle
from framequery.operators.written import written
from framequery.sources.frames import edges, grid, poses, sql

from .joins import _FLOW, CAM, FLOW_VIEWS
from .catalog import query

_RES = "res AS (SELECT i, j, r, c, c + 0.3 + 0.05 * (j - i) - u AS ru, r - 0.2 * (j - i) - w AS rv, 0.2 + 0.03 * (r + c) AS weight FROM flow WHERE seen)"


def _residuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Residuals of the keyframe graph against targets that drift with the distance of keyframes."""
    p = poses(spark, sf_dir).where(F.col("frame_idx") % 5 == 0)
    named = lambda k: p.select(F.floor(F.col("frame_idx") / 5).cast("long").alias(k), *[c.alias(f"{k}_{n}") for n, c in g.pose().named().items()])
    rel = edges(spark, sf_dir).join(named("i"), "i").join(named("j"), "j")
    rel = rel.select("i", "j", *[c.alias(f"r_{n}") for n, c in g.compose(g.inverse(g.pose("j_")), g.pose("i_")).named().items()])
    px = grid(spark, sf_dir).where(F.col("frame_idx") % 5 == 0).select(F.floor(F.col("frame_idx") / 5).cast("long").alias("i"), "r", "c", "disp")
    apart = F.col("j") - F.col("i")
    targets = px.select("i", "r", "c").join(edges(spark, sf_dir), "i").select("i", "j", "r", "c", (F.col("c") + 0.3 + 0.05 * apart).alias("tu"), (F.col("r") - 0.2 * apart).alias("tv"), (0.2 + 0.03 * (F.col("r") + F.col("c"))).alias("weight"))
    return bundle.residuals(px, rel, targets, CAM)


def _r4(c: str):
    return (F.round(c, 4) + F.lit(0.0)).alias(c)


@query(sql(FLOW_VIEWS, "SELECT i, j, r, c, round(ru, 4) + 0.0 AS ru, round(rv, 4) + 0.0 AS rv FROM res", *_FLOW, _RES))
def ba_residual(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _residuals(spark, sf_dir).select("i", "j", "r", "c", _r4("ru"), _r4("rv"))


@query(sql(FLOW_VIEWS, "SELECT i, j, round(sum(weight * (ru * ru + rv * rv)), 4) + 0.0 AS energy, count(*) AS n FROM res GROUP BY ALL", *_FLOW, _RES))
def ba_energy(spark: SparkSession, sf_dir: str) -> DataFrame:
    res = _residuals(spark, sf_dir)
    e = F.sum(F.col("weight") * (F.col("ru") * F.col("ru") + F.col("rv") * F.col("rv"))).alias("energy")
    return res.groupBy("i", "j").agg(e, F.count(F.lit(1)).alias("n")).select("i", "j", _r4("energy"), "n")


def _normal_sql() -> str:
    """Grouped sums of the products of both poses' Jacobians, from the relative poses' matrices."""
    rel = ", ".join(f"b.m0{k} * a.m0{m} + b.m1{k} * a.m1{m} + b.m2{k} * a.m2{m} AS r{k}{m}" for k in range(3) for m in range(3))
    shift = ", ".join(f"b.m0{k} * (a.tx - b.tx) + b.m1{k} * (a.ty - b.ty) + b.m2{k} * (a.tz - b.tz) AS s{k}" for k in range(3))
    u = ["8 * disp / z", "0", "-8 * x * disp / (z * z)", "-8 * x * y / (z * z)", "8 * (1 + x * x / (z * z))", "-8 * y / z"]
    v = ["0", "8 * disp / z", "-8 * y * disp / (z * z)", "-8 * (1 + y * y / (z * z))", "8 * x * y / (z * z)", "8 * x / z"]
    a_cols = ", ".join(f"{e} AS a{n}{k}" for n, row in (("u", u), ("v", v)) for k, e in enumerate(row))
    turn = lambda n: [f"a{n}3 + a{n}1 * s2 - a{n}2 * s1", f"a{n}4 + a{n}2 * s0 - a{n}0 * s2", f"a{n}5 + a{n}0 * s1 - a{n}1 * s0"]
    back = lambda v, m: "-(" + " + ".join(f"r{k}{m} * ({v[k]})" for k in range(3)) + ")"
    b_cols = ", ".join(f"{back([f'a{n}0', f'a{n}1', f'a{n}2'] if k < 3 else turn(n), k % 3)} AS b{n}{k}" for n in "uv" for k in range(6))
    both = lambda x, y: " UNION ALL ".join(f"SELECT {p} AS p, {q} AS q, " + ", ".join(f"weight * ({x}u{m if not t else n} * {y}u{n if not t else m} + {x}v{m if not t else n} * {y}v{n if not t else m}) AS h{m}{n}" for m in range(6) for n in range(6)) + f" FROM jac{w}" for p, q, w, t in ((("i", "i", "", 0),) if x == y == "b" else (("j", "j", "", 0),) if x == y else (("i", "j", " WHERE i < j", 0), ("j", "i", " WHERE i > j", 1))))
    views = [
        f"rel AS (SELECT e.i, e.j, {rel}, {shift} FROM edges e JOIN rot a ON a.frame_idx = 5 * e.i JOIN rot b ON b.frame_idx = 5 * e.j)",
        f"one AS (SELECT cam.*, rel.* EXCLUDE (i, j), 0.2 + 0.03 * (r + c) AS weight, {a_cols} FROM cam JOIN rel USING (i, j) WHERE z > 0.1)",
        f"jac AS (SELECT *, {b_cols} FROM one)",
        f"parts AS ({both('b', 'b')} UNION ALL {both('a', 'a')} UNION ALL {both('b', 'a')})",
    ]
    sums = ", ".join(f"round(sum(h{m}{n}), 3) + 0.0 AS h{m}{n}" for m in range(6) for n in range(6))
    return sql(FLOW_VIEWS, f"SELECT p, q, {sums} FROM parts GROUP BY p, q", *_FLOW, *views)


@query(_normal_sql())
def ba_normal_eq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pose blocks (p <= q) of the normal equations, of both poses of every edge."""
    blocks, _ = bundle.normal_equations(_residuals(spark, sf_dir))
    return blocks.select("p", "q", *[(F.round(c, 3) + F.lit(0.0)).alias(c) for c in blocks.columns[2:]])


@query()
def ba_schur(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pose blocks after the disparities are eliminated; tests hold them against a dense solution."""
    px = grid(spark, sf_dir).where(F.col("frame_idx") % 5 == 0).select(F.floor(F.col("frame_idx") / 5).cast("long").alias("i"), "r", "c", "disp")
    res = written(_residuals(spark, sf_dir), "residuals")
    s, _ = bundle.eliminated(*bundle.normal_equations(res), bundle.depth_system(res, px))
    return s.select("p", "q", *[_r4(c) for c in s.columns[2:]])


@query(sql("grid", "SELECT frame_idx, r, c, round(greatest(0.001, disp + CASE WHEN abs(step) > 10 THEN 0 ELSE step END), 6) + 0.0 AS disp FROM (SELECT frame_idx, r, c, disp, 40 * v AS step FROM grid)"))
def retract_disp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid(spark, sf_dir).select("frame_idx", "r", "c", g.r6(bundle.retracted_disparity(F.col("disp"), 40 * F.col("v"))).alias("disp"))


@query()
def retract_pose(spark: SparkSession, sf_dir: str) -> DataFrame:
    """exp(step) applied to each pose."""
    step = [0.1 * F.col(c) for c in ("ty", "tz", "tx", "qz", "qx", "qy")]
    p = poses(spark, sf_dir).select("*", *[c.alias(f"x{k}") for k, c in enumerate(step)])
    x = [F.col(f"x{k}") for k in range(6)]
    moved = g.compose(g.se3_exp(tuple(x[:3]), tuple(x[3:])), g.pose())
    return p.select("frame_idx", *[g.r6(c).alias(n) for n, c in moved.named().items()])
