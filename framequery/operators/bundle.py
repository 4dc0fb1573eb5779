"""Dense bundle adjustment: grouped normal equations, disparities eliminated, a sparse pose system a graph.

Poses are world to camera. A residual is the flow target less the reprojection of a pixel of
keyframe i into keyframe j; its Jacobians with regard to both poses and to the disparity are
columns, so the normal equations are grouped sums. A pixel's disparity bears on the poses of
its own edges alone, as many as the graph's degree; eliminating it adds their products to the
pose blocks. What is left has six unknowns a keyframe and is solved by nested elimination.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framequery.functions import geometry as g

from . import elimination, rig_bundle
from .written import written

DIM = 6
_SIDES = {"i": "b", "j": "a"}
_ENTRIES = [(p, q) for p in range(DIM) for q in range(DIM)]


def residuals(pixels: DataFrame, rel: DataFrame, targets: DataFrame, cam: g.Camera) -> DataFrame:
    """(i, j, r, c, ru, rv, weight and Jacobian columns) of every edge pixel in view.

    ``pixels`` has (i, r, c, disp), ``rel`` the pose r_tx..r_qw from i to j of each edge, and
    ``targets`` (i, j, r, c, tu, tv, weight). Jacobian columns are a<axis><k> for a twist of
    keyframe j's pose (translation, then rotation), b<axis><k> for one of keyframe i's, and
    d<axis> for disparity.
    """
    m = g.pose("r_")
    ray = cam.ray(F.col("c").cast("double"), F.col("r").cast("double"))
    moved = g.add(g.rotate(m.q, ray), g.scale(m.t, F.col("disp")))
    met = targets.join(pixels, ["i", "r", "c"]).join(rel, ["i", "j"])
    at = met.select("i", "j", "r", "c", "disp", "tu", "tv", "weight", *[f"r_{n}" for n in g.Pose._fields], *[v.alias(n) for n, v in zip(("x", "y", "z"), moved, strict=True)]).where(F.col("z") > g.NEAR)
    x, y, z, d = (F.col(c) for c in ("x", "y", "z", "disp"))
    u, v, _ = cam.project((x, y, z))
    # a homogeneous point moves with the disparity times the translation and with the rotation's cross product
    j_u = [cam.fx * d / z, F.lit(0.0), -cam.fx * x * d / (z * z), -cam.fx * x * y / (z * z), cam.fx * (1 + x * x / (z * z)), -cam.fx * y / z]
    j_v = [F.lit(0.0), cam.fy * d / z, -cam.fy * y * d / (z * z), -cam.fy * (1 + y * y / (z * z)), cam.fy * x * y / (z * z), cam.fy * x / z]
    d_u = cam.fx * (F.col("r_tx") / z - x * F.col("r_tz") / (z * z))
    d_v = cam.fy * (F.col("r_ty") / z - y * F.col("r_tz") / (z * z))
    columns = {"ru": F.col("tu") - u, "rv": F.col("tv") - v, "du": d_u, "dv": d_v}
    back = (-m.qx, -m.qy, -m.qz, m.qw)
    for axis, row in (("u", j_u), ("v", j_v)):
        # a twist of i before the relative pose is minus its adjoint's twist after it
        shift, turn = tuple(row[:3]), tuple(row[3:])
        of_i = [*g.rotate(back, shift), *g.rotate(back, g.add(turn, g.cross(shift, m.t)))]
        columns |= {f"a{axis}{k}": c for k, c in enumerate(row)} | {f"b{axis}{k}": -c for k, c in enumerate(of_i)}
    return at.select("i", "j", "r", "c", "weight", *[c.alias(n) for n, c in columns.items()])


def _weighed(a: str, b: str) -> Column:
    """Sum over both axes of the weighted product of two column families."""
    return F.col("weight") * (F.col(a.format("u")) * F.col(b.format("u")) + F.col(a.format("v")) * F.col(b.format("v")))


def _block(x: str, y: str) -> list[Column]:
    return [F.sum(_weighed(f"{x}{{}}{p}", f"{y}{{}}{q}")).alias(f"{x}{y}{p}{q}") for p, q in _ENTRIES]


def normal_equations(res: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(p, q, h00..h55) for p <= q and (p, g0..g5): the blocks of both poses of every edge, and the right-hand side.

    Residuals are summed by edge first, so that only one narrow row an edge is dealt to its
    blocks.
    """
    rhs = [F.sum(_weighed(f"{x}{{}}{p}", "r{}")).alias(f"{x}r{p}") for x in "ab" for p in range(DIM)]
    e = res.groupBy("i", "j").agg(*_block("b", "b"), *_block("b", "a"), *_block("a", "a"), *rhs)
    named = lambda x, turned=False: [F.col(f"{x}{q if turned else p}{p if turned else q}").alias(f"h{p}{q}") for p, q in _ENTRIES]
    parts = [e.select(F.col(k).alias("p"), F.col(k).alias("q"), *named(2 * x)) for k, x in _SIDES.items()]
    parts += [e.where("i < j").select(F.col("i").alias("p"), F.col("j").alias("q"), *named("ba")), e.where("i > j").select(F.col("j").alias("p"), F.col("i").alias("q"), *named("ba", True))]
    blocks = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    blocks = blocks.groupBy("p", "q").agg(*[F.sum(f"h{p}{q}").alias(f"h{p}{q}") for p, q in _ENTRIES])
    sides = [e.select(F.col(k).alias("p"), *[F.col(f"{x}r{n}").alias(f"g{n}") for n in range(DIM)]) for k, x in _SIDES.items()]
    return blocks, sides[0].unionByName(sides[1]).groupBy("p").agg(*[F.sum(f"g{n}").alias(f"g{n}") for n in range(DIM)])


def depth_system(res: DataFrame, pixels: DataFrame, damping: float = 0.0, ep: float = 1e-3, sensed: DataFrame | None = None, alpha: float = 0.0) -> DataFrame:
    """(i, r, c, cinv, w, bears): each disparity's damped inverse diagonal, right-hand side, and (p, e) of the poses it bears on.

    The diagonal is raised by ``damping`` of itself and ``ep``. ``sensed`` (i, r, c, sens)
    draws the disparities it has towards its own with weight ``alpha``.
    """
    e = lambda x: F.array(*[_weighed(f"{x}{{}}{p}", "d{}") for p in range(DIM)])
    one = res.select("i", "j", "r", "c", _weighed("d{}", "d{}").alias("cc"), _weighed("d{}", "r{}").alias("w"), e("a").alias("ea"), *[_weighed(f"b{{}}{p}", "d{}").alias(f"eb{p}") for p in range(DIM)])
    own = F.array(*[F.sum(f"eb{p}") for p in range(DIM)])
    far = F.collect_list(F.struct(F.col("j").alias("p"), F.col("ea").alias("e")))
    by = one.groupBy("i", "r", "c").agg(F.sum("cc").alias("cc"), F.sum("w").alias("w"), own.alias("own"), far.alias("far"))
    if sensed is not None:
        drawn = pixels.join(sensed, ["i", "r", "c"]).select("i", "r", "c", (alpha * (F.col("sens") - F.col("disp"))).alias("more"))
        by = by.join(drawn, ["i", "r", "c"], "left").withColumn("cc", F.col("cc") + F.when(F.col("more").isNull(), 0.0).otherwise(alpha)).withColumn("w", F.col("w") + F.coalesce("more", F.lit(0.0)))
    bears = F.concat(F.array(F.struct(F.col("i").alias("p"), F.col("own").alias("e"))), "far")
    return by.select("i", "r", "c", (1 / (F.col("cc") * (1 + damping) + ep)).alias("cinv"), "w", bears.alias("bears"))


def eliminated(blocks: DataFrame, rhs: DataFrame, depths: DataFrame, damping: float = 0.0, ep: float = 1e-2) -> tuple[DataFrame, DataFrame]:
    """The Schur complement: damped pose blocks and right-hand side without the disparities' part."""
    pairs = depths.select("cinv", F.explode("bears").alias("x"), "bears").select("cinv", "x", F.explode("bears").alias("y")).where("x.p <= y.p")
    less = pairs.groupBy(F.col("x.p").alias("p"), F.col("y.p").alias("q")).agg(*[F.sum(-F.col("x.e")[p] * F.col("y.e")[q] * F.col("cinv")).alias(f"h{p}{q}") for p, q in _ENTRIES])
    damped = blocks.select("p", "q", *[(F.col(f"h{a}{b}") * F.when(F.col("p") == F.col("q"), 1 + damping).otherwise(1.0) + F.when(F.col("p") == F.col("q"), ep).otherwise(0.0) if a == b else F.col(f"h{a}{b}")).alias(f"h{a}{b}") for a, b in _ENTRIES])
    s = damped.unionByName(less).groupBy("p", "q").agg(*[F.sum(f"h{p}{q}").alias(f"h{p}{q}") for p, q in _ENTRIES])
    part = depths.select("cinv", "w", F.explode("bears").alias("x")).groupBy(F.col("x.p").alias("p")).agg(*[F.sum(-F.col("x.e")[n] * F.col("cinv") * F.col("w")).alias(f"g{n}") for n in range(DIM)])
    return s, rhs.unionByName(part).groupBy("p").agg(*[F.sum(f"g{n}").alias(f"g{n}") for n in range(DIM)])


def pose_steps(s: DataFrame, rhs: DataFrame, graph: Callable[[Column], Column], fixed: Callable[[Column], Column]) -> DataFrame:
    """(p, x0..x5): the solution of each graph's system; poses for which ``fixed`` holds stay out.

    ``graph`` gives the graph of a keyframe; blocks across graphs are left out.
    """
    both = s.where(~fixed(F.col("p")) & ~fixed(F.col("q")) & (graph(F.col("p")) == graph(F.col("q"))))
    blocks = both.select(graph(F.col("p")).cast("long").alias("graph"), "p", "q", *elimination.H)
    sides = rhs.where(~fixed(F.col("p"))).select(graph(F.col("p")).cast("long").alias("graph"), "p", *elimination.G)
    return elimination.solve(blocks, sides).drop("graph")


def depth_steps(depths: DataFrame, steps: DataFrame) -> DataFrame:
    """(i, r, c, step): the disparities' steps once the poses' are known; poses without one stay."""
    x = steps.select("p", F.array(*[f"x{n}" for n in range(DIM)]).alias("x"))
    met = depths.select("i", "r", "c", F.explode("bears").alias("b")).select("i", "r", "c", "b.p", "b.e").join(x, "p")
    dot = sum((F.col("e")[n] * F.col("x")[n] for n in range(DIM)), F.lit(0.0))
    taken = met.groupBy("i", "r", "c").agg(F.sum(dot).alias("taken"))
    return depths.join(taken, ["i", "r", "c"], "left").select("i", "r", "c", (F.col("cinv") * (F.col("w") - F.coalesce("taken", F.lit(0.0)))).alias("step"))


def relative(cams: DataFrame, edges: DataFrame) -> DataFrame:
    """(i, j, r_tx..r_qw): the pose from keyframe i to j of every edge, of world-to-camera poses (k, tx..qw)."""
    named = lambda k: cams.select(F.col("k").alias(k), *[F.col(m).alias(f"{k}_{m}") for m in g.Pose._fields])
    rel = g.compose(g.pose("j_"), g.inverse(g.pose("i_")))
    return edges.join(named("i"), "i").join(named("j"), "j").select("i", "j", *[c.alias(f"r_{m}") for m, c in rel.named().items()])


def adjusted(cams: DataFrame, pixels: DataFrame, edges: DataFrame, targets: DataFrame, cam: g.Camera, graph: Callable[[Column], Column], fixed: Callable[[Column], Column], pose_damping: tuple[float, float] = (1e-4, 0.1), depth_damping: tuple[float, float] = (0.0, 1e-3), sensed: DataFrame | None = None, alpha: float = 0.0, share: float = 1.0) -> tuple[DataFrame, DataFrame]:
    """World-to-camera poses (k, tx..qw) and disparities (i, r, c, disp) after one damped Gauss-Newton step, ``share`` of it.

    The step is a rig's of one view that stays: bands of a keyframe's rows meet their edges as
    lists, and no row an edge and pixel is written. Edges are within graphs; a pixel that no
    edge sees follows its sensed disparity alone.
    """
    of = lambda c: graph(F.col(c)).cast("long").alias("graph")
    view = lambda n: F.lit(0).cast("long").alias(n)
    frames = cams.select(of("k"), "k", *g.Pose._fields, fixed(F.col("k")).alias("fixed"))
    graphs = written(frames.select("graph").distinct(), "graphs")
    rig = graphs.select("graph", view("v"), *[F.lit(float(m == "qw")).alias(m) for m in g.Pose._fields])
    lens = graphs.select("graph", view("v"), *[F.lit(float(getattr(cam, n))).alias(n) for n in ("fx", "fy", "cx", "cy")])
    px = pixels.join(sensed, ["i", "r", "c"], "left") if sensed is not None else pixels.withColumn("sens", F.lit(None).cast("double"))
    px = px.select(of("i"), "i", view("v"), "r", "c", "disp", F.lit(0.0).alias("eta"), "sens", F.lit(False).alias("held"))
    aims = targets.select(of("i"), "i", view("vi"), "j", view("vj"), "r", "c", "tu", "tv", F.col("weight").alias("wu"), F.col("weight").alias("wv"))
    pairs = edges.select(of("i"), "i", view("vi"), "j", view("vj"))
    s = rig_bundle.Settings(pose=pose_damping, depth=depth_damping[0], ep=depth_damping[1], alpha=alpha)
    made, steps = rig_bundle.solved(rig_bundle.Scene(frames, rig, lens, px), pairs, aims, s, graphs.withColumn("mu", F.lit(1.0)))
    moved = cams.join(steps.withColumnRenamed("p", "k"), "k", "left").select("k", *g.Pose._fields, *[(share * F.coalesce(f"x{n}", F.lit(0.0))).alias(f"x{n}") for n in range(DIM)])
    x = [F.col(f"x{n}") for n in range(DIM)]
    poses = moved.select("k", *[c.alias(m) for m, c in g.compose(g.se3_exp(tuple(x[:3]), tuple(x[3:])), g.pose()).named().items()])
    shifted = pixels.join(rig_bundle.disparity_steps(made, steps).select("i", "r", "c", "step"), ["i", "r", "c"], "left")
    new = shifted.select("i", "r", "c", retracted_disparity(F.col("disp"), share * F.coalesce("step", F.lit(0.0))).alias("disp"))
    return written(poses, "poses"), written(new, "disparities")


def retracted_disparity(disp: Column, step: Column, most: float = 10.0, least: float = 1e-3) -> Column:
    """A disparity after its step; steps beyond ``most`` are ignored and the result is kept positive."""
    return F.greatest(F.lit(least), disp + F.when(F.abs(step) > most, 0.0).otherwise(step))
