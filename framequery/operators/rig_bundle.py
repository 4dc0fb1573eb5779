"""Bundle adjustment of camera rigs: poses, rig rotations, shared focal lengths and disparities in one system.

A residual takes a pixel of view v in keyframe i to view w in keyframe j through
rig_w^-1 G_j G_i^-1 rig_v, with G from world to rig and rig from view to rig. Each band of a
keyframe's grid rows is linearised in one small task, which sums the blocks of the variables
its edges touch and eliminates the band's disparities by one matrix product. Poses keep their
keyframe's number as variable, what all keyframes share gets negative ones; the bordered
system that is left is solved by nested elimination. Residuals may be weighed by truncated
least squares whose shape each graph anneals by its own mu.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framequery.functions import geometry as g

from . import elimination
from .elimination import DIM, G, H, X
from .written import written

_POSE = g.Pose._fields
_EDGE = ["graph", "i", "vi", "j", "vj"]
_CAM = ("fx", "fy", "cx", "cy")
_NONE = -(1 << 62)
D = [f"d{n}" for n in range(DIM)]
_OUT = "graph long, i long, v long, kind int, p long, q long, energy double, " + ", ".join(f"{c} double" for c in [*H, *D]) + ", border array<long>, r array<long>, c array<long>, free binary, taken binary"
_ARROW = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "array<long>": pa.list_(pa.int64()), "binary": pa.binary()}
_KINDS = pa.schema([(n, _ARROW[kind]) for n, kind in (x.split() for x in _OUT.split(", "))])
_BLOCK, _SIDE, _FACTOR = 0, 1, 2


@dataclass(frozen=True)
class Settings:
    """Dampings are (share of the diagonal, plus a constant); ``factor`` is the image's size over the grid's.

    Where ``rig`` holds, rotations of all views but view 0 are adjusted; where ``focal`` holds,
    focal lengths are, of each view or one for all. A disparity's diagonal is raised by ``depth`` of
    itself and ``ep``. ``alpha`` draws sensed disparities.
    ``threshold`` of residuals turns the annealed weights on.
    """

    pose: tuple[float, float] = (1e-4, 0.1)
    turn: tuple[float, float] = (1e-4, 1e-4)
    lens: tuple[float, float] = (1e-6, 1e-6)
    ep: float = 1e-7
    depth: float = 0.0
    alpha: float = 0.0
    factor: float = 1.0
    rig: bool = False
    focal: bool = False
    one_focal: bool = True
    motion_only: bool = False
    threshold: float | None = None
    mu_step: float = 3.0
    mu_most: float = 1e6
    band: int = 8


@dataclass(frozen=True)
class Scene:
    """What is adjusted: frames (graph, k, tx..qw, fixed), rig (graph, v, tx..qw), cams (graph, v, fx, fy, cx, cy) and pixels.

    pixels has (graph, i, v, r, c, disp, eta, sens, held): eta is added to the disparity's
    diagonal, sens is a sensed disparity or null, and a held one isn't adjusted. with_tracks()
    adds points off the grid.
    """

    frames: DataFrame
    rig: DataFrame
    cams: DataFrame
    pixels: DataFrame


def _track_place(track: Column) -> list[Column]:
    """The row, below 0, and column under which a track goes: 512 tracks a row."""
    return [(-1 - F.floor(track / 512)).cast("long").alias("r"), track.cast("long").alias("c")]


def _placed(pixels: DataFrame, s: Settings) -> DataFrame:
    """Pixels with the point x, y that each is and the image's size over that of its coordinates."""
    if "x" in pixels.columns:
        return pixels.withColumns({"x": F.coalesce("x", F.col("c").cast("double")), "y": F.coalesce("y", F.col("r").cast("double")), "factor": F.coalesce("factor", F.lit(s.factor))})
    return pixels.withColumns({"x": F.col("c").cast("double"), "y": F.col("r").cast("double"), "factor": F.lit(s.factor)})


def with_tracks(scene: Scene, targets: DataFrame, tracks: DataFrame, seen: DataFrame) -> tuple[Scene, DataFrame]:
    """The scene and targets with tracked points beside the pixels, each with a disparity of its own.

    ``tracks`` has (graph, i, v, track, x, y, disp, eta): where a point lies in the image of the keyframe and view that it
    starts from, in full size. ``seen`` has (graph, i, vi, j, vj, track, tu, tv, wu, wv), also in full size: one row for each
    view that sees it, of which a track may have any number. A track's disparity is eliminated with those
    of its band and kept from 0.001 to 10. Edges that only tracks use belong among the edges too.
    """
    add = tracks.select("graph", "i", "v", *_track_place(F.col("track")), "disp", "eta", F.lit(None).cast("double").alias("sens"), F.lit(False).alias("held"), "x", "y", F.lit(1.0).alias("factor"))
    pixels = scene.pixels.unionByName(add, allowMissingColumns=True)
    more = seen.select("graph", "i", "vi", "j", "vj", *_track_place(F.col("track")), "tu", "tv", "wu", "wv")
    return Scene(scene.frames, scene.rig, scene.cams, pixels), targets.unionByName(more)


def _edges(scene: Scene, edges: DataFrame, mu: DataFrame) -> DataFrame:
    """Each edge with the whole way t_, the way g_ between keyframes, the way n_ into the far view, both cameras and mu."""
    frame = lambda k: scene.frames.select("graph", F.col("k").alias(k), F.col("fixed").alias(f"{k}_fixed"), *[F.col(m).alias(f"{k}_{m}") for m in _POSE])
    view = lambda v: scene.rig.select("graph", F.col("v").alias(v), *[F.col(m).alias(f"{v}_{m}") for m in _POSE]).join(scene.cams.select("graph", F.col("v").alias(v), *[F.col(m).alias(f"{v}_{m}") for m in _CAM]), ["graph", v])
    met = edges.join(frame("i"), ["graph", "i"]).join(frame("j"), ["graph", "j"]).join(view("vi"), ["graph", "vi"]).join(view("vj"), ["graph", "vj"]).join(mu, "graph")
    between = g.compose(g.pose("j_"), g.inverse(g.pose("i_")))
    met = met.select(*_EDGE, "i_fixed", "j_fixed", "mu", *[F.col(f"{v}_{m}") for v in ("vi", "vj") for m in _CAM], *[F.col(f"vi_{m}") for m in _POSE], *[c.alias(n) for way in (g.inverse(g.pose("vj_")).named("n_"), between.named("g_")) for n, c in way.items()])
    whole = g.compose(g.compose(g.pose("n_"), g.pose("g_")), g.pose("vi_"))
    return met.select(*_EDGE, "i_fixed", "j_fixed", "mu", *[f"{v}_{m}" for v in ("vi", "vj") for m in _CAM], *[f"{p}_{m}" for p in "ng" for m in _POSE], *[c.alias(n) for n, c in whole.named("t_").items()])


def _rotated(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    c = 2 * np.cross(q[..., :3], x)
    return x + q[..., 3:] * c + np.cross(q[..., :3], c)


def _carried(rows: np.ndarray, pose: np.ndarray) -> np.ndarray:
    """Row Jacobians (n, 2, 6) by a twist after a pose, as ones by a twist before it."""
    back = (pose[:, 3:] * [-1, -1, -1, 1])[:, None, :]
    tau, phi = rows[..., :3], rows[..., 3:]
    return np.concatenate([_rotated(back, tau), _rotated(back, phi + np.cross(tau, pose[:, None, :3]))], 2)


def truncated(r2: np.ndarray, c: float, mu: np.ndarray, most: float) -> np.ndarray:
    """Weights of graduated truncated least squares; at the greatest mu plain truncation."""
    low, high = mu / (mu + 1) * c * c, (mu + 1) / mu * c * c
    between = np.maximum(np.sqrt(c * c * mu * (mu + 1) / np.maximum(r2, 1e-12)) - mu, 0)
    soft = np.where(r2 < low, 1.0, np.where(r2 <= high, between, 0.0))
    return np.where(mu >= most, (r2 < c * c).astype(float), soft)


def _linearised(t: pd.DataFrame, s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Residuals to the targets (n, 2), weights (n, 2), and Jacobians by disparity (n, 2) and by the six slots (n, 2, 6, 6)."""
    part = lambda p: t[[f"{p}_{m}" for m in _POSE]].to_numpy()
    factor = t["factor"].to_numpy()
    cam = lambda v: (t[[f"{v}_{m}" for m in _CAM]].to_numpy() / factor[:, None]).T
    (fx, fy, cx, cy), (gx, gy, dx, dy) = cam("vi"), cam("vj")
    way, disp = part("t"), t["disp"].to_numpy()
    x0, y0 = (t["x"].to_numpy() - cx) / fx, (t["y"].to_numpy() - cy) / fy
    at = _rotated(way[:, 3:], np.stack([x0, y0, np.ones_like(x0)], 1)) + way[:, :3] * disp[:, None]
    seen = at[:, 2] > g.NEAR
    x, y, z = at[:, 0], at[:, 1], np.where(seen, at[:, 2], 1.0)
    nought = np.zeros_like(x)
    by_point = np.stack([np.stack([gx / z, nought, -gx * x / (z * z)], 1), np.stack([nought, gy / z, -gy * y / (z * z)], 1)], 1)
    turning = np.stack([np.cross(at, row) for row in (by_point[:, 0], by_point[:, 1])], 1)
    by_whole = np.concatenate([by_point * disp[:, None, None], turning], 2)
    of_j = _carried(by_whole, part("n"))
    of_i = -_carried(of_j, part("g"))
    lens = np.zeros((2, len(t), 2, DIM))
    widened = _rotated(way[:, 3:], np.stack([-x0 / fx, -y0 / fy, nought], 1))
    lens[0, :, :, 0] = np.einsum("nak,nk->na", by_point, widened) / factor[:, None]
    lens[1, :, :, 0] = np.stack([x / z, y / z], 1) / factor[:, None]
    r = t[["tu", "tv"]].to_numpy() - np.stack([gx * x / z + dx, gy * y / z + dy], 1)
    w = t[["wu", "wv"]].to_numpy() * seen[:, None]
    if s.threshold is not None:
        w = w * truncated(r * r, s.threshold, t["mu"].to_numpy()[:, None], s.mu_most)
    return r, w, np.einsum("nak,nk->na", by_point, way[:, :3]), np.stack([of_i, of_j, -of_i, -of_j, lens[0], lens[1]], 2)


def _variables(t: pd.DataFrame, s: Settings) -> np.ndarray:
    """The variable in each slot of each row; those that aren't adjusted are _NONE."""
    out = np.full((len(t), 6), _NONE, np.int64)
    for slot, k in enumerate("ij"):
        out[:, slot] = np.where(t[f"{k}_fixed"], _NONE, t[k])
        view = t[f"v{k}"].to_numpy()
        if s.rig:
            out[:, 2 + slot] = np.where(view == 0, _NONE, -1 - 2 * view)
        if s.focal:
            out[:, 4 + slot] = -2 - 2 * (0 * view if s.one_focal else view)
    return out


def _band(t: pd.DataFrame, lin: tuple[np.ndarray, ...], variables: np.ndarray, s: Settings) -> tuple[list[tuple], np.ndarray, dict]:
    """A band of grid rows, its disparities eliminated: (kind, p, q) and numbers of each sum, and how the disparities follow."""
    r, w, by_disp, slots = lin
    border = [int(v) for v in np.unique(variables) if v != _NONE]
    m = len(border) + 1  # the last takes what isn't adjusted
    at = np.where(variables == _NONE, m - 1, np.searchsorted(border, variables)) if border else np.zeros_like(variables)
    places, first, number = np.unique(t["r"].to_numpy() << 31 | t["c"].to_numpy(), return_index=True, return_inverse=True)
    a, b, e = np.zeros((m, m, DIM, DIM)), np.zeros((m, DIM)), np.zeros((len(places), m, DIM))
    far = t["edge"].to_numpy()
    order = np.argsort(far, kind="stable")
    for rows in np.split(order, np.flatnonzero(np.diff(far[order])) + 1):
        own = at[rows[0]]
        j = slots[rows].reshape(len(rows) * 2, 6 * DIM)
        wj = j * w[rows].reshape(-1, 1)
        np.add.at(a, (own[:, None], own[None, :]), (j.T @ wj).reshape(6, DIM, 6, DIM).transpose(0, 2, 1, 3))
        np.add.at(b, own, (wj.T @ r[rows].ravel()).reshape(6, DIM))
        shared = np.einsum("na,nask->nsk", w[rows] * by_disp[rows], slots[rows])
        if not s.motion_only:
            np.add.at(e, (number[rows][:, None], own[None, :]), shared)
    a, b, e = a[:-1, :-1], b[:-1], e[:, :-1]
    m -= 1
    diagonal = np.einsum("ppkk->pk", a).copy()
    flat = e.reshape(len(places), -1)
    inverse = v = np.zeros(len(places))
    if not s.motion_only:
        sens, disp = t["sens"].to_numpy(float)[first], t["disp"].to_numpy()[first]
        drawn = np.where(np.isnan(sens), 0.0, s.alpha)
        c = np.bincount(number, (w * by_disp * by_disp).sum(1))
        c = (c + drawn) * (1 + s.depth) + t["eta"].to_numpy()[first] + s.ep
        v = np.bincount(number, (w * by_disp * r).sum(1)) + drawn * np.where(np.isnan(sens), 0.0, sens - disp)
        inverse = np.where(~t["held"].to_numpy(bool)[first], 1 / c, 0.0)
        a = a - (flat.T @ (flat * inverse[:, None])).reshape(m, DIM, m, DIM).transpose(0, 2, 1, 3)
        b = b - (flat.T @ (inverse * v)).reshape(m, DIM)
    p, q = np.triu_indices(m)
    some = (p == q) | a[p, q].any((1, 2))
    p, q = p[some], q[some]
    names = [(_BLOCK, border[x], border[y]) for x, y in zip(p, q, strict=True)] + [(_SIDE, x, x) for x in border] + [(_FACTOR, 0, 0)]
    numbers = np.zeros((len(names), DIM * DIM + DIM))
    numbers[: len(p), : DIM * DIM] = a[p, q].reshape(-1, DIM * DIM)
    numbers[: len(p), DIM * DIM :][p == q] = diagonal
    numbers[len(p) : len(p) + m, :DIM] = b
    last = {"energy": float((w * r * r).sum())}
    if not s.motion_only:
        last |= {"border": border, "r": places >> 31, "c": places & ((1 << 31) - 1), "free": (inverse * v).tobytes(), "taken": (flat * inverse[:, None]).tobytes()}
    return names, numbers, last


def _listed(column: pa.Array) -> pd.DataFrame:
    """The structs in a column of lists, with the row that each is from."""
    flat = column.flatten()
    fields = {f.name: x.to_numpy(zero_copy_only=False) for f, x in zip(flat.type, flat.flatten(), strict=True)}
    return pd.DataFrame(fields).assign(owner=np.repeat(np.arange(len(column)), np.diff(column.offsets.to_numpy())))


def _bands(b: pa.RecordBatch, s: Settings) -> pd.DataFrame | None:
    """_band() of each row of (graph, i, vi, targets, pixels, edges); all rows are linearised together."""
    targets, pixels, edges = (_listed(b.column(k)) for k in (3, 4, 5))
    edges["edge"] = np.arange(len(edges))
    t = targets.merge(edges, on=["owner", "j", "vj"]).merge(pixels, on=["owner", "r", "c"]).sort_values("owner", kind="stable", ignore_index=True)
    if not len(t):
        return None
    graph, i, view = (b.column(k).to_numpy() for k in range(3))
    owner = t["owner"].to_numpy()
    t["i"], t["vi"] = i[owner], view[owner]
    lin, variables = _linearised(t, s), _variables(t, s)
    cuts = np.append(0, np.append(np.flatnonzero(np.diff(owner)) + 1, len(t)))
    heads, names, numbers, lasts = [], [], [], {}
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        own, x, last = _band(t.iloc[lo:hi], tuple(y[lo:hi] for y in lin), variables[lo:hi], s)
        heads += [owner[lo]] * len(own)
        names += own
        numbers.append(x)
        lasts[len(names) - 1] = last
    heads, names = np.array(heads), np.array(names)
    done = {"graph": graph[heads], "i": i[heads], "v": view[heads], "kind": names[:, 0], "p": names[:, 1], "q": names[:, 2]}
    energy = np.zeros(len(names))
    for k, last in lasts.items():
        energy[k] = last["energy"]
    done |= {"energy": energy} | dict(zip([*H, *D], np.concatenate(numbers).T, strict=True))
    return pd.DataFrame(done | {c: pd.Series([lasts[k].get(c) if k in lasts else None for k in range(len(names))], dtype=object) for c in ("border", "r", "c", "free", "taken")})


def _made(b: pa.RecordBatch, s: Settings) -> Iterator[pd.DataFrame]:
    """_bands() of slices with about 1 << 14 targets each, a larger band alone."""
    upto, lo = b.column(3).offsets.to_numpy(), 0
    while lo < b.num_rows:
        hi = max(lo + 1, int(np.searchsorted(upto, upto[lo] + (1 << 14), side="right")) - 1)
        found = _bands(b.slice(lo, hi - lo), s)
        if found is not None:
            yield found
        lo = hi


def _disparity_steps(factors: DataFrame, x: DataFrame) -> DataFrame:
    """(graph, i, v, r, c, step) of the disparities, from the other variables' steps."""
    keyed = factors.withColumn("band", F.monotonically_increasing_id())
    keyed = written(keyed, "bands")
    wanted = keyed.select("band", "graph", F.posexplode("border").alias("n", "p")).join(x, ["graph", "p"])
    met = wanted.groupBy("band").agg(F.sort_array(F.collect_list(F.struct("n", F.array(*X).alias("x")))).alias("met"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            made = []
            for t in b.to_dict("records"):
                step = np.frombuffer(t["free"])
                if t["met"] is not None and len(t["met"]):
                    step = step - np.frombuffer(t["taken"]).reshape(len(step), -1) @ np.concatenate([np.asarray(k["x"], float) for k in t["met"]])
                made.append((np.full(len(step), t["graph"]), np.full(len(step), t["i"]), np.full(len(step), t["v"]), np.asarray(t["r"]), np.asarray(t["c"]), step))
            if made:
                yield pd.DataFrame(dict(zip(("graph", "i", "v", "r", "c", "step"), map(np.concatenate, zip(*made, strict=True)), strict=True)))

    joined = keyed.join(met, "band", "left").select("graph", "i", "v", "r", "c", "free", "taken", "met")
    return joined.mapInPandas(run, "graph long, i long, v long, r long, c long, step double")


def _damped(blocks: DataFrame, s: Settings) -> DataFrame:
    kind = lambda n: F.when(F.col("p") >= 0, s.pose[n]).when(F.pmod(F.col("p"), F.lit(2)) == 1, s.turn[n]).otherwise(s.lens[n])
    more = lambda n: F.when(F.col("p") == F.col("q"), F.col(D[n]) * kind(0) + kind(1)).otherwise(0.0)
    return blocks.select("graph", "p", "q", *[(F.col(f"h{p}{q}") + (more(p) if p == q else 0.0)).alias(f"h{p}{q}") for p, q in elimination.ENTRIES])


def _stepped(rows: DataFrame, steps: DataFrame, key: str, number: Column, keep: list[str], turn_only: bool) -> DataFrame:
    """Poses moved by the step of the variable that each has; those without one stay."""
    x = steps.select(F.col("graph").alias("__g"), F.col("p").alias("__p"), *X)
    met = rows.join(x, (F.col("graph") == F.col("__g")) & (number == F.col("__p")), "left")
    step = [F.coalesce(F.col(n), F.lit(0.0)) for n in X]
    if turn_only:
        step[:3] = [F.lit(0.0)] * 3
    met = met.select("graph", key, *keep, *_POSE, *[c.alias(n) for n, c in zip(X, step, strict=True)])
    moved = g.compose(g.se3_exp(tuple(F.col(n) for n in X[:3]), tuple(F.col(n) for n in X[3:])), g.pose())
    return met.select("graph", key, *keep, *[c.alias(n) for n, c in moved.named().items()])


def solved(scene: Scene, edges: DataFrame, targets: DataFrame, s: Settings, mu: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The written bands' sums and (graph, p, x0..x5), the step of every variable but the disparities; of the same tables as adjusted()."""
    mu = edges.select("graph").distinct().withColumn("mu", F.lit(1.0)) if mu is None else mu
    px = _placed(scene.pixels, s).withColumnRenamed("v", "vi")
    # each side goes to a band as one list: a wide row a target and edge would be shuffled many times over
    band, key = F.floor(F.col("r") / s.band).alias("band"), ["graph", "i", "vi"]
    aims = targets.groupBy(*key, band).agg(F.collect_list(F.struct("j", "vj", "r", "c", *[F.col(x).cast("double").alias(x) for x in ("tu", "tv", "wu", "wv")])).alias("targets"))
    own = px.groupBy(*key, band).agg(F.collect_list(F.struct("r", "c", *[F.col(x).cast("double").alias(x) for x in ("x", "y", "factor", "disp", "eta", "sens")], "held")).alias("pixels"))
    ways = _edges(scene, edges, mu)
    ways = ways.groupBy(*key).agg(F.collect_list(F.struct(*[x for x in ways.columns if x not in key])).alias("edges"))
    met = aims.join(own, [*key, "band"]).join(ways, key).select(*key, "targets", "pixels", "edges")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for found in _made(b, s):
                yield pa.RecordBatch.from_pandas(found, _KINDS, preserve_index=False)

    made = written(met.mapInArrow(run, _OUT), "bands")
    blocks = made.where(F.col("kind") == _BLOCK).groupBy("graph", "p", "q").agg(*[F.sum(c).alias(c) for c in [*H, *D]])
    sides = made.where(F.col("kind") == _SIDE).groupBy("graph", "p").agg(*[F.sum(H[n]).alias(G[n]) for n in range(DIM)])
    return made, written(elimination.solve(_damped(blocks, s), sides), "steps")


def disparity_steps(made: DataFrame, steps: DataFrame) -> DataFrame:
    """(graph, i, v, r, c, step) of the disparities, once solved() has found the others' steps."""
    return _disparity_steps(made.where(F.col("kind") == _FACTOR).select("graph", "i", "v", "border", "r", "c", "free", "taken"), steps)


def adjusted(scene: Scene, edges: DataFrame, targets: DataFrame, s: Settings, mu: DataFrame | None = None) -> tuple[Scene, DataFrame]:
    """The scene after one damped Gauss-Newton step, and (graph, energy) before it.

    ``edges`` has (graph, i, vi, j, vj) and ``targets`` besides these r, c, tu, tv, wu, wv, one
    row a pixel of an edge, without nulls. ``mu`` (graph, mu) is used with a threshold. A band is one keyframe
    view's ``s.band`` grid rows with all their edges. Steps of disparities above 10 are left
    out and they are kept at 0.001 or more; variables that no residual touches stay.
    """
    made, steps = solved(scene, edges, targets, s, mu)
    frames = written(_stepped(scene.frames, steps, "k", F.col("k"), ["fixed"], False), "frames")
    rig = written(_stepped(scene.rig, steps, "v", -1 - 2 * F.col("v"), [], True), "rig") if s.rig else scene.rig
    cams = scene.cams
    if s.focal:
        x = steps.select(F.col("graph").alias("__g"), F.col("p").alias("__p"), "x0")
        met = cams.join(x, (F.col("graph") == F.col("__g")) & (F.col("__p") == (F.lit(-2) if s.one_focal else -2 - 2 * F.col("v"))), "left")
        wider = F.coalesce("x0", F.lit(0.0))
        cams = written(met.select("graph", "v", (F.col("fx") + wider).alias("fx"), (F.col("fy") + wider).alias("fy"), "cx", "cy"), "cams")
    pixels = scene.pixels
    if not s.motion_only:
        found = disparity_steps(made, steps)
        moved = pixels.join(found, ["graph", "i", "v", "r", "c"], "left")
        step = F.coalesce("step", F.lit(0.0))
        dense = F.greatest(F.lit(1e-3), F.col("disp") + F.when(step > 10, 0.0).otherwise(step))
        disp = F.when(F.col("r") >= 0, dense).otherwise(F.least(F.lit(10.0), F.greatest(F.lit(1e-3), F.col("disp") + step)))
        pixels = written(moved.select(*[disp.alias(c) if c == "disp" else F.col(c) for c in pixels.columns]), "pixels")
    energy = made.where(F.col("kind") == _FACTOR).groupBy("graph").agg(F.sum("energy").alias("energy"))
    return Scene(frames, rig, cams, pixels), energy


def annealed(scene: Scene, edges: DataFrame, targets: DataFrame, s: Settings, mu: DataFrame, mu_steps: int = 4, inner: int = 6) -> tuple[Scene, DataFrame, DataFrame]:
    """The scene after ``inner`` steps at each of ``mu_steps`` values of every graph's mu; (graph, step, energy); the last (graph, mu).

    ``mu`` (graph, mu) is where each graph begins; between rounds it grows to
    least(mu * s.mu_step, s.mu_most), from residuals all counted to truncated ones.
    """
    energies = []
    for n in range(mu_steps):
        for k in range(inner):
            scene, energy = adjusted(scene, edges, targets, s, mu)
            energies.append(energy.withColumn("step", F.lit(n * inner + k)))
        mu = written(mu.select("graph", F.least(F.col("mu") * s.mu_step, F.lit(s.mu_most)).alias("mu")), "mu")
    told = energies[0]
    for e in energies[1:]:
        told = told.unionByName(e)
    return scene, told.select("graph", "step", "energy"), mu
