"""Alignment of trajectories whose sensor sits on an unknown lever arm, from sums gathered in one pass."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framequery.functions import geometry as g

_AXES = "xyz"
_ONE = [f"a{k}" for k in range(3)]
_TURN = [f"m{p}{q}" for p in range(3) for q in range(3)]


def _sums() -> dict[str, F.Column]:
    """Sums of a pose's rotation m and place a and its target b, and of the products that any lever arm needs."""
    c = F.col
    out = {f"s_{n}": c(n) for n in [*_TURN, *_ONE, *[f"b{k}" for k in range(3)]]}
    out["aa"] = sum((c(n) * c(n) for n in _ONE), F.lit(0.0))
    out |= {f"ma{q}": sum((c(f"m{p}{q}") * c(f"a{p}") for p in range(3)), F.lit(0.0)) for q in range(3)}
    out |= {f"ba{p}{q}": c(f"b{p}") * c(f"a{q}") for p in range(3) for q in range(3)}
    out |= {f"bm{k}{p}{q}": c(f"b{k}") * c(f"m{p}{q}") for k in range(3) for p in range(3) for q in range(3)}
    return out


_SPIN = np.array([[[0, 0, 0], [0, 0, -1], [0, 1, 0]], [[0, 0, 1], [0, 0, 0], [-1, 0, 0]], [[0, -1, 0], [1, 0, 0], [0, 0, 0]]], float)
_TWICE = np.einsum("kab,lbc->klac", _SPIN, _SPIN) + np.einsum("lab,kbc->klac", _SPIN, _SPIN)


def _starts() -> np.ndarray:
    """The 24 rotations that a cube has: none is further than 63 degrees from one of them."""
    flips = [np.array(x, float) for x in itertools.product((1, -1), repeat=3)]
    own = [np.diag(s)[:, list(p)] for p in itertools.permutations(range(3)) for s in flips]
    return np.array([m for m in own if np.linalg.det(m) > 0])


def _nearest(m: np.ndarray) -> np.ndarray:
    u, _, vt = np.linalg.svd(m)
    u[..., 2] *= np.sign(np.linalg.det(u) * np.linalg.det(vt))[..., None]
    return u @ vt


def _turned(k: np.ndarray, g: np.ndarray, r: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Rotations (n, 3, 3) climbed by Newton steps to where 2 g r + r K r is greatest near them, and that value."""
    value = lambda x: 2 * np.einsum("na,na->n", g, x.reshape(-1, 9)) + np.einsum("na,nab,nb->n", x.reshape(-1, 9), k, x.reshape(-1, 9))
    now, share = value(r), np.ones(len(r))
    least = 1e-14 * (np.abs(now) + np.einsum("nab,nab->n", k, k) ** 0.5)
    for _ in range(rounds):
        pull = g + np.einsum("nab,nb->na", k, r.reshape(-1, 9))
        along = np.einsum("nab,kbc->nkac", r, _SPIN).reshape(-1, 3, 9)
        slope = 2 * np.einsum("na,nka->nk", pull, along)
        bend = 2 * along @ k @ along.transpose(0, 2, 1) + np.einsum("nac,nab,klbc->nkl", pull.reshape(-1, 3, 3), r, _TWICE)
        e, v = np.linalg.eigh(-bend)
        size = np.maximum(np.abs(e), 1e-13 * np.abs(e).max(1, keepdims=True) + 1e-300)
        step = share[:, None] * np.einsum("nab,nb->na", v, np.einsum("nba,nb->na", v, slope) / size)
        far = np.linalg.norm(step, axis=1)
        step *= np.minimum(1.0, 1.0 / np.maximum(far, 1e-300))[:, None]
        if far.max(initial=0.0) < 1e-15:
            break
        x = np.einsum("nk,kab->nab", step, _SPIN)
        angle = np.linalg.norm(step, axis=1)[:, None, None]
        new = r @ (np.eye(3) + np.sinc(angle / np.pi) * x + 0.5 * np.sinc(angle / (2 * np.pi)) ** 2 * x @ x)
        then = value(new)
        better = then >= now - least
        r, now, share = np.where(better[:, None, None], new, r), np.where(better, then, now), np.where(better, 1.0, share / 4)
    return _nearest(r), now


def _aligned(sums: pd.DataFrame, scaled: bool, rounds: int) -> tuple[np.ndarray, ...]:
    """(scale, rotation, translation, lever arm) of every row of sums.

    For a given rotation the rest is linear (scaled arm, scale, turned translation), with a
    matrix that no rotation enters; what is left is a quadratic form of the rotation's
    entries, whose best rotation is climbed to from all round. Turns of the arm and of the
    transform, of which one alone hardly moves, thereby move together.
    """
    pick = lambda *names: sums[list(names)].to_numpy(float)
    m = len(sums)
    n, aa = pick("n")[:, 0], pick("aa")[:, 0]
    turn, a, b = pick(*[f"s_{x}" for x in _TURN]).reshape(m, 3, 3), pick(*[f"s_{x}" for x in _ONE]), pick(*[f"s_b{k}" for k in range(3)])
    ma, ba = pick(*[f"ma{k}" for k in range(3)]), pick(*[f"ba{p}{q}" for p in range(3) for q in range(3)])
    bm = pick(*[f"bm{k}{p}{q}" for k in range(3) for p in range(3) for q in range(3)]).reshape(m, 9, 3)
    system, side = np.zeros((m, 7, 7)), np.zeros((m, 7, 9))
    eye = n[:, None, None] * np.eye(3)
    system[:, :3, :3] = system[:, 4:, 4:] = eye
    system[:, :3, 4:], system[:, 4:, :3] = turn.transpose(0, 2, 1), turn
    system[:, 3, 3] = aa
    for rows, x in ((slice(0, 3), ma), (slice(4, 7), a)):
        system[:, rows, 3] = system[:, 3, rows] = x
    side[:, :3], side[:, 3] = bm.transpose(0, 2, 1), ba
    side[:, 4:] = np.einsum("np,qc->nqpc", b, np.eye(3)).reshape(m, 3, 9)
    # where the places don't move, arm and scale are told only together
    free = np.full(m, scaled) & (aa / n - (a * a).sum(1) / (n * n) > 1e-12)
    known = system[:, :, 3].copy()  # what a scale of one brings
    known[free] = 0
    held = ~free
    known[held, 3] = 0
    system[held, 3, :] = system[held, :, 3] = 0
    side[held, 3] = 0
    inverse = np.linalg.pinv(system, rcond=1e-13, hermitian=True)
    k = side.transpose(0, 2, 1) @ inverse @ side
    g = np.where(held[:, None], ba, 0.0) - np.einsum("nca,ncd,nd->na", side, inverse, known)
    top = np.linalg.eigh(k)[1][:, :, -1].reshape(m, 3, 3)
    first = np.concatenate([np.broadcast_to(_starts(), (m, 24, 3, 3)), _nearest(top)[:, None], _nearest(-top)[:, None]], 1)
    count = first.shape[1]
    wide = lambda x: np.repeat(x, count, 0)
    near, value = _turned(wide(k), wide(g), first.reshape(-1, 3, 3), min(rounds, 12))
    near, value = near.reshape(m, count, 3, 3), value.reshape(m, count)
    # a negative scale would mirror the path
    scale_of = np.einsum("nd,ndc,nkc->nk", inverse[:, 3], side, near.reshape(m, count, 9))
    value = np.where(free[:, None] & (scale_of <= 0), -np.inf, value)
    best = near[np.arange(m), value.argmax(1)]
    rotation, _ = _turned(k, g, best, rounds)
    z = np.einsum("ncd,nd->nc", inverse, np.einsum("nca,na->nc", side, rotation.reshape(m, 9)) - known)
    scale = np.where(free & (z[:, 3] > 0), z[:, 3], 1.0)
    arm = z[:, :3] / scale[:, None]
    moved = np.einsum("nab,nb->na", turn, arm) + a
    shift = (b - scale[:, None] * np.einsum("nab,nb->na", rotation, moved)) / n[:, None]
    return scale, rotation, shift, arm


def lever_arms(poses: DataFrame, by: str, scaled: bool = True, rounds: int = 60) -> DataFrame:
    """(by, n, scale, r00..r22, tx..tz, arm_x..arm_z, error): scale * R (Q_i arm + p_i) + t nearest to b_i, over each trajectory.

    ``poses`` has (by, tx..qw, b0, b1, b2): poses Q_i, p_i and where a point fixed to the sensor
    went. A trajectory enters through one pass of sums; the search for transform and arm
    runs on these alone, many trajectories at a time. error is the root mean square distance left. Rows
    with a null are left out; where the motion doesn't tell the arm, it is one of the best.
    """
    q = {n: c for n, c in zip([f"{k}{x}" for k in range(3) for x in ("0", "1", "2", "t")], g.matrix(g.pose()), strict=True)}
    rows = poses.select(by, *[q[f"{p}{k}"].alias(f"m{p}{k}") for p in range(3) for k in range(3)], *[F.col(f"t{x}").alias(n) for n, x in zip(_ONE, _AXES, strict=True)], "b0", "b1", "b2").na.drop()
    sums = rows.groupBy(by).agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(n) for n, c in _sums().items()], F.sum(F.col("b0") * F.col("b0") + F.col("b1") * F.col("b1") + F.col("b2") * F.col("b2")).alias("bb"))
    out = ["n", "scale", *[f"r{p}{k}" for p in range(3) for k in range(3)], *[f"t{x}" for x in _AXES], *[f"arm_{x}" for x in _AXES], "error"]

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lo in range(0, len(batch), 512):
                s = batch.iloc[lo : lo + 512].reset_index(drop=True)
                n, m = s["n"].to_numpy(float), len(s)
                scale, rotation, shift, arm = _aligned(s, scaled, rounds)
                pick = lambda *names: s[list(names)].to_numpy(float)  # noqa: B023, E731
                turn, a, b = pick(*[f"s_{x}" for x in _TURN]).reshape(m, 3, 3), pick(*[f"s_{x}" for x in _ONE]), pick(*[f"s_b{k}" for k in range(3)])
                bm = pick(*[f"bm{k}{p}{c}" for k in range(3) for p in range(3) for c in range(3)]).reshape(m, 3, 3, 3)
                ba = pick(*[f"ba{p}{c}" for p in range(3) for c in range(3)]).reshape(m, 3, 3)
                own = n * (arm * arm).sum(1) + 2 * (arm * pick("ma0", "ma1", "ma2")).sum(1) + s["aa"].to_numpy()
                moved = np.einsum("nab,nb->na", rotation, np.einsum("nab,nb->na", turn, arm) + a)
                met = (rotation * (np.einsum("nabc,nc->nab", bm, arm) + ba)).sum((1, 2))
                left = scale * scale * own + n * (shift * shift).sum(1) + s["bb"].to_numpy() + 2 * scale * (shift * moved).sum(1) - 2 * scale * met - 2 * (shift * b).sum(1)
                done = np.column_stack([scale, rotation.reshape(m, 9), shift, arm, np.sqrt(np.maximum(left, 0.0) / n)])
                yield pd.DataFrame(done, columns=out[1:]).assign(**{by: s[by], "n": s["n"]})[[by, *out]]

    kind = poses.schema[by].dataType.simpleString()
    return sums.mapInPandas(solve, f"{by} {kind}, n long, " + ", ".join(f"{c} double" for c in out[1:]))
