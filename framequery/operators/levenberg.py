"""Levenberg-Marquardt over many small systems at once, one a group.

A round evaluates the trial parameters of all live groups in one pass over the rows: residuals and
Jacobians are formed in Arrow batches, summed by group inside the batch and then by Spark, so
that a group of any size moves as a few numbers a task. Each group then accepts or refuses
its own trial, keeps its own damping, and leaves the loop when its cost stands still.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .written import written

#: (columns of a batch, parameters a row) -> kinds of residuals, each (r of n x m, J of n x m x k).
Model = Callable[[dict[str, np.ndarray], np.ndarray], list[tuple[np.ndarray, np.ndarray]]]


@dataclass(frozen=True)
class Settings:
    """``scales`` are the Huber scales of the model's kinds of residuals, none for plain squares.

    Without ``refuse`` every trial is taken, also one that costs more; its damping still rises.
    """

    damping: float = 0.1
    least: float = 1e-6
    most: float = 1e2
    eps: float = 1e-6
    atol: float = 1e-8
    rtol: float = 1e-8
    most_steps: int = 30
    scales: tuple[float | None, ...] = (None,)
    refuse: bool = True


def scaled_huber(x: np.ndarray, scale: float | None) -> tuple[np.ndarray, np.ndarray]:
    """The loss of squared residuals, quadratic up to ``scale`` and linear beyond, and its derivative."""
    if scale is None:
        return x, np.ones_like(x)
    root = np.sqrt(np.maximum(x, scale * scale)) / scale
    return np.where(x <= scale * scale, x, (2 * root - 1) * scale * scale), 1 / root


def _sums(rows: DataFrame, trials: DataFrame, by: str, model: Model, k: int, settings: Settings) -> DataFrame:
    """(by, n, loss, g0.., h0..): grouped sums at the trial parameters."""
    met = rows.join(trials.select(by, F.col("trial").alias("__trial")), by)
    names = [c for c in met.columns if c not in (by, "__trial")]
    upper = np.triu_indices(k)
    out = [by, "n", "loss", *[f"g{a}" for a in range(k)], *[f"h{a}" for a in range(len(upper[0]))]]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not len(b):
                continue
            keys = b.column(b.schema.names.index(by)).dictionary_encode()
            code, n = keys.indices.to_numpy(), len(keys.dictionary)
            columns = {c: b.column(b.schema.names.index(c)).to_numpy(zero_copy_only=False) for c in names}
            params = b.column(b.schema.names.index("__trial")).flatten().to_numpy().reshape(len(b), k)
            parts = np.zeros((len(b), len(out) - 1))
            parts[:, 0] = 1
            for (r, j), scale in zip(model(columns, params), settings.scales, strict=True):
                loss, w = scaled_huber((r * r).sum(1), scale)
                parts[:, 1] += loss
                parts[:, 2 : 2 + k] += np.einsum("n,nm,nmk->nk", w, r, j)
                parts[:, 2 + k :] += np.einsum("n,nma,nmb->nab", w, j, j)[:, upper[0], upper[1]]
            sums = np.stack([np.bincount(code, p, n) for p in parts.T])
            yield pa.RecordBatch.from_arrays([keys.dictionary, pa.array(sums[0].astype(np.int64)), *map(pa.array, sums[1:])], names=out)

    kind = rows.schema[by].dataType.simpleString()
    part = met.mapInArrow(partial, f"`{by}` {kind}, n long, " + ", ".join(f"{c} double" for c in out[2:]))
    return part.groupBy(by).agg(*[F.sum(c).alias(c) for c in out[1:]])


def _advanced(state: DataFrame, sums: DataFrame, by: str, k: int, settings: Settings) -> DataFrame:
    """Every live group's state after its trial was judged, with the next trial."""
    upper = np.triu_indices(k)

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if not len(b):
                continue
            lists = {c: np.array(b[c].tolist(), float) for c in ("params", "trial", "grad", "hess")}
            cost, old = (b["loss"] / b["n"]).to_numpy(), b["cost"].to_numpy()
            first = b["steps"].to_numpy() == 0
            better = np.isfinite(cost) & (first | (cost <= old))
            taken = first | better | (~np.array(settings.refuse) & np.isfinite(cost))
            pick = lambda new, was: np.where(taken[:, None], new, was)
            params = pick(lists["trial"], lists["params"])
            grad = pick(b[[f"g{a}" for a in range(k)]].to_numpy(), lists["grad"])
            hess = pick(b[[f"h{a}" for a in range(len(upper[0]))]].to_numpy(), lists["hess"])
            damping = np.where(first, b["damping"], np.clip(b["damping"] * np.where(better, 0.1, 10.0), settings.least, settings.most))
            still = np.abs(cost - old) <= settings.atol + settings.rtol * np.abs(old)
            stuck = ~taken & (b["damping"].to_numpy() >= settings.most)
            done = ~first & ((taken & still) | stuck) | ~np.isfinite(np.where(taken, cost, old))
            h = np.zeros((len(b), k, k))
            h[:, upper[0], upper[1]] = h[:, upper[1], upper[0]] = np.nan_to_num(hess)
            diagonal = np.einsum("nkk->nk", h)
            h[:, range(k), range(k)] += np.maximum(diagonal * damping[:, None], settings.eps)
            delta = np.linalg.solve(h, -np.nan_to_num(grad)[:, :, None])[:, :, 0]
            yield pd.DataFrame({
                by: b[by], "params": list(params), "trial": list(params + delta), "damping": damping, "cost": np.where(taken, cost, old),
                "grad": list(grad), "hess": list(hess), "steps": b["steps"] + 1, "done": done,
            })

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in state.schema.fields)
    return state.join(sums, by).mapInPandas(judge, schema)


def fit(rows: DataFrame, start: DataFrame, by: str, model: Model, settings: Settings = Settings()) -> DataFrame:
    """(by, params, cost, steps, damping, converged) of each group of ``rows`` that ``start`` (by, params array<double>) names.

    cost is the mean over the group's rows of the summed losses at the parameters. A group is
    done when a taken trial changes its cost by no more than atol + rtol * cost, or when no
    trial helps at the greatest damping; one that isn't after ``most_steps`` trials is given
    as it stands, not converged. One whose first cost isn't finite is given at its start with
    cost null. Groups without rows or without a start, and null groups, are left out. The rows
    are read once a round and only (by, trial) joins them.
    """
    k = len(start.first().params) if not start.isEmpty() else 1
    empty = F.array_repeat(F.lit(0.0), k)
    state = start.select(
        by, "params", F.col("params").alias("trial"), F.lit(settings.damping).alias("damping"), F.lit(0.0).alias("cost"),
        empty.alias("grad"), F.array_repeat(F.lit(0.0), k * (k + 1) // 2).alias("hess"), F.lit(0).cast("long").alias("steps"), F.lit(False).alias("done"),
    )
    finished = []
    for _ in range(settings.most_steps + 1):
        state = written(_advanced(state, _sums(rows, state, by, model, k, settings), by, k, settings), "levenberg")
        finished.append(state.where("done"))
        state = state.where("not done")
        if state.isEmpty():
            break
    finished.append(state)
    return reduce(DataFrame.unionByName, finished).select(by, "params", "cost", F.col("steps") - 1, "damping", F.col("done") & F.col("cost").isNotNull()).toDF(by, "params", "cost", "steps", "damping", "converged")


def perspective_field(columns: dict[str, np.ndarray], params: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Residuals of the up directions and latitudes of pixels under (roll, pitch, log focal length).

    Columns are u, v (from the principal point, down), the unit up direction up_u, up_v seen
    there, and sin_lat, the sine of its ray's latitude.
    """
    roll, pitch, focal = params[:, 0], params[:, 1], np.exp(params[:, 2])
    sr, cr, sp, cp = np.sin(roll), np.cos(roll), np.sin(pitch), np.cos(pitch)
    up = np.stack([sr * cp, -cr * cp, sp], 1)
    turned = np.stack([np.stack([cr * cp, sr * cp, 0 * sp], 1), np.stack([-sr * sp, cr * sp, cp], 1)], 2)
    x, y = columns["u"] / focal, columns["v"] / focal
    flat, ray = np.stack([x, y], 1), np.stack([x, y, np.ones_like(x)], 1)
    # up direction: the image of a step upwards, made unit
    w = up[:, :2] - up[:, 2:] * flat
    size = np.maximum(np.linalg.norm(w, axis=1), 1e-12)
    unit = w / size[:, None]
    dw = np.concatenate([turned[:, :2] - flat[:, :, None] * turned[:, 2:], (up[:, 2:] * flat)[:, :, None]], 2)
    j_up = (dw - unit[:, :, None] * np.einsum("nm,nmk->nk", unit, dw)[:, None, :]) / size[:, None, None]
    # latitude: the up component of the ray made unit
    n = np.linalg.norm(ray, axis=1)
    sine = (up * ray).sum(1) / n
    by_focal = -(up[:, :2] * flat).sum(1) / n + sine * (flat * flat).sum(1) / (n * n)
    j_lat = np.concatenate([np.einsum("nm,nmk->nk", ray, turned) / n[:, None], by_focal[:, None]], 1)
    return [(unit - np.stack([columns["up_u"], columns["up_v"]], 1), j_up), ((sine - columns["sin_lat"])[:, None], j_lat[:, None, :])]
