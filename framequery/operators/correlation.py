"""Correlation of feature maps, at moving coordinates level by level or under shifts, without the volume of all pixel pairs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .written import written

_MAP = "frame long, level int, h int, w int, dim int, data binary"


def pyramid(maps: DataFrame, levels: int = 4) -> DataFrame:
    """(frame, level, h, w, dim, data): each map of (frame, h, w, dim, data array<float>) and its halves by means of 2 x 2.

    data runs by row, column and channel; levels hold floats as wide as data's. An odd last row or column
    falls out of the next level, and levels without a pixel aren't made. A map whose data don't fill its shape is an
    error.
    """

    kind = np.float64 if maps.schema["data"].dataType.elementType.typeName() == "double" else np.float32

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for frame, h, w, dim, data in b.itertuples(index=False):
                x, out = np.asarray(data, kind).reshape(h, w, dim), []
                for level in range(levels):
                    if not x.size:
                        break
                    out.append((frame, level, x.shape[0], x.shape[1], dim, x.tobytes()))
                    h2, w2 = x.shape[0] // 2, x.shape[1] // 2
                    x = x[: 2 * h2, : 2 * w2].reshape(h2, 2, w2, 2, dim).mean((1, 3))
                yield pd.DataFrame(out, columns=["frame", "level", "h", "w", "dim", "data"])

    return maps.select("frame", F.col("h").cast("int"), F.col("w").cast("int"), F.col("dim").cast("int"), "data").mapInPandas(run, _MAP)


def _window(one: np.ndarray, two: np.ndarray, first: np.ndarray, h: np.ndarray, w: np.ndarray, u: np.ndarray, v: np.ndarray, radius: int) -> np.ndarray:
    """(n, (2 radius + 1)^2): products of vectors with maps, bilinear about (u, v), columns outer; nought beyond the map.

    Maps lie one after another in the rows of ``two``; each vector's begins at ``first`` and is ``h`` by ``w``.
    """
    side = 2 * radius + 1
    x0, y0 = np.floor(u).astype(int) - radius, np.floor(v).astype(int) - radius
    x, y = x0[:, None, None] + np.arange(side + 1)[None, :, None], y0[:, None, None] + np.arange(side + 1)[None, None, :]
    h, w, first = h[:, None, None], w[:, None, None], first[:, None, None]
    inside = (x >= 0) & (x < w) & (y >= 0) & (y < h)
    near = two[first + np.clip(y, 0, h - 1) * w + np.clip(x, 0, w - 1)]
    dots = np.where(inside, np.einsum("nd,nxyd->nxy", one, near), 0.0)
    fu, fv = (u - np.floor(u))[:, None, None], (v - np.floor(v))[:, None, None]
    mixed = dots[:, :-1] * (1 - fu) + dots[:, 1:] * fu
    return (mixed[:, :, :-1] * (1 - fv) + mixed[:, :, 1:] * fv).reshape(len(u), -1)


def _end_to_end(maps: list[bytes], h: np.ndarray, w: np.ndarray, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """The vectors of all maps one after another, and where each map begins."""
    size = h.astype(int) * w
    return np.frombuffer(b"".join(maps), np.float32 if sum(map(len, maps)) == 4 * dim * size.sum() else np.float64).reshape(-1, dim), np.append(0, np.cumsum(size))[:-1]


def _met(b: pa.RecordBatch, radius: int, scale: float) -> Iterator[pa.RecordBatch]:
    """(i, j, r, c, corr) of rows of (i, j, pixels, h1, w1, dim, one, levels), of which all pixels are looked up together."""
    lists = b.column(2)
    owner = np.repeat(np.arange(b.num_rows), np.diff(lists.offsets.to_numpy()))
    r, c, u, v = (x.to_numpy(zero_copy_only=False) for x in lists.flatten().flatten())
    h1, w1, dims = (b.column(k).to_numpy() for k in (3, 4, 5))
    fits = (r >= 0) & (r < h1[owner]) & (c >= 0) & (c < w1[owner])
    owner, r, c, u, v = (x[fits] for x in (owner, r, c, u, v))
    levels = b.column(7).to_pylist()
    kind = np.array([[d, len(x)] for d, x in zip(dims, levels, strict=True)]).reshape(-1, 2)
    for dim, depth in np.unique(kind, axis=0):
        of = np.flatnonzero((kind == (dim, depth)).all(1))
        place = np.full(b.num_rows, -1)
        place[of] = np.arange(len(of))
        some = np.flatnonzero(place[owner] >= 0)
        if depth == 0 or not len(some):
            continue
        one, first = _end_to_end([b.column(6)[int(k)].as_py() for k in of], h1[of], w1[of], dim)
        others = []
        for n in range(depth):
            own = [levels[k][n] for k in of]
            sizes = [np.array([x[s] for x in own]) for s in "hw"]
            others.append((own[0]["level"], *_end_to_end([x["data"] for x in own], *sizes, dim), *sizes))
        step = max(1, (32 << 20) // ((2 * radius + 2) ** 2 * int(dim) * 8))
        for lo in range(0, len(some), step):
            at = some[lo : lo + step]
            k = place[owner[at]]
            vectors = one[first[k] + r[at] * w1[owner[at]] + c[at]].astype(float) / scale
            corr = [_window(vectors, two, start[k], h[k], w[k], u[at] / 2**level, v[at] / 2**level, radius) for level, two, start, h, w in others]
            corr = np.concatenate([x / scale for x in corr], 1)
            ends = np.arange(len(at) + 1, dtype=np.int32) * corr.shape[1]
            ids = [pa.array(b.column(n).to_numpy()[owner[at]]) for n in (0, 1)]
            yield pa.RecordBatch.from_arrays([*ids, pa.array(r[at]), pa.array(c[at]), pa.ListArray.from_arrays(pa.array(ends), pa.array(corr.ravel()))], names=["i", "j", "r", "c", "corr"])


def lookup(levels: DataFrame, coords: DataFrame, radius: int = 3, scale: float = 4.0, band: int = 64) -> DataFrame:
    """(i, j, r, c, corr): for pixel (r, c) of map i the products with map j about (u, v), level after level.

    ``coords`` has (i, j, r, c, u, v), u along columns. Level l is met at (u, v) / 2^l; features are
    divided by ``scale`` on both sides. An edge's pixels go to its two maps as one list for each ``band``
    of rows, all levels are met there, and nothing is gathered after. Coordinates that are null or not finite are left out,
    as are pixels off map i and edges without both maps.
    """
    fine = coords.where("i is not null and j is not null and r is not null and c is not null and not isnan(u) and not isnan(v) and abs(u) < 1e9 and abs(v) < 1e9")
    pixel = F.struct(*[F.col(x).cast("long").alias(x) for x in "rc"], *[F.col(x).cast("double").alias(x) for x in "uv"])
    grouped = fine.groupBy("i", "j", F.floor(F.col("r") / band).alias("part")).agg(F.collect_list(pixel).alias("pixels"))
    own = levels.where("level = 0").select(F.col("frame").alias("i"), F.col("h").alias("h1"), F.col("w").alias("w1"), "dim", F.col("data").alias("one"))
    other = levels.groupBy(F.col("frame").alias("j")).agg(F.sort_array(F.collect_list(F.struct("level", "h", "w", "data"))).alias("levels"))
    met = grouped.join(own, "i").join(other, "j").select(F.col("i").cast("long").alias("i"), F.col("j").cast("long").alias("j"), "pixels", "h1", "w1", "dim", "one", "levels")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                yield from _met(b.slice(lo, 256), radius, scale)

    return met.mapInArrow(run, "i long, j long, r long, c long, corr array<double>")


def shifted(maps: DataFrame, edges: DataFrame, radius: int) -> DataFrame:
    """(i, j, dr, dc, corr): sums of products of two maps (frame, h, w, data array<double>) under every shift within ``radius``.

    data runs by row and column. Maps meet whole, once an edge; pixels beyond the second map count as nought.
    """
    side = lambda k: maps.select(F.col("frame").alias(k), *[F.col(x).alias(f"{x}_{k}") for x in ("h", "w", "data")])
    met = edges.join(side("i"), "i").join(side("j"), "j").select("i", "j", *[f"{x}_{k}" for k in "ij" for x in ("h", "w", "data")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            i, j, ha, wa, hb, wb = (b.column(k).to_numpy() for k in (0, 1, 2, 3, 5, 6))
            shapes = np.stack([ha, wa, hb, wb], 1)
            for h, w, h2, w2 in np.unique(shapes, axis=0):
                of = np.flatnonzero((shapes == (h, w, h2, w2)).all(1))
                one, two = (b.column(k).take(pa.array(of)).flatten().to_numpy(zero_copy_only=False).reshape(len(of), *size) for k, size in ((4, (h, w)), (7, (h2, w2))))
                wide = np.pad(two, ((0, 0), (radius, radius + max(0, h - h2)), (radius, radius + max(0, w - w2))))
                for dr in range(-radius, radius + 1):
                    for dc in range(-radius, radius + 1):
                        corr = (one * wide[:, radius + dr : radius + dr + h, radius + dc : radius + dc + w]).sum((1, 2))
                        shift = [pa.array(np.full(len(of), d)) for d in (dr, dc)]
                        yield pa.RecordBatch.from_arrays([pa.array(i[of]), pa.array(j[of]), *shift, pa.array(corr)], names=["i", "j", "dr", "dc", "corr"])

    return met.mapInArrow(run, "i long, j long, dr long, dc long, corr double")


def looked_up(maps: DataFrame, coords: DataFrame, levels: int = 4, radius: int = 3) -> DataFrame:
    """lookup() in the pyramid of ``maps``, which is written once."""
    return lookup(written(pyramid(maps, levels), "pyramid"), coords, radius)
