"""Overlapping tiles of grids brought to one scale by a chain of fits, and blended into one stream.

Each tile has its own unknown scale and shift. Its first frames repeat keyframes of the tile
before, and the fit of one to the other gives both; as the keyframes compared with are
aligned and clamped themselves, tiles of a stream are fitted in order. That walk reads a few frames a
tile and keeps a few grids; all frames are then aligned and blended in parallel.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Tiling:
    """Frames a tile, frames it shares with the one before, frames blended, and the places that the first shared ones repeat.

    The defaults are fixed values of the usual model.
    """

    length: int = 32
    overlap: int = 10
    blend: int = 8
    keys: tuple[int, ...] = (0, 12)

    @property
    def stride(self) -> int:
        return self.length - self.overlap


def tiled(frames: DataFrame, by: str, frame: str, last: str, t: Tiling = Tiling()) -> DataFrame:
    """Rows of ``frames`` once for every (tile, place) that shows them; the last frame of a stream (column ``last``) fills its last tile.

    A tile's first ``len(t.keys)`` places show the keyframes of the tile before, its others
    the frames that follow one another.
    """
    count = F.col(last) + 1
    tiles = F.greatest(F.lit(1).cast("long"), F.ceil(count / t.stride))
    follow = F.transform(F.sequence(F.lit(0), F.lit(t.length - 1)), lambda p: F.struct(F.floor((F.col(frame) - p) / t.stride).cast("long").alias("tile"), p.alias("place"), ((F.col(frame) - p) % t.stride == 0).alias("fits")))
    keyed = F.array(*[F.struct((F.floor((F.col(frame) - k) / t.stride) + 1).cast("long").alias("tile"), F.lit(n).alias("place"), ((F.col(frame) - k) % t.stride == 0).alias("fits")) for n, k in enumerate(t.keys)])
    own = F.filter(follow, lambda s: s["fits"] & (s["tile"] >= 0) & (s["tile"] < tiles) & ((s["tile"] == 0) | (s["place"] >= len(t.keys))))
    again = F.filter(keyed, lambda s: s["fits"] & (s["tile"] >= 1) & (s["tile"] < tiles))
    # places after the last frame, of whichever tiles reach beyond it
    reach = F.sequence(F.greatest(F.lit(0).cast("long"), F.floor((F.col(last) - t.length) / t.stride).cast("long")), tiles - 1)
    beyond = F.flatten(F.transform(reach, lambda k: F.transform(F.sequence(F.lit(0), F.lit(t.length - 1)), lambda p: F.struct(k.alias("tile"), p.alias("place"), ((k * t.stride + p > F.col(last)) & ((k == 0) | (p >= len(t.keys)))).alias("fits")))))
    keys_beyond = F.flatten(F.transform(reach, lambda k: F.array(*[F.struct((k + 1).alias("tile"), F.lit(n).alias("place"), ((k * t.stride + key > F.col(last)) & (k + 1 < tiles)).alias("fits")) for n, key in enumerate(t.keys)])))
    fill = F.when(F.col(frame) == F.col(last), F.filter(F.concat(beyond, keys_beyond), lambda s: s["fits"])).otherwise(F.filter(own, lambda s: F.lit(False)))
    return frames.withColumn("__at", F.explode(F.concat(own, again, fill))).select(*frames.columns, "__at.tile", "__at.place")


def chain(tiles: DataFrame, by: str, grid: str, t: Tiling = Tiling()) -> DataFrame:
    """(by, tile, scale, shift) of each tile of (by, tile, place, grid: array<double>), the first as it is.

    The reference of a tile's first shared frame stays that of the first tile; those of the
    others are the tile's before, aligned and not below 0. A fit without spread, and a tile without
    its shared frames, keep scale 1 and shift 0. Tiles of a stream come in order; of each only the shared
    frames and keyframes travel.
    """
    wanted = sorted({*range(len(t.keys)), *t.keys})

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, held, references = None, {}, []

        def fitted() -> list[tuple]:
            if key is None:
                return []
            x = [held.get(n) for n in range(len(t.keys))]
            scale, shift = 1.0, 0.0
            if references and all(v is not None for v in [*x, *references]):
                p, q = np.concatenate(x), np.concatenate(references)
                fine = ~(np.isnan(p) | np.isnan(q))
                p, q = p[fine], q[fine]
                det = (p @ p) * len(p) - p.sum() ** 2
                if det > 1e-12 * max(1.0, (p @ p) * len(p)):
                    scale, shift = (len(p) * (p @ q) - p.sum() * q.sum()) / det, ((p @ p) * q.sum() - p.sum() * (p @ q)) / det
            aligned = [None if held.get(k) is None else np.maximum(held[k] * scale + shift, 0) if references else held[k] for k in t.keys]
            references[:] = [references[0], *aligned[1:]] if references else aligned
            return [(*key, scale, shift)]

        for b in batches:
            found = []
            for stream, tile, place, values in b[[by, "tile", "place", grid]].itertuples(index=False):
                if (stream, tile) != key:
                    found += fitted()
                    if key is None or stream != key[0]:
                        references = []
                    key, held = (stream, tile), {}
                held[place] = np.asarray(values, float)
            yield pd.DataFrame(found, columns=[by, "tile", "scale", "shift"])
        yield pd.DataFrame(fitted(), columns=[by, "tile", "scale", "shift"])

    kind = tiles.schema[by].dataType.simpleString()
    rows = tiles.where(F.col("place").isin(*wanted)).select(by, "tile", "place", grid)
    return rows.repartition(by).sortWithinPartitions(by, "tile", "place").mapInPandas(walk, f"{by} {kind}, tile long, scale double, shift double")


def blended(tiles: DataFrame, fits: DataFrame, by: str, grid: str, t: Tiling = Tiling()) -> DataFrame:
    """(by, frame, grid): each frame from the one or two tiles that show it, aligned; no value below 0 but in the first tile.

    The last ``blend`` places of a tile fade into the places before ``overlap`` of the next, in equal
    steps from one to the other.
    """
    shared = t.overlap - t.blend
    met = tiles.join(fits, [by, "tile"]).where((F.col("tile") == 0) | (F.col("place") >= shared))
    aligned = F.when(F.col("tile") == 0, F.col(grid)).otherwise(F.transform(grid, lambda x: F.greatest(x * F.col("scale") + F.col("shift"), F.lit(0.0))))
    frame = (F.col("tile") * t.stride + F.col("place")).cast("long")
    one = met.select(by, frame.alias("frame"), F.struct("tile", "place", aligned.alias("x")).alias("v"))
    both = one.groupBy(by, "frame").agg(F.sort_array(F.collect_list("v")).alias("v"))
    rising = (F.col("v")[1]["place"] - shared) / F.lit(float(t.blend - 1))
    mixed = F.zip_with(F.col("v")[0]["x"], F.col("v")[1]["x"], lambda a, b: a * (1 - rising) + b * rising)
    return both.select(by, "frame", F.when(F.size("v") == 1, F.col("v")[0]["x"]).otherwise(mixed).alias(grid))


def first_frames(stream: DataFrame, frame: Column, last: Column) -> DataFrame:
    """The frames of a stream without those that only filled its last tile."""
    return stream.where(frame <= last)
