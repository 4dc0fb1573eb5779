"""Alignments whose sums Spark gathers and whose small decompositions run row by row in tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

AXES = ("x", "y", "z")


def similarity(points: DataFrame, by: str, rigid: bool = False) -> DataFrame:
    """(by, n, scale, r00..r22, tx, ty, tz): the similarity that takes a to b with least squared error; of scale 1 if ``rigid``.

    ``points`` has a_x..a_z and b_x..b_z. A group's rows enter through seventeen sums; only
    these meet the singular value decomposition, one 3x3 a group. A group without extent
    gets scale 1.
    """
    sums = [F.count(F.lit(1)).alias("n"), F.sum(F.col("a_x") * F.col("a_x") + F.col("a_y") * F.col("a_y") + F.col("a_z") * F.col("a_z")).alias("aa")]
    sums += [F.sum(f"{s}_{x}").alias(f"{s}_{x}") for s in "ab" for x in AXES]
    sums += [F.sum(F.col(f"b_{x}") * F.col(f"a_{y}")).alias(f"c_{x}{y}") for x in AXES for y in AXES]
    grouped = points.groupBy(by).agg(*sums)
    out = [by, "n", "scale", *[f"r{p}{q}" for p in range(3) for q in range(3)], "tx", "ty", "tz"]

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            found = []
            for r in rows.to_dict("records"):
                n = r["n"]
                a, b = (np.array([r[f"{s}_{x}"] for x in AXES]) / n for s in "ab")
                cov = np.array([[r[f"c_{x}{y}"] for y in AXES] for x in AXES]) / n - np.outer(b, a)
                u, d, vt = np.linalg.svd(cov)
                flip = np.diag([1.0, 1.0, np.sign(np.linalg.det(u) * np.linalg.det(vt)) or 1.0])
                rotation = u @ flip @ vt
                spread = r["aa"] / n - a @ a
                scale = float((d * np.diag(flip)).sum() / spread) if spread > 1e-12 and not rigid else 1.0
                found.append((r[by], n, scale, *rotation.ravel(), *(b - scale * rotation @ a)))
            yield pd.DataFrame(found, columns=out)

    kind = points.schema[by].dataType.simpleString()
    return grouped.mapInPandas(solve, f"{by} {kind}, n long, " + ", ".join(f"{c} double" for c in out[2:]))


def greedy_edges(rows: DataFrame, by: str, radius: int, most: int) -> DataFrame:
    """(by, i, j, d) of the nearest edges of each graph, at most ``most``, that keep apart from those taken.

    An edge is dropped if one taken lies within max(min(|i - j| - 2, radius), 0) of it in the
    sum of both ends' distances. Graphs are walked in order of (d, i, j); a walk holds the
    edges taken, at most ``most``.
    """

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, taken = None, []
        for b in batches:
            found = []
            for k, i, j, d in b[[by, "i", "j", "d"]].itertuples(index=False):
                if k != key:
                    key, taken = k, []
                near = max(min(abs(i - j) - 2, radius), 0)
                if len(taken) < most and all(abs(i - p) + abs(j - q) > near for p, q in taken):
                    taken.append((i, j))
                    found.append((k, i, j, d))
            yield pd.DataFrame(found, columns=[by, "i", "j", "d"])

    picked = rows.select(by, "i", "j", "d")
    return picked.repartition(by).sortWithinPartitions(by, "d", "i", "j").mapInPandas(walk, picked.schema)


def mean_poses(rows: DataFrame, by: str) -> DataFrame:
    """(by, n, tx..qw): the mean translation, and the rotation of least summed squared chordal distance.

    A group's quaternions enter through the ten sums of their outer products; the rotation is
    the eigenvector of the greatest eigenvalue, its scalar part not negative.
    """
    q = ("qx", "qy", "qz", "qw")
    upper = [(a, b) for k, a in enumerate(q) for b in q[k:]]
    sums = rows.groupBy(by).agg(F.count(F.lit(1)).alias("n"), *[F.avg(f"t{x}").alias(f"t{x}") for x in AXES], *[F.sum(F.col(a) * F.col(b)).alias(f"{a}{b}") for a, b in upper])
    kind = rows.schema[by].dataType.simpleString()

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            m = np.zeros((len(b), 4, 4))
            for x, y in upper:
                m[:, q.index(x), q.index(y)] = m[:, q.index(y), q.index(x)] = b[x + y]
            v = np.linalg.eigh(m)[1][:, :, -1] if len(b) else np.zeros((0, 4))
            v = v * np.where(v[:, 3:] < 0, -1.0, 1.0)
            yield b[[by, "n", "tx", "ty", "tz"]].assign(**{name: v[:, k] for k, name in enumerate(q)})

    return sums.mapInPandas(solve, f"{by} {kind}, n long, tx double, ty double, tz double, " + ", ".join(f"{x} double" for x in q))
