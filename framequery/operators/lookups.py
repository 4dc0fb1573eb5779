"""Joins that match rows by order, range or distance rather than by equality."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import ranges
from .written import written


def as_of(left: DataFrame, right: DataFrame, by: str, order: list[str], take: str, out: str) -> DataFrame:
    """For each row of ``left`` the ``take`` of the last row of ``right`` at or before it within ``by``; null if none.

    Both sides are stacked and sorted by ranges, and the last value is carried along: no pairing
    of rows and no key in one task. At equal times rows of ``right`` come first.
    """
    columns = left.columns
    side, value = "__side", "__value"
    rows = left.select(*columns, F.lit(1).alias(side), F.lit(None).cast(right.schema[take].dataType).alias(value))
    marks = right.select(*[F.col(c) if c in (by, *order) else F.lit(None).cast(left.schema[c].dataType).alias(c) for c in columns], F.lit(0).alias(side), F.col(take).alias(value))
    found = ranges.last_value(rows.unionByName(marks), [by], [*map(F.col, order), F.col(side)], value, out)
    return found.where(F.col(side) == 1).select(*columns, out)


def _squared(axes: tuple[str, ...]) -> Column:
    return sum(((F.col(f"q_{a}") - F.col(f"p_{a}")) * (F.col(f"q_{a}") - F.col(f"p_{a}")) for a in axes), F.lit(0.0))


def k_nearest(queries: DataFrame, points: DataFrame, k: int, cell: float, axes: tuple[str, ...] = ("x", "y", "z"), by: tuple[str, ...] = (), salts: int = 1) -> DataFrame:
    """(by, q_id, rank, p_id, d2): up to ``k`` nearest points within ``cell``, of equal ``by``, ties to smaller ids.

    Space is cut into cells; a query meets only points of its own and the adjoining cells,
    by an equi-join on the cell. Points may be dealt to ``salts`` parts, each of which finds
    its own ``k`` first.
    """
    at = lambda p, a: F.floor(F.col(f"{p}{a}") / cell).cast("long")
    near = queries.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    for a in axes:
        near = near.withColumn(f"__c{a}", F.explode(F.array(*[at("q_", a) + d for d in (-1, 0, 1)])))
    here = points.select("*", F.pmod(F.xxhash64("p_id"), F.lit(salts)).alias("__salt"), *[at("p_", a).alias(f"__c{a}") for a in axes])
    met = near.join(here, [*by, "__salt", *[f"__c{a}" for a in axes]]).withColumn("d2", _squared(axes)).where(F.col("d2") <= cell**2)
    ranked = lambda rows, *more: rows.withColumn("rank", F.row_number().over(Window.partitionBy(*by, "q_id", *more).orderBy("d2", "p_id"))).where(F.col("rank") <= k)
    best = ranked(ranked(met, "__salt")) if salts > 1 else ranked(met)
    return best.select(*by, "q_id", "rank", "p_id", "d2")


def _fitting(points: DataFrame, k: int, cell: float, axes: tuple[str, ...], by: tuple[str, ...]) -> float:
    """A cell no wider than ``cell`` that holds, as a point sees it, at most eight times ``k`` points.

    Each try counts the points of all cells, of which one row comes back.
    """
    for _ in range(8):
        own = points.groupBy(*by, *[F.floor(F.col(f"p_{a}") / cell).alias(f"__c{a}") for a in axes]).agg(F.count(F.lit(1)).cast("double").alias("n"))
        met = own.agg((F.sum(F.col("n") * F.col("n")) / F.sum("n")).alias("met")).first()["met"]
        if met is None or met <= 8 * k:
            break
        cell *= max(0.05, (4 * k / met) ** (1 / len(axes)))
    return cell


def k_nearest_whole(queries: DataFrame, points: DataFrame, k: int, cell: float, axes: tuple[str, ...] = ("x", "y", "z"), by: tuple[str, ...] = (), dense: bool = False) -> DataFrame:
    """(by, q_id, rank, p_id, d2): the ``k`` nearest points of equal ``by`` at any distance (all, if fewer), ties to smaller ids.

    Queries whose k-th neighbour isn't within a cell go on to cells four times wider, until
    none is left or a cell is wider than all there is. Only queries far from most points
    come that far; wide cells hold many points and are dealt to several tasks. Where points may
    be ``dense``, the first cell is narrowed until it holds few, cells grow twofold, and of points
    at one place only the ``k`` of smallest ids are met, as no other can be among the nearest.
    """
    if dense:
        place = Window.partitionBy(*by, *[f"p_{a}" for a in axes]).orderBy("p_id")
        points = written(points.withColumn("__n", F.row_number().over(place)).where(F.col("__n") <= k).drop("__n"), "points")
        cell = _fitting(points, k, cell, axes, by)
    span = lambda rows, side: rows.agg(*[f(f"{side}_{a}") for a in axes for f in (F.min, F.max)]).first()
    both = [(x, y) for x, y in zip(span(queries, "q"), span(points, "p"), strict=True) if x is not None and y is not None]
    reach = sum((max(hi) - min(lo)) ** 2 for lo, hi in zip(both[::2], both[1::2], strict=True)) ** 0.5
    found, left, wide, salts = None, queries, cell, 1
    while True:
        near = written(k_nearest(left, points, k, wide, axes, by, salts), "near")
        last = wide >= reach
        proven = near.where(F.col("rank") == k).select(*by, "q_id")
        done = near if last else near.join(proven, [*by, "q_id"], "left_semi").select(near.columns)
        found = done if found is None else found.unionByName(done)
        if last:
            return found
        left = written(left.join(proven, [*by, "q_id"], "left_anti").select(queries.columns), "left")
        if left.isEmpty():
            return found
        wide, salts = (2 if dense else 4) * wide, min(64, 2 * salts)


#: Distances held at once by a task of nearest_lists().
_AT_ONCE = 1 << 20


def _parts(column: pa.Array) -> tuple[np.ndarray, dict[str, pa.Array]]:
    """Where each row's list of structs ends, from 0 on, and the fields of all."""
    flat = column.flatten()
    offsets = column.offsets.to_numpy()
    return offsets - offsets[0], {f.name: x for f, x in zip(flat.type, flat.flatten(), strict=True)}


def _nearest(b: pa.RecordBatch, k: int, cell: float, axes: tuple[str, ...]) -> pa.RecordBatch:
    """The last two columns' lists of queries and points as one row a query with its nearest within ``cell``."""
    (q_ends, asks), (p_ends, held) = _parts(b.column(b.num_columns - 2)), _parts(b.column(b.num_columns - 1))
    wide = lambda x: x.to_numpy(zero_copy_only=False).astype(float)
    q, p = [wide(asks[f"q_{a}"]) for a in axes], [wide(held[f"p_{a}"]) for a in axes]
    ids = held["p_id"].to_numpy(zero_copy_only=False)
    found, far, sizes = [np.zeros(0, np.int64)], [np.zeros(0)], [np.zeros(0, np.int64)]
    for row in range(b.num_rows):
        own = p_ends[row] + np.argsort(ids[p_ends[row] : p_ends[row + 1]], kind="stable")
        step = max(1, _AT_ONCE // len(own))
        for lo in range(q_ends[row], q_ends[row + 1], step):
            some = slice(lo, min(lo + step, q_ends[row + 1]))
            d2 = sum(((x[some, None] - y[own]) ** 2 for x, y in zip(q, p, strict=True)), 0.0)
            best = np.argsort(d2, axis=1, kind="stable")[:, :k]  # ties stay by id
            d2 = np.take_along_axis(d2, best, 1)
            within = d2 <= cell**2
            found.append(own[best[within]])
            far.append(d2[within])
            sizes.append(within.sum(1))
    at, fields = pa.array(np.concatenate(found)), [n for n in held if not any(n == f"p_{a}" for a in axes)]
    near = pa.StructArray.from_arrays([pa.array(np.concatenate(far)), *[held[n].take(at) for n in fields]], names=["d2", *fields])
    ends = np.append(0, np.cumsum(np.concatenate(sizes))).astype(np.int32)
    back = pa.array(np.repeat(np.arange(b.num_rows), np.diff(q_ends)))
    columns = {n: b.column(n).take(back) for n in b.schema.names[:-2]}
    return pa.RecordBatch.from_pydict(columns | {"q_id": asks["q_id"], "near": pa.ListArray.from_arrays(pa.array(ends), near)})


def nearest_lists(queries: DataFrame, points: DataFrame, k: int, cell: float, axes: tuple[str, ...], by: tuple[str, ...], take: tuple[str, ...] = ()) -> DataFrame:
    """(by, q_id, near): the ``k`` nearest points of equal ``by`` at any distance (all, if fewer), a list of (d2, p_id, take) nearest first, ties to smaller ids.

    For pixels, of which a cell holds a bounded number. Queries and points go to their cell as
    one list each, points to the adjoining cells too where queries lie there, and lists meet
    once; a query without any point of its ``by`` gives no row. Queries whose k-th neighbour isn't within a cell go
    on in k_nearest_whole(), unless a cell is wider than all there is.
    """
    cells = [f"__c{a}" for a in axes]
    span = lambda rows, side: rows.agg(*[f(f"{side}_{a}").cast("double") for a in axes for f in (F.min, F.max)]).first()
    asked, there = span(queries, "q"), span(points, "p")
    both = [(x, y) for x, y in zip(asked, there, strict=True) if x is not None and y is not None]
    reach = sum((max(hi) - min(lo)) ** 2 for lo, hi in zip(both[::2], both[1::2], strict=True)) ** 0.5
    at = lambda side: [F.floor(F.col(f"{side}_{a}") / cell).cast("long").alias(c) for a, c in zip(axes, cells, strict=True)]
    own = queries.groupBy(*by, *at("q")).agg(F.collect_list(F.struct("q_id", *[f"q_{a}" for a in axes])).alias("asks"))
    held = points.groupBy(*by, *at("p")).agg(F.collect_list(F.struct("p_id", *[f"p_{a}" for a in axes], *take)).alias("held"))
    if len(both) == 2 * len(axes) and any(lo // cell != hi // cell for lo, hi in [(min(lo), max(hi)) for lo, hi in zip(both[::2], both[1::2], strict=True)]):
        for n, c in enumerate(cells):
            lo, hi = (F.lit(int(x // cell)) for x in asked[2 * n : 2 * n + 2])
            held = held.where(F.col(c).between(lo - 1, hi + 1)).withColumn(c, F.explode(F.sequence(F.greatest(F.col(c) - 1, lo), F.least(F.col(c) + 1, hi))))
        held = held.groupBy(*by, *cells).agg(F.flatten(F.collect_list("held")).alias("held"))
    met = own.join(held, [*by, *cells]).select(*by, "asks", "held")
    kind = lambda rows, names: ", ".join(f"{n}: {rows.schema[n].dataType.simpleString()}" for n in names)
    schema = f"struct<{kind(queries, [*by, 'q_id'])}, near: array<struct<d2: double, {kind(points, ['p_id', *take])}>>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield _nearest(b, k, cell, axes)

    near = met.mapInArrow(run, schema)
    if cell >= reach:
        return near
    near = written(near, "near")
    proven = near.where(F.size("near") == k)
    left = queries.join(proven.select(*by, "q_id"), [*by, "q_id"], "left_anti").select(queries.columns)
    rest = k_nearest_whole(left, points, k, 4 * cell, axes, by).join(points.select(*by, "p_id", *take), [*by, "p_id"])
    return proven.unionByName(rest.groupBy(*by, "q_id").agg(F.sort_array(F.collect_list(F.struct("d2", "p_id", *take))).alias("near")))


def in_range(rows: DataFrame, low: Column, high: Column, out: str) -> DataFrame:
    """Each row once for every whole number from ``low`` to ``high``, for an equi-join to follow; none if low > high."""
    return rows.where(low <= high).withColumn(out, F.explode(F.sequence(low, high)))
