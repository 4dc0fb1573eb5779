"""Greedy suppression of overlapping boxes in rounds, with exactly the sequential result.

A box can only be suppressed by a better one that overlaps it by more than the threshold;
pairs that do meet through cells of a grid as wide as the boxes are. Then every undecided box without
an undecided better neighbour is kept and its neighbours go, all at once, until none is left:
what a walk in order of score would keep, without any large group in one task. Groups of few
boxes are walked, as one list each.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .written import written

_SIDES = ("x0", "y0", "x1", "y1")
#: The most boxes of a group that is walked.
TOGETHER = 512


def overlap(a: str, b: str) -> Column:
    """Intersection over union of two boxes with the column prefixes; 0 where neither has an area."""
    of = lambda p: [F.col(f"{p}{s}") for s in _SIDES]
    (ax0, ay0, ax1, ay1), (bx0, by0, bx1, by1) = of(a), of(b)
    both = F.greatest(F.least(ax1, bx1) - F.greatest(ax0, bx0), F.lit(0.0)) * F.greatest(F.least(ay1, by1) - F.greatest(ay0, by0), F.lit(0.0))
    union = (ax1 - ax0) * (ay1 - ay0) + (bx1 - bx0) * (by1 - by0) - both
    return F.when(union > 0, both / union).otherwise(0.0)


def neighbours(boxes: DataFrame, by: str, threshold: float) -> DataFrame:
    """(by, better, worse): pairs of boxes that overlap by more than ``threshold``, the one of higher score, or smaller id, first.

    Boxes that overlap by more than a positive share differ in width by no more than its
    inverse, so a box goes to a grid of the power of two above its width, and looks into those
    within that factor: at most four cells of each hold it.
    """
    wide = lambda: F.ceil(F.log2(F.greatest(F.col("x1") - F.col("x0"), F.lit(1e-9)))).cast("int")
    apart = 0
    while 2.0**-apart > max(threshold, 1e-6):
        apart += 1
    own = boxes.select(by, "id", "score", *_SIDES, wide().alias("level"))
    cells = lambda lo, hi, level: F.sequence(F.floor(F.col(lo) / F.pow(F.lit(2.0), level)).cast("long"), F.floor(F.col(hi) / F.pow(F.lit(2.0), level)).cast("long"))
    # the left edge's column decides on one side, all columns that a box reaches on the other
    held = own.select(by, "level", F.floor(F.col("x0") / F.pow(F.lit(2.0), F.col("level"))).cast("long").alias("cell"), F.col("id").alias("a_id"), F.col("score").alias("a_score"), *[F.col(s).alias(f"a_{s}") for s in _SIDES])
    asks = own.select(by, F.explode(F.sequence(F.col("level") - apart, F.col("level") + apart)).alias("level"), F.col("id").alias("b_id"), F.col("score").alias("b_score"), *[F.col(s).alias(f"b_{s}") for s in _SIDES])
    reach = F.pow(F.lit(2.0), F.col("level"))
    asks = asks.withColumn("lo", F.col("b_x0") - reach).withColumn("cell", F.explode(cells("lo", "b_x1", F.col("level"))))
    met = asks.drop("lo").join(held, [by, "level", "cell"]).where((F.col("a_id") != F.col("b_id")) & (overlap("a_", "b_") > threshold))
    first = (F.col("a_score") > F.col("b_score")) | ((F.col("a_score") == F.col("b_score")) & (F.col("a_id") < F.col("b_id")))
    return met.select(by, F.when(first, F.col("a_id")).otherwise(F.col("b_id")).alias("better"), F.when(first, F.col("b_id")).otherwise(F.col("a_id")).alias("worse")).distinct()


def _walked(score: np.ndarray, ids: np.ndarray, sides: list[np.ndarray], threshold: float) -> np.ndarray:
    """The places of the boxes of one group that a walk from the highest score down keeps."""
    order = np.lexsort((ids, -score, ~np.isnan(score)))  # NaN is the highest, as in Spark
    x0, y0, x1, y1 = (s[order] for s in sides)
    least, greatest = np.minimum.outer, np.maximum.outer
    both = np.maximum(least(x1, x1) - greatest(x0, x0), 0.0) * np.maximum(least(y1, y1) - greatest(y0, y0), 0.0)
    area = (x1 - x0) * (y1 - y0)
    union = area[:, None] + area - both
    over = np.divide(both, union, out=np.zeros_like(both), where=union > 0) > threshold
    kept = np.ones(len(order), bool)
    for k in range(len(order)):
        if kept[k]:
            kept[k + 1 :] &= ~over[k, k + 1 :]
    return order[kept]


def _small(boxes: DataFrame, by: str, threshold: float) -> DataFrame:
    """suppressed() of groups that each fit a task as a list."""
    names = boxes.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ends, rows = b.column(0).offsets.to_numpy(), b.column(0).flatten()
            ends, fields = ends - ends[0], dict(zip([f.name for f in rows.type], rows.flatten(), strict=True))
            number = lambda n: fields[n].to_numpy(zero_copy_only=False)
            score, ids, sides = number("score").astype(float), number("id"), [number(s).astype(float) for s in _SIDES]
            with np.errstate(invalid="ignore", over="ignore"):
                kept = [lo + _walked(score[lo:hi], ids[lo:hi], [s[lo:hi] for s in sides], threshold) for lo, hi in zip(ends[:-1], ends[1:], strict=True)]
            at = pa.array(np.concatenate([np.zeros(0, np.int64), *kept]))
            yield pa.RecordBatch.from_arrays([fields[c].take(at) for c in names], names=names)

    return boxes.groupBy(by).agg(F.collect_list(F.struct(*boxes.columns)).alias("rows")).select("rows").mapInArrow(run, boxes.schema)


def suppressed(boxes: DataFrame, by: str, threshold: float = 0.7) -> DataFrame:
    """The rows of (by, id, score, x0, y0, x1, y1, ...) that greedy suppression keeps, all columns as they were.

    Boxes go from the highest score down, ties by smaller id; each that overlaps none kept
    before by more than ``threshold`` is kept. Ids are unique within ``by``. Rows with a null among
    those columns, or with a negative width or height, are left out. Groups of at most TOGETHER boxes are
    walked in a task each; the number of rounds of larger ones is the longest chain of ever worse
    boxes that overlap one another.
    """
    good = boxes.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in (by, "id", "score", *_SIDES)]) & (F.col("x1") >= F.col("x0")) & (F.col("y1") >= F.col("y0")))
    large = written(good.groupBy(by).count().where(F.col("count") > TOGETHER).select(by), "large")
    if large.isEmpty():
        return _small(good, by, threshold)
    return _small(good.join(large, by, "left_anti"), by, threshold).unionByName(_in_rounds(good.join(large, by, "left_semi"), by, threshold)).select(boxes.columns)


def _in_rounds(good: DataFrame, by: str, threshold: float) -> DataFrame:
    """suppressed() of groups of any size."""
    alone = written(good.select(by, "id", F.col("score").cast("double").alias("score"), *_SIDES), "boxes")
    if threshold < 1:
        # of boxes with equal sides only the best can stay; no pairs among them
        area = (F.col("x1") > F.col("x0")) & (F.col("y1") > F.col("y0"))
        best = alone.where(area).groupBy(by, *_SIDES).agg(F.max(F.struct("score", (-F.col("id")).alias("less"))).alias("b"))
        alone = written(alone.where(~area).unionByName(best.select(by, (-F.col("b.less")).alias("id"), "b.score", *_SIDES)), "boxes")
    pairs = written(neighbours(alone, by, threshold), "pairs")
    left, kept = alone.select(by, "id"), []
    while not left.isEmpty():
        # a box waits while a better neighbour is undecided
        waits = pairs.select(by, F.col("worse").alias("id")).distinct()
        now = written(left.join(waits, [by, "id"], "left_anti"), "kept")
        kept.append(now)
        gone = pairs.join(now.withColumnRenamed("id", "better"), [by, "better"], "left_semi").select(by, F.col("worse").alias("id")).distinct()
        left = written(left.join(now, [by, "id"], "left_anti").join(gone, [by, "id"], "left_anti"), "left")
        both = left.withColumnRenamed("id", "better"), left.withColumnRenamed("id", "worse")
        pairs = written(pairs.join(both[0], [by, "better"], "left_semi").join(both[1], [by, "worse"], "left_semi").select(by, "better", "worse"), "pairs")
    return good.join(reduce(DataFrame.unionByName, kept), [by, "id"], "left_semi").select(good.columns) if kept else good.limit(0)
