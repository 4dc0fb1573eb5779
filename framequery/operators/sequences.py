"""Ordered analytics of streams: folds, overlapping windows, keyframe selection, and its streaming twin."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def smoothed(rows: DataFrame, by: str, order: str, value: Column, decay: float, out: str, block: int = 256, position: Column | None = None) -> DataFrame:
    """Exponential moving average along ``order``: the first value, then decay * before + (1 - decay) * value.

    A stream is cut into blocks of positions, each of which folds on its own from nought;
    what comes before a block enters with the decay of its distance, from as many blocks back
    as a double can tell. ``position`` numbers a stream's rows from 0 without gaps; where it
    isn't given they are numbered here, which sorts each stream in one task.
    """
    number = position if position is not None else F.row_number().over(Window.partitionBy(by).orderBy(order)) - 1
    first = F.col("__n") == 0
    # each value weighed by its power of the decay inside its block; the first stands for all before it
    rows = rows.withColumn("__n", number).withColumn("__x", value)
    rows = rows.withColumn("__b", F.floor(F.col("__n") / block)).withColumn("__k", F.col("__n") % block)
    gain = F.when(first, F.col("__x")).otherwise((1 - decay) * F.col("__x"))
    inside = Window.partitionBy(by, "__b").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("__own", F.sum(gain * F.pow(F.lit(decay), -F.col("__k"))).over(inside) * F.pow(F.lit(decay), F.col("__k")))
    ends = rows.groupBy(by, "__b").agg(F.max_by("__own", "__k").alias("__end"), F.max("__k").alias("__last"))
    back = max(1, ceil(18 * log(10) / (-log(decay) * block)))
    held = F.sort_array(F.collect_list(F.struct("__b", "__end", "__last")).over(Window.partitionBy(by).orderBy("__b").rowsBetween(-back, -1)))
    carried = ends.select(by, "__b", F.aggregate(held, F.lit(0.0), lambda a, x: a * F.pow(F.lit(decay), x["__last"] + 1) + x["__end"]).alias("__in"))
    joined = rows.join(carried, [by, "__b"])
    return joined.withColumn(out, F.col("__own") + F.col("__in") * F.pow(F.lit(decay), F.col("__k") + 1)).drop("__n", "__x", "__b", "__k", "__own", "__in")


def window_of(frame: Column, length: int, overlap: int) -> Column:
    """Numbers of the windows that hold a frame: window w has frames w * (length - overlap) and on."""
    stride = length - overlap
    last = F.floor(frame / stride).cast("long")
    first = F.greatest(F.lit(0).cast("long"), F.ceil((frame - length + 1) / stride).cast("long"))
    return F.sequence(first, last)


def blended(rows: DataFrame, by: str, frame: str, window: str, value: Column, length: int, overlap: int, out: str) -> DataFrame:
    """One value a frame from the one or two windows that hold it.

    In an overlap the later window's weight rises in equal steps that stop short of nought
    and one.
    """
    stride = length - overlap
    place = F.col(frame) - F.col(window) * stride
    rising = (place + 1) / (overlap + 1)
    weight = F.when((F.col(window) > 0) & (place < overlap), rising).otherwise(F.when(place >= stride, 1 - (place - stride + 1) / (overlap + 1)).otherwise(1.0))
    weighed = rows.withColumn("__w", weight).withColumn("__x", value)
    return weighed.groupBy(by, frame).agg((F.sum(F.col("__x") * F.col("__w")) / F.sum("__w")).alias(out))


def select_keyframes(rows: DataFrame, by: str, order: str, value: str, threshold: float) -> DataFrame:
    """(by, order) of the frames that move more than ``threshold`` from the last frame taken.

    The first frame of a stream is taken, and its last. Each choice rests on the one before,
    so a stream is walked in order; streams are spread over the cluster and a walk keeps one
    number, reading its frames batch by batch.
    """
    fields = rows.select(by, order).schema

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, reference, previous, taken = None, 0.0, None, False
        for b in batches:
            found = []
            for k, n, x in zip(b[by].tolist(), b[order].tolist(), b[value].tolist(), strict=True):
                if k != key:
                    if previous is not None and not taken:
                        found.append((key, previous))
                    key, reference, taken = k, x, True
                    found.append((k, n))
                elif taken := abs(x - reference) > threshold:
                    reference = x
                    found.append((k, n))
                previous = n
            yield pd.DataFrame(found, columns=[by, order])
        if previous is not None and not taken:
            yield pd.DataFrame([(key, previous)], columns=[by, order])

    return rows.select(by, order, value).repartition(by).sortWithinPartitions(by, order).mapInPandas(walk, fields)
