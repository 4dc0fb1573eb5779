"""Samples of images at moving places, where the image isn't a plane."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows and columns of a panorama's block.
BLOCK = 8


def panorama_sampled(asked: DataFrame, panorama: DataFrame, by: str, value: str, height: int, width: int) -> DataFrame:
    """``asked`` (by, u, w, ...) with ``value``, bilinear between the pixel centres of (by, pr, pc, value) panoramas.

    u and w run from 0 to 1 over a panorama's width and height. Left and right edges meet;
    above the first and below the last row of centres these stand for themselves. Pixels go as lists to
    blocks of BLOCK by BLOCK, those that a block's last row and column look across to besides, so a place meets
    its four in one row of its block. A place whose pixels aren't all there counts the others as nought, and null
    or non-finite places give null. Where a pixel is given twice, both count.
    """
    x, y = F.col("u") * width - 0.5, F.col("w") * height - 0.5
    fine = F.col("u").isNotNull() & F.col("w").isNotNull() & (F.abs("u") < 1e9) & (F.abs("w") < 1e9) & ~F.isnan("u") & ~F.isnan("w")
    column = lambda a: F.pmod(F.floor(x) + a, F.lit(width)).cast("long")
    row = lambda b: F.greatest(F.lit(0), F.least(F.lit(height - 1), F.floor(y) + b)).cast("long")
    block = lambda c: F.floor(c / BLOCK).cast("long")
    fine = F.coalesce(fine, F.lit(False))
    # places that are nowhere meet nothing, spread over negative blocks
    nowhere = -1 - F.pmod(F.xxhash64(*asked.columns), F.lit(1024))
    places = asked.select("*", F.when(fine, block(row(0))).otherwise(nowhere).alias("__br"), F.when(fine, block(column(0))).otherwise(nowhere).alias("__bc"))
    # of the blocks of a pixel and of the one before it, which may be the same
    both = lambda c, before: F.explode(F.array_distinct(F.array(block(c), block(before))))
    dealt = panorama.select(F.col(by).alias("__by"), (F.col("pr") * width + F.col("pc")).cast("long").alias("at"), F.coalesce(F.col(value).cast("double"), F.lit(0.0)).alias("v"), "pr", "pc")
    dealt = dealt.withColumn("__pr", both(F.col("pr"), F.greatest(F.lit(0), F.col("pr") - 1))).withColumn("__pc", both(F.col("pc"), F.pmod(F.col("pc") - 1, F.lit(width))))
    lists = dealt.groupBy("__by", "__pr", "__pc").agg(F.collect_list(F.struct("at", "v")).alias("l"))
    # a pixel given twice counts with its sum
    once = F.array_distinct(F.col("l.at"))
    summed = F.transform(once, lambda k: F.aggregate(F.filter("l", lambda e: e["at"] == k), F.lit(0.0), lambda s, e: s + e["v"]))
    lists = lists.select("__by", "__pr", "__pc", once.alias("__at"), F.when(F.size(once) < F.size("l"), summed).otherwise(F.col("l.v")).alias("__v"))
    met = places.join(lists, (F.col(by) == F.col("__by")) & (F.col("__br") == F.col("__pr")) & (F.col("__bc") == F.col("__pc")), "left")
    # a pixel that isn't there has position 0, and get() gives null below 0
    pixel = lambda a, b: F.coalesce(F.get("__v", F.array_position("__at", row(b) * width + column(a)).cast("int") - 1), F.lit(0.0))
    share = lambda a, b: (x - F.floor(x) if a else 1 - x + F.floor(x)) * (y - F.floor(y) if b else 1 - y + F.floor(y))
    total = sum((share(a, b) * pixel(a, b) for a in (0, 1) for b in (0, 1)), F.lit(0.0))
    return met.select(*asked.columns, F.when(fine, total).alias(value))
