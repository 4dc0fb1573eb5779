"""Grouped reductions by index, dense outputs, and sparse block algebra over (i, j, row, col, x) rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def dense(reduced: DataFrame, index: str, slots: DataFrame, values: list[str]) -> DataFrame:
    """One row for every slot; slots without a group hold nought."""
    return slots.join(reduced, index, "left").select(index, *[F.coalesce(v, F.lit(0)).alias(v) for v in values])


def scatter_mean(rows: DataFrame, index: str, value: Column, integral: bool = False) -> DataFrame:
    """Mean by index; of integers it is rounded down."""
    mean = F.floor(F.sum(value) / F.count(value)) if integral else F.sum(value) / F.count(value)
    return rows.groupBy(index).agg(mean.alias("mean"))


def block_add(a: DataFrame, b: DataFrame, minus: bool = False) -> DataFrame:
    """Sum (or difference) of two block matrices; entries met in one or both are summed."""
    b = b.withColumn("x", -F.col("x")) if minus else b
    return a.unionByName(b).groupBy("i", "j", "row", "col").agg(F.sum("x").alias("x"))


def block_matmul(a: DataFrame, b: DataFrame) -> DataFrame:
    """Product of block matrices: entries meet on the inner block and column, then sum."""
    left = a.select("i", F.col("j").alias("k"), "row", F.col("col").alias("m"), F.col("x").alias("xa"))
    right = b.select(F.col("i").alias("k"), "j", F.col("row").alias("m"), "col", F.col("x").alias("xb"))
    return left.join(right, ["k", "m"]).groupBy("i", "j", "row", "col").agg(F.sum(F.col("xa") * F.col("xb")).alias("x"))


def transpose(a: DataFrame) -> DataFrame:
    return a.select(F.col("j").alias("i"), F.col("i").alias("j"), F.col("col").alias("row"), F.col("row").alias("col"), "x")


def block_matvec(a: DataFrame, v: DataFrame) -> DataFrame:
    """Product with a block vector (i, row, x)."""
    inner = v.select(F.col("i").alias("j"), F.col("row").alias("col"), F.col("x").alias("xv"))
    return a.join(inner, ["j", "col"]).groupBy("i", "row").agg(F.sum(F.col("x") * F.col("xv")).alias("x"))


def dense_number(ids: DataFrame, column: str, out: str, width: int = 1024) -> DataFrame:
    """Distinct whole numbers of ``column`` numbered from 0 in order.

    Values are cut into ranges of ``width``; ranks within a range follow the counts of the
    ranges before, so that only one row a range passes through the ordered running sum.
    """
    cut = ids.select(column).distinct().withColumn("__range", F.floor(F.col(column) / width))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = cut.groupBy("__range").agg(F.count(F.lit(1)).alias("__n")).withColumn("__start", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    within = F.row_number().over(Window.partitionBy("__range").orderBy(column)) - 1
    return cut.withColumn("__k", within).join(starts, "__range").select(column, (F.col("__start") + F.col("__k")).cast("long").alias(out))


def numbered(rows: DataFrame, by: str, part: Column, order: list[Column], out: str) -> DataFrame:
    """``rows`` numbered from 0 within ``by`` in ``order``, of which ``part`` is a coarser form: days of times, prefixes of names.

    Rows are numbered within their part, after the counts of the parts before, so that one
    row a part passes through the step over all of ``by``. Null keys form one group.
    """
    cut = rows.withColumn("__part", part)
    before = Window.partitionBy(by).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = cut.groupBy(by, "__part").agg(F.count(F.lit(1)).alias("__n"))
    starts = starts.select(F.col(by).alias("__by"), F.col("__part").alias("__at"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    within = F.row_number().over(Window.partitionBy(by, "__part").orderBy(*order)) - 1
    same = F.col(by).eqNullSafe(F.col("__by")) & F.col("__part").eqNullSafe(F.col("__at"))
    return cut.withColumn("__k", within).join(starts, same).withColumn(out, (F.col("__start") + F.col("__k")).cast("long")).drop("__part", "__k", "__by", "__at", "__start")
