"""Order over whole groups without a group in one task: numbers, running sums, last values, quantiles.

Rows are sorted once by ranges of (group, order) into written files whose numbers follow the
order. Inside a file a window does the work; what comes before it enters as one small row a
file and group, carried along the files. Quantiles need no order: counts of cells close in on
the value of each rank.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .written import new_path, written

_PART, _ROW = "__part", "__row"
#: Cells that an interval is cut into a round.
CELLS = 1024


def placed(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """``rows`` sorted by ranges, with the number of their file and their row in it, which follow (keys, order)."""
    path = new_path(rows.sparkSession, "ranges")
    by = [F.col(k).asc_nulls_first() for k in keys] + order
    rows.repartitionByRange(*by).sortWithinPartitions(*by).write.option("maxRecordsPerFile", 0).parquet(path)
    part = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("long").alias(_PART)
    return rows.sparkSession.read.schema(rows.schema).parquet(path).select("*", part, F.col("_metadata.row_index").alias(_ROW))


def _met(files: DataFrame, carried: DataFrame, keys: list[str]) -> DataFrame:
    """Rows beside what is carried into their file and group."""
    named = carried.withColumnsRenamed({k: f"__at{n}" for n, k in enumerate([_PART, *keys])})
    same = F.col(_PART) == F.col("__at0")
    for n, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__at{n + 1}"))
    return files.join(named, same)


def _before(keys: list[str]) -> Window:
    # one row a file and group; without keys, one a file
    return Window.partitionBy(*keys).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)


def numbered(rows: DataFrame, keys: list[str], order: list[Column], out: str) -> DataFrame:
    """``rows`` numbered from 0 in each group of ``keys`` (null keys are a group) by ``order``, ties in any order."""
    files = placed(rows, keys, order)
    counts = files.groupBy(_PART, *keys).agg(F.count(F.lit(1)).alias("__n"), F.min(_ROW).alias("__first"))
    starts = counts.withColumn("__start", F.coalesce(F.sum("__n").over(_before(keys)), F.lit(0))).drop("__n")
    number = (F.col("__start") + F.col(_ROW) - F.col("__first")).cast("long")
    return _met(files, starts, keys).select(*rows.columns, number.alias(out))


def running_sum(rows: DataFrame, keys: list[str], order: list[Column], value: str, out: str) -> DataFrame:
    """``rows`` with the sum of ``value`` over the rows before each in its group, 0 at the first; nulls add nothing."""
    files = placed(rows, keys, order)
    total = F.coalesce(F.sum(value), F.lit(0))
    starts = files.groupBy(_PART, *keys).agg(total.alias("__n")).withColumn("__start", F.coalesce(F.sum("__n").over(_before(keys)), F.lit(0))).drop("__n")
    inside = Window.partitionBy(_PART, *keys).orderBy(_ROW).rowsBetween(Window.unboundedPreceding, -1)
    summed = files.withColumn("__inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return _met(summed, starts, keys).select(*rows.columns, (F.col("__start") + F.col("__inside")).alias(out))


def last_value(rows: DataFrame, keys: list[str], order: list[Column], value: str, out: str) -> DataFrame:
    """``rows`` with the last ``value`` that isn't null at or before each in its group; null if there is none."""
    files = placed(rows, keys, order)
    ends = files.groupBy(_PART, *keys).agg(F.max_by(value, F.when(F.col(value).isNotNull(), F.col(_ROW))).alias("__end"))
    carried = ends.withColumn("__in", F.last("__end", ignorenulls=True).over(_before(keys))).drop("__end")
    inside = Window.partitionBy(_PART, *keys).orderBy(_ROW).rowsBetween(Window.unboundedPreceding, 0)
    own = files.withColumn("__own", F.last(value, ignorenulls=True).over(inside))
    return _met(own, carried, keys).select(*rows.columns, F.coalesce("__own", "__in").alias(out))


def quantiles(rows: DataFrame, by: str, value: str, shares: list[float]) -> DataFrame:
    """(by, share, value): exact quantiles of each group, between ranks by linear interpolation; nulls and NaN don't count.

    A rank's value lies in an interval, at first the group's whole range. Each round counts the
    rows in CELLS parts of every open interval, map-side first, and goes on with the part that
    holds the rank, narrowed to the least and greatest value in it, until these agree: a few
    rounds, in which no row moves. Null groups count as one. A group without values is left out.
    """
    data = rows.select(F.col(by).alias("k"), F.col(value).cast("double").alias("x")).where("x is not null and not isnan(x)")
    spans = data.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
    at = F.explode(F.array(*[F.lit(float(s)) for s in shares]))
    ranks = spans.select("*", at.alias("share")).withColumn("place", (F.col("n") - 1) * F.col("share"))
    state = ranks.select("k", "share", "lo", "hi", F.lit(0).cast("long").alias("below"), (F.col("place") - F.floor("place")).alias("part"), F.explode(F.array_distinct(F.array(F.floor("place"), F.ceil("place")))).alias("rank"))
    state = written(state, "ranks")
    while not state.where("lo < hi").isEmpty():
        open_ = state.where("lo < hi").select(F.col("k").alias("g"), "lo", "hi", "below").distinct()
        # half the range first, as the whole may not fit a double
        cell = F.least(F.lit(CELLS - 1), F.floor((F.col("x") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2) * CELLS))
        met = data.join(open_, F.col("k").eqNullSafe(F.col("g")) & F.col("x").between(F.col("lo"), F.col("hi")))
        cells = met.groupBy("g", "lo", "hi", cell.alias("cell")).agg(F.count(F.lit(1)).alias("m"), F.min("x").alias("least"), F.max("x").alias("most"), F.first("below").alias("under"))
        upto = Window.partitionBy("g", "lo", "hi").orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
        cells = cells.withColumn("after", F.col("under") + F.sum("m").over(upto)).withColumn("start", F.col("after") - F.col("m"))
        same = F.col("k").eqNullSafe(F.col("g")) & (F.col("s.lo") == F.col("c.lo")) & (F.col("s.hi") == F.col("c.hi")) & (F.col("rank") >= F.col("start")) & (F.col("rank") < F.col("after"))
        closer = state.where("lo < hi").alias("s").join(cells.alias("c"), same).select("k", "share", F.col("least").alias("lo"), F.col("most").alias("hi"), F.col("start").alias("below"), "part", "rank")
        state = written(closer.unionByName(state.where("lo = hi")), "ranks")
    ends = state.groupBy("k", "share").agg(F.min("lo").alias("lo"), F.max("lo").alias("hi"), F.first("part").alias("part"))
    return ends.select(F.col("k").alias(by), "share", (F.col("lo") * (1 - F.col("part")) + F.col("hi") * F.col("part")).alias("value"))
