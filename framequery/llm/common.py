"""Helpers that several operators share: shared scratch tables and hot-key-safe ranks."""

from __future__ import annotations

import functools
import inspect
import math
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: A word is a run of bytes that are neither a space nor one of \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"

_made: set[str] = set()
_own_dir: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """A folder that the driver and every executor see, for this application only.

    It lies in ``spark.checkpoint.dir``; where that is unset a new temporary folder serves
    a local master, and a cluster gets an error. The driver's JVM deletes it when it ends in
    good order, whether or not the session was stopped before.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors see")
        if not _own_dir:
            _own_dir.append("file://" + tempfile.mkdtemp(prefix="spark-shared-"))
        base = _own_dir[0]
    path = f"{base.rstrip('/')}/llm-{spark.sparkContext.applicationId}"
    if path not in _made:
        _made.add(path)
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        files = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        files.mkdirs(where)
        files.deleteOnExit(where)
    return path


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` into the shared folder and read it back, which cuts its lineage.

    Unlike a local checkpoint the rows outlive the executors that made them.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(taken: list[str], *names: str) -> list[str]:
    """The names with a prefix such that no column of ``taken`` has any of them, in any case."""
    prefix, known = "_", {c.lower() for c in taken}
    while any(prefix + n in known for n in names):
        prefix += "_"
    return [prefix + n for n in names]


def shielded(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """An operator that returns its first table's columns, made safe from columns named as its own helpers are.

    It sees the columns that its ``*_col`` arguments name; the others travel in one struct and come
    back as they were, in the table's order, before any column that the operator adds.
    """
    known = inspect.signature(operator)

    @functools.wraps(operator)
    def run(docs: DataFrame, *args, **kwargs) -> DataFrame:  # noqa: ANN002, ANN003
        bound = known.bind(docs, *args, **kwargs)
        bound.apply_defaults()
        used = {v for k, v in bound.arguments.items() if k.endswith("_col") and k != "count_col" and v in docs.columns}
        rest = [c for c in docs.columns if c not in used]
        if not rest:
            return operator(docs, *args, **kwargs)
        quoted = lambda c: F.col(f"`{c}`")
        packed = docs.select(*[quoted(c) for c in docs.columns if c in used], F.struct(*[quoted(c) for c in rest]).alias("__rest"))
        out = operator(packed, *args, **kwargs)
        added = [quoted(c) for c in out.columns if c not in packed.columns]
        return out.select(*[quoted(c) if c in used else F.col("__rest").getField(c).alias(c) for c in docs.columns], *added)

    return run


def join_hot(left: DataFrame, counted: DataFrame, keys: list[str], n: str, n_rows: int, how: str = "inner") -> DataFrame:
    """``left`` joined on ``keys`` (null-safe) to ``counted``, which has one row a key; no key's rows meet in one task.

    Keys that hold over a thousandth of ``left``, fewer than a thousand by their number
    ``n``, are broadcast; the rest are shuffled. ``n_rows`` is the number of rows of
    ``left``, which is read twice and should be written. ``how`` may be inner or left.
    """
    least = n_rows / 1000
    named = counted.withColumnsRenamed({k: f"__key_{k}" for k in keys})
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__key_{k}"))
    drop = [f"__key_{k}" for k in keys] + ([n] if n not in keys else [])
    hot = named.where(F.col(n) > least)
    found = left.join(F.broadcast(hot), same).drop(*drop)
    cold = left.join(F.broadcast(hot.select(*[f"__key_{k}" for k in keys])), same, "left_anti")
    rest = cold.join(named.where(F.col(n) <= least), same, how).drop(*drop)
    return found.unionByName(rest)


def slices(batch: pa.RecordBatch, at: int, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``most`` bytes of text in column ``at``, a longer text alone.

    A task turns a slice at a time into Python objects, which take several times its bytes.
    """
    size = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False).astype("int64")
    upto, lo = size.cumsum(), 0
    while lo < len(size):
        hi = max(lo + 1, int(upto.searchsorted(upto[lo] - size[lo] + most, side="right")))
        yield batch.slice(lo, hi - lo)
        pa.default_memory_pool().release_unused()  # else a worker keeps its largest slice's memory
        lo = hi


def word_count(text: Column) -> Column:
    """Words of a text (null: 0), counted in the JVM."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def salts_for(n_rows: int, rows_per_salt: int = 4096, most: int = 65536) -> int:
    """Into how many parts a group is cut so that even one that holds a third of the rows spreads."""
    return min(most, max(8, math.ceil(n_rows / rows_per_salt)))


def salted_rank(df: DataFrame, keys: list[str], order: list[Column], salt_on: list[str], out: str, n_salts: int, narrow: DataFrame | None = None) -> DataFrame:
    """Number the rows of each key from 0 without bringing a key's rows into one task.

    A row's salt is a hash of ``salt_on``. Rows are numbered within (key, salt) by
    ``order``, after the rows of the key's lower salts, whose counts are summed first.
    Rows that tie in ``order`` must be interchangeable. Null keys form groups of their own.
    ``narrow`` may give the keys and ``salt_on`` of the same rows from a cheaper place, to count.
    """
    salt = f"{out}_salt"
    salting = F.pmod(F.xxhash64(*salt_on), F.lit(n_salts))
    salted = df.withColumn(salt, salting)
    counted = salted if narrow is None else narrow.withColumn(salt, salting)
    counts = counted.groupBy(*keys, salt).agg(F.count(F.lit(1)).alias(f"{out}_n"))
    below = Window.partitionBy(*keys).orderBy(salt).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        *[F.col(k).alias(f"{out}_k{i}") for i, k in enumerate(keys)],
        F.col(salt).alias(f"{out}_s"),
        F.coalesce(F.sum(f"{out}_n").over(below), F.lit(0)).alias(f"{out}_start"),
    )
    within = Window.partitionBy(*keys, salt).orderBy(*order)
    ranked = salted.withColumn(f"{out}_rn", F.row_number().over(within) - 1)
    same = F.col(salt) == F.col(f"{out}_s")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"{out}_k{i}"))
    drop = [salt, f"{out}_s", f"{out}_start", f"{out}_rn", *[f"{out}_k{i}" for i in range(len(keys))]]
    return ranked.join(starts, same).withColumn(out, (F.col(f"{out}_rn") + F.col(f"{out}_start")).cast("long")).drop(*drop)


def numbered(df: DataFrame, order: list[Column], out: str, name: str) -> DataFrame:
    """The rows of ``df`` with ``out``, their place from 0 in ``order`` over the whole table.

    ``df`` is read twice and should be written. It is sorted by ranges into files of the
    shared folder, whose numbers follow the order; a row's place is its row in the file after
    the rows of the files before, of which one small row each is summed and broadcast. Rows
    that tie in all of ``order`` stay in one range: end it with a column that tells repeated
    rows apart. No column of ``df`` may be called part or row.
    """
    path = scratch(df.sparkSession, name)
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.option("maxRecordsPerFile", 0).parquet(path)
    part = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("long")
    rows = df.sparkSession.read.schema(df.schema).parquet(path).select("*", part.alias("part"), F.col("_metadata.row_index").alias("row"))
    before = Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(F.col("part").alias("p")).agg(F.count(F.lit(1)).alias("n"))
    starts = counts.select("p", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    placed = rows.join(F.broadcast(starts), F.col("part") == F.col("p"))
    return placed.select(*df.columns, (F.col("start") + F.col("row")).cast("long").alias(out))
