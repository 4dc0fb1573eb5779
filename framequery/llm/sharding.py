"""Shards of near equal bytes by histogram sort, with DataFrame functions only.

Rows are ordered by a key of 30 hex digits, half of them a digest of the text and half of the
id, so that equal texts lie side by side and any corpus is well mixed. Cuts are sought in
rounds: the exact bytes below candidate boundaries (key prefixes) are summed across all
partitions, and the interval that holds a cut's goal gets finer candidates in the next round,
until it is one group of equal texts, or within a group that must be cut, one row. Then all
rows move once, straight to their part. A group no larger than the largest row goes whole to
the side of its middle byte, and so does a row of a larger group: each shard's bytes are
within one row, the largest, of an equal share.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections import defaultdict
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import fresh, materialize, scratch

SHARDS = 40
ROW_BYTES = 16
DIGITS = 15
#: Candidate boundaries a round, bytes of text and most parts of the one exchange.
PROBES, PART_BYTES, MOST_PARTS = 1 << 16, 256 << 20, 1 << 15
#: Sorts after every key that begins as what stands before it.
_AFTER = "g"
_GOLDEN = 0.6180339887498949


@dataclass(frozen=True)
class Found:
    """A key (or a key's first half), the bytes below it, its own bytes and rows, and the cuts whose goals it holds."""

    key: str
    below: int
    size: int
    rows: int
    cuts: tuple[int, ...]


@dataclass(frozen=True)
class Cuts:
    """Where parts begin; ``repeated`` are keys of several equal rows that hold goals: (key, bytes below, bytes a row, rows)."""

    total: int
    n_parts: int
    keys: list[str]
    repeated: list[tuple[str, int, int, int]]


def sort_key(text: Column, row_id: Column) -> Column:
    """Hex digits of the text's digest, then of the id's; null counts as empty."""
    return F.concat(*[F.substring(F.md5(F.coalesce(c.cast("string"), F.lit(""))), 1, DIGITS) for c in (text, row_id)])


def row_bytes(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) and ROW_BYTES more."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + F.lit(ROW_BYTES)


def _locate(keyed: DataFrame, among: dict[str, tuple[int, tuple[int, ...]]], upto: int, total: int, n_parts: int) -> list[Found]:
    """The one key of ``upto`` digits that holds each cut's goal; ``among`` maps prefixes of one length to (bytes below, cuts).

    At most PROBES counts a round, or 16 an open interval if that is more, reach the driver.
    """
    found = []
    while among:
        depth = len(next(iter(among)))
        finer = min(upto, depth + max(1, int(math.log(max(16, PROBES // len(among)), 16))))
        rows = keyed
        if depth:
            prefixes = keyed.sparkSession.createDataFrame([(p,) for p in among], "open string")
            rows = keyed.join(F.broadcast(prefixes), F.substring("key", 1, depth) == F.col("open"), "left_semi")
        head = F.substring("key", 1, upto)
        counted = rows.groupBy(F.substring("key", 1, finer).alias("cell")).agg(F.sum("size"), F.count(F.lit(1)), F.min(head), F.max(head)).collect()
        cells = defaultdict(list)
        for c in sorted(counted):
            cells[c[0][:depth]].append(c)
        still = {}
        for prefix, (below, cuts) in among.items():
            starts = list(accumulate((c[1] for c in cells[prefix]), initial=below))
            held = defaultdict(list)
            for i in cuts:
                held[bisect_right(starts, i * total // n_parts) - 1].append(i)
            for k, own in held.items():
                cell, size, n, least, most = cells[prefix][k]
                if least == most:
                    found.append(Found(least, starts[k], size, n, tuple(own)))
                else:
                    still[cell] = (starts[k], tuple(own))
        among = still
    return found


def cuts(keyed: DataFrame, n_shards: int, part_bytes: int = PART_BYTES) -> Cuts:
    """Exact cuts of rows (key, size) into ``n_shards`` times as many parts as ``part_bytes`` asks for.

    ``keyed`` is read once a round and should be written.
    """
    total, largest = keyed.agg(F.sum("size"), F.max("size")).first()
    if not total:
        return Cuts(0, n_shards, [], [])
    n_parts = n_shards * max(1, min(MOST_PARTS // n_shards, math.ceil(total / (n_shards * part_bytes))))
    at: dict[int, str] = {}
    repeated = []

    def whole(u: Found) -> None:
        for i in u.cuts:
            at[i] = u.key if 2 * i * total < (2 * u.below + u.size) * n_parts else u.key + _AFTER

    groups = _locate(keyed, {"": (0, tuple(range(1, n_parts)))} if n_parts > 1 else {}, DIGITS, total, n_parts)
    large = {}
    for g in groups:
        if g.size <= largest:
            whole(g)
        else:
            large[g.key] = (g.below, g.cuts)
    for r in _locate(keyed, large, 2 * DIGITS, total, n_parts):
        if r.rows == 1:
            whole(r)
        else:
            repeated.append((r.key, r.below, r.size // r.rows, r.rows))
            at |= dict.fromkeys(r.cuts, r.key + _AFTER)
    return Cuts(total, n_parts, [at[i] for i in range(1, n_parts)], repeated)


def part_of(key: Column, found: Cuts) -> Column:
    """How many cuts lie at or before a key, by bisection."""
    if not found.keys:
        return F.lit(0)
    depth = len(found.keys).bit_length()
    padded = found.keys + ["~"] * ((1 << depth) - 1 - len(found.keys))
    bounds = F.split(F.lit(",".join(padded)), ",")  # folded to one constant array
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(depth))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.element_at(bounds, at + step) <= key, at + step).otherwise(at))


def _placed(rows: DataFrame, found: Cuts, key: str, part: str) -> DataFrame:
    """``rows`` with their part; equal rows whose key holds goals are dealt along its bytes."""
    placed = rows.withColumn(part, part_of(F.col(key), found))
    if not found.repeated:
        return placed
    k, below, size, n = fresh(placed.columns, "k", "below", "size", "n")
    table = rows.sparkSession.createDataFrame(found.repeated, f"`{k}` string, `{below}` long, `{size}` long, `{n}` long")
    at = F.monotonically_increasing_id()
    spread = (F.shiftright(at, 33) * 0.37 + at.bitwiseAND((1 << 33) - 1) * _GOLDEN) % 1.0
    copy = F.floor(spread * F.col(n))
    middle = (2 * (F.col(below) + copy * F.col(size)) + F.col(size)).cast("decimal(38,0)")
    dealt = ((middle * found.n_parts - 1) / F.lit(2 * found.total).cast("decimal(38,0)")).cast("int")
    joined = placed.join(F.broadcast(table), F.col(key) == F.col(k), "left")
    return joined.withColumn(part, F.when(F.col(k).isNull(), F.col(part)).otherwise(dealt)).select(*placed.columns)


def write(docs: DataFrame, path: str, n_shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", part_bytes: int = PART_BYTES) -> None:
    """Write the rows of ``docs``, all columns, to ``path``/<shard column>=K, Parquet files that follow each other by number.

    A null text has no bytes and a null id counts as empty. Rows of one id and text may be
    cut anywhere: they are dealt evenly over the parts between. With fewer rows than shards
    some shards are empty; an empty table writes no files. Texts are read twice, for their
    keys and to be moved; only keys and sizes are counted.
    """
    (shard,) = fresh(docs.columns, "shard")
    key, part = fresh(docs.columns, "key", "part")
    row_key = sort_key(F.col(text_col), F.col(id_col))
    keyed = materialize(docs.select(row_key.alias("key"), row_bytes(F.col(text_col)).alias("size")), "keys")
    found = cuts(keyed, n_shards, part_bytes)
    placed = _placed(docs.withColumn(key, row_key), found, key, part)
    placed = placed.withColumn(shard, (F.col(part) / F.lit(found.n_parts // n_shards)).cast("int"))
    moved = placed.repartitionById(found.n_parts, F.col(part)).sortWithinPartitions(shard, key)
    moved.drop(key, part).write.option("compression", "zstd").option("maxRecordsPerFile", 0).partitionBy(shard).parquet(path)


def read(spark: SparkSession, path: str, schema: T.StructType, shard: str = "shard", slot: str = "slot") -> DataFrame:
    """The rows that write() wrote, of ``schema``, with their shard and their place in it from 0."""
    (own,) = fresh(schema.names, "shard")
    part, row, p, start = fresh(schema.names, "part", "row", "p", "start")
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField(own, T.IntegerType())])).parquet(path)
    number = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("long")
    rows = rows.select("*", number.alias(part), F.col("_metadata.row_index").alias(row))
    before = Window.partitionBy(own).orderBy(p).rowsBetween(Window.unboundedPreceding, -1)
    files = rows.groupBy(own, F.col(part).alias(p)).agg(F.count(F.lit(1)).alias(start))
    # one row a file, of which there are at most MOST_PARTS
    starts = files.select(p, F.coalesce(F.sum(start).over(before), F.lit(0)).alias(start))
    placed = rows.join(F.broadcast(starts), F.col(part) == F.col(p))
    return placed.select(*schema.names, F.col(own).alias(shard), (F.col(start) + F.col(row)).cast("long").alias(slot))


def digest(docs: DataFrame, n_shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write shards into the shared folder and return, from their files, (doc_id, size, text_crc32, law, shard, slot, grown_shard)."""
    path = scratch(docs.sparkSession, "shards")
    write(docs, path, n_shards, id_col, text_col)
    text = F.col(text_col).cast("string")
    shard, slot = fresh(docs.columns, "shard", "slot")
    return read(docs.sparkSession, path, docs.schema, shard, slot).select(
        F.col(id_col).cast("long").alias("doc_id"),
        row_bytes(text).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        F.col(shard).alias("shard"),
        F.col(slot).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
