"""Token ids as Parquet list columns in document order, and selective reads of them.

Ids are dictionary-encoded (a vocabulary's ids fit one dictionary page), ids of documents
and counts are delta-encoded. Row groups and pages are kept small enough, and page indexes
are written, for a reader to fetch a range of documents or the counts alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .tokens import encoded

END_ID = 2
_SCHEMA = "doc_id long, n_tokens long, ids array<int>"
LAYOUT = {
    "compression": "zstd",
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#n_tokens": "false",
    "parquet.dictionary.page.size": str(1 << 20),
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "1000",
}


def write(docs: DataFrame, path: str, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID) -> None:
    """Write doc_id, n_tokens and ids (with the end id) of every row to ``path``, in ascending doc_id order.

    Null ids come first; rows of one id are in the order of their text's hash. A null text
    is empty: its ids are the end id alone. File part-N holds what follows part-(N-1).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, ids, ends in encoded(tokenizer_path, b.column(1)):
                full, offsets = np.insert(ids, ends, end_id), np.append(0, ends + np.arange(1, hi - lo + 1))
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(full.view(np.int32)))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.array(np.diff(offsets)), lists], names=["doc_id", "n_tokens", "ids"])

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    placed = picked.repartitionByRange(*order).sortWithinPartitions(*order)
    placed.mapInArrow(run, _SCHEMA).write.options(**LAYOUT).parquet(path)


def read(spark: SparkSession, path: str, where: Column | None = None) -> DataFrame:
    """doc_id, n_tokens, ids, part and row; a condition on doc_id or n_tokens skips pages by their index."""
    rows = spark.read.schema(_SCHEMA).parquet(path)
    rows = rows if where is None else rows.where(where)
    part = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("long")
    return rows.select("*", part.alias("part"), F.col("_metadata.row_index").alias("row"))


def digest(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files.

    start counts the ids of all documents before; it is the sum over earlier parts, of which
    there are as many as files, and a running sum within the part. Empty files give no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(1)
            ends = lists.offsets.to_numpy()
            values = lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
            crc = [zlib.crc32(values[s:e]) for s, e in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.diff(ends).astype(np.int64)), pa.array(crc, pa.int64()), b.column(2), b.column(3)], names=["doc_id", "n_tokens", "ids_crc32", "part", "row"])

    rows = read(spark, path)
    summed = rows.select("doc_id", "ids", "part", "row").mapInArrow(run, "doc_id long, n_tokens long, ids_crc32 long, part long, row long")
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(F.col("part").alias("p"), F.coalesce(F.sum("total").over(before), F.lit(0)).alias("part_start"))
    inside = Window.partitionBy("part").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    placed = summed.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return placed.join(starts, F.col("part") == F.col("p")).select("doc_id", (F.col("part_start") + F.col("inside")).cast("long").alias("start"), "n_tokens", "ids_crc32")
