"""Line dedup by content-defined chunks: what repeats across the corpus is kept once.

A text's lines are hashed and a rolling hash runs over windows of line hashes; a chunk ends
where that hash falls on a divisor, so an inserted line moves the boundaries near it and no
others. A line of LONG_WORDS words or more is a paragraph, as long as several lines, and
makes a chunk of its own. Chunks that count are those of several lines, or of one long line.

Chunks miss the ends of a repeated run, and short runs whole, since their ends also hang on
the lines around it. ``dedup_passages`` therefore adds every smallest run of lines that has
LONG_WORDS words: it depends on its own lines only, so it lies in every copy of a passage,
and the smallest runs inside a passage of LONG_WORDS words or more cover all its lines.

Equal digests only nominate. The nominated spans are read from their texts and compared byte
for byte; where a digest stands for several texts, each of these keeps a copy of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import join_hot, materialize, shielded, slices

#: Lines in the rolling window; one in DIVISOR windows ends a chunk.
WINDOW = 2
DIVISOR = 3
MOST_LINES = 32
#: Words that make a line a chunk of its own.
LONG_WORDS = 40
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def chunks(text: str) -> list[tuple[int, int]]:
    """(first line, line after the last) of the chunks of a text, in order, all lines covered.

    A rolling hash of the last WINDOW worded lines of the chunk sets its end; lines without
    words neither enter the window nor end a chunk.
    """
    lines = text.split("\n")
    found: list[tuple[int, int]] = []
    start, window = 0, []
    for k, line in enumerate(lines):
        words = len(line.split())
        if words >= LONG_WORDS:
            if start < k:
                found.append((start, k))
            found.append((k, k + 1))
            start, window = k + 1, []
            continue
        if words:
            window = [*window[1 - WINDOW :], xxhash.xxh64_intdigest(line.encode())]
            rolled = 0
            for h in window:
                rolled = (rolled * _BASE + h) & _MASK
            if len(window) == WINDOW and (rolled >> 20) % DIVISOR == 0 or k + 1 - start >= MOST_LINES:
                found.append((start, k + 1))
                start, window = k + 1, []
    if start < len(lines):
        found.append((start, len(lines)))
    return found


def _counts(lines: list[str]) -> bool:
    """Whether a chunk may be removed: several worded lines, or one long one."""
    worded = [line for line in lines if line.strip()]
    return len(worded) > 1 or (len(worded) == 1 and len(worded[0].split()) >= LONG_WORDS)


def passages(lines: list[str]) -> list[tuple[int, int]]:
    """(first line, line after the last) of every smallest run of LONG_WORDS words or more.

    From each worded line the run goes on, and to each one it goes back, just until it has
    the words. Every line of a longer run lies in one of its smallest runs.
    """
    worded, before = [], [0]
    for k, line in enumerate(lines):
        if n := len(line.split()):
            worded.append(k)
            before.append(before[-1] + n)
    found: set[tuple[int, int]] = set()
    first = last = 0
    for k in range(len(worded)):
        while last < len(worded) and before[last] - before[k] < LONG_WORDS:
            last += 1
        if before[last] - before[k] >= LONG_WORDS:
            found.add((worded[k], worded[last - 1] + 1))
        while before[k + 1] - before[first + 1] >= LONG_WORDS:
            first += 1
        if before[k + 1] - before[first] >= LONG_WORDS:
            found.add((worded[first], worded[k] + 1))
    return sorted(found)


def _line_digests(lines: list[str]) -> list[bytes]:
    return [hashlib.blake2b(line.encode(), digest_size=16).digest() for line in lines]


def _digest(line_digests: list[bytes]) -> tuple[int, int]:
    d = hashlib.blake2b(b"".join(line_digests), digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


_SPAN = "doc_id long, row long, first int, after int, h long, g long"


def _batch(columns: list[list], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(x, kinds[kind]) for x, (_, kind) in zip(columns, fields, strict=True)], names=[name for name, _ in fields])


def _row_key(text_col: str) -> F.Column:
    """Tells rows of one id apart by their text; rows with the same id and text are one."""
    return F.xxhash64(F.col(text_col).cast("string"))


def span_hashes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", runs: bool = True) -> DataFrame:
    """(doc_id, row, first, after, h, g) of every chunk that counts and, with ``runs``, of every smallest run.

    (h, g) are the halves of a 128-bit BLAKE2b digest of the lines' own digests.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (part for whole in batches for part in slices(whole, 2)):
            out: list[list] = [[] for _ in range(6)]
            for doc_id, row, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if not text:
                    continue
                lines = text.split("\n")
                digests = _line_digests(lines)
                counted = {(a, z) for a, z in chunks(text) if _counts(lines[a:z])}
                for first, after in sorted(counted.union(passages(lines)) if runs else counted):
                    for column, x in zip(out, (doc_id, row, first, after, *_digest(digests[first:after])), strict=True):
                        column.append(x)
            yield _batch(out, _SPAN)

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), _row_key(text_col).alias("row"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(run, _SPAN)


def _texts_of(rows: DataFrame) -> DataFrame:
    """(doc_id, row, first, after, h, g, chunk) of the spans in (doc_id, row, text, spans)."""
    schema = _SPAN + ", chunk string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (part for whole in batches for part in slices(whole, 2)):
            out: list[list] = [[] for _ in range(7)]
            for doc_id, row, text, spans in zip(*(c.to_pylist() for c in b.columns), strict=True):
                lines = text.split("\n")
                for s in spans:
                    own = (doc_id, row, s["first"], s["after"], s["h"], s["g"], "\n".join(lines[s["first"] : s["after"]]))
                    for column, x in zip(out, own, strict=True):
                        column.append(x)
            yield _batch(out, schema)

    return rows.mapInArrow(run, schema)


def _later(spans: DataFrame, keys: list[str]) -> DataFrame:
    """``spans`` with their group's copy that stays, of least (doc_id, row, first), as ``keep`` and the group's size."""
    n_rows = spans.count()
    keep = spans.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "row", "first", "after")).alias("keep")).where("n > 1")
    return join_hot(spans, materialize(keep, "keepers"), keys, "n", n_rows)


def _listed() -> F.Column:
    """A row's spans in one sorted list: where they lie, whether they go, and the copy that stays if it is in the same row."""
    same_row = F.col("doc_id").eqNullSafe(F.col("keep.doc_id")) & (F.col("row") == F.col("keep.row"))
    goes = F.col("doc_id").isNotNull() & ~(same_row & (F.col("first") == F.col("keep.first")))
    kept = [F.when(same_row, F.col(f"keep.{c}")).alias(f"kept_{c}") for c in ("first", "after")]
    return F.sort_array(F.collect_set(F.struct("first", "after", "h", "g", goes.alias("goes"), *kept))).alias("__spans")


def _cut(text: str, spans: list[dict]) -> tuple[str, int]:
    """The text without the lines of the spans that go, and how many lines those are.

    A span that overlaps the copy of its run that stays (a run of like lines) leaves it whole.
    """
    lines = text.split("\n")
    gone = [False] * len(lines)
    for s in spans:
        if s["goes"]:
            first = s["first"] if s["kept_after"] is None else max(s["first"], s["kept_after"])
            for k in range(first, s["after"]):
                gone[k] = True
    return "\n".join(line for line, g in zip(lines, gone, strict=True) if not g), sum(gone)


def _deduped(docs: DataFrame, id_col: str, text_col: str, count_col: str | None, runs: bool) -> DataFrame:
    key = ["doc_id", "row"]
    spans = materialize(span_hashes(docs, id_col, text_col, runs).distinct(), "spans")
    asked = _later(spans, ["h", "g"]).groupBy(*key).agg(_listed()).withColumnsRenamed({"doc_id": "__id", "row": "__row"})
    here = F.col(id_col).cast("long").eqNullSafe(F.col("__id")) & (_row_key(text_col) == F.col("__row"))
    joined = materialize(docs.join(asked, here, "left"), "asked")

    # byte for byte: a digest that stands for several texts is dealt with text by text
    texts = _texts_of(joined.where("__spans is not null").select(F.col("__id").alias("doc_id"), F.col("__row").alias("row"), F.col(text_col).cast("string").alias("text"), F.col("__spans").alias("spans")))
    several = texts.select("h", "g", "chunk").distinct().groupBy("h", "g").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h", "g")
    several = materialize(several, "several")
    apart = materialize(texts.join(several, ["h", "g"]).distinct(), "apart")
    again = _later(apart, ["h", "g", "chunk"]).groupBy(*key).agg(_listed().alias("__again"))
    wrong = apart.groupBy(*key).agg(F.collect_set(F.struct("h", "g")).alias("__wrong"))
    mended = materialize(wrong.join(again, key, "left").withColumnsRenamed({"doc_id": "__mended_id", "row": "__mended_row"}), "mended")
    there = F.col("__id").eqNullSafe(F.col("__mended_id")) & (F.col("__row") == F.col("__mended_row"))
    right = F.filter("__spans", lambda s: ~F.array_contains("__wrong", F.struct(s["h"].alias("h"), s["g"].alias("g"))))
    final = F.when(F.col("__wrong").isNull(), F.col("__spans")).otherwise(F.concat(right, F.coalesce("__again", F.array().cast(joined.schema["__spans"].dataType))))
    listed = joined.join(mended, there, "left").select(*docs.columns, final.alias("__spans"))

    at, schema = docs.columns.index(text_col), docs.schema
    out_schema = T.StructType([*schema.fields, *([T.StructField(count_col, T.IntegerType())] if count_col else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (part for whole in batches for part in slices(whole, at)):
            columns, counts = list(b.columns[:-1]), [0] * b.num_rows
            texts = columns[at].to_pylist()
            for k, own in enumerate(b.column(b.num_columns - 1).to_pylist()):
                if own:
                    texts[k], counts[k] = _cut(texts[k], own)
            columns[at] = pa.array(texts, columns[at].type)
            if count_col:
                columns.append(pa.array(counts, pa.int32()))
            yield pa.RecordBatch.from_arrays(columns, names=out_schema.names)

    return listed.mapInArrow(run, out_schema)


@shielded
def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", count_col: str | None = None) -> DataFrame:
    """``docs`` with later copies of repeated chunks cut from the texts; all columns as they were.

    The copy of least (doc_id, line) stays. ``count_col`` adds a column with the number of
    lines cut. Null and empty texts, and rows with a null id, stay as they are; a null id
    counts as least, so its copy is the one that stays. No row goes, even if its whole text
    is cut. Rows with the same id and text are one document and are cut alike; rows that
    share an id but not the text are documents of their own. An empty table gives no rows.
    """
    return _deduped(docs, id_col, text_col, count_col, runs=False)


@shielded
def dedup_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", count_col: str | None = None) -> DataFrame:
    """``docs`` with later copies of repeated runs of lines cut: all runs of LONG_WORDS words or more, whole, and repeated chunks.

    Each cut line is equal to an earlier one, and the earliest copy of each line stays.
    Everything else is as in dedup_lines().
    """
    return _deduped(docs, id_col, text_col, count_col, runs=True)
