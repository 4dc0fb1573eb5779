"""Importance resampling of documents towards a target's distribution of hashed words and word pairs.

An untrained Split of the tokenizers library cuts whole ASCII-lowered texts into words with
their offsets. Each word, and each window of two neighbouring offsets, is a feature; its
bucket is the CRC-32 of its bytes (two words joined by one space) modulo ``BUCKETS``. A text
is split once: its buckets are written to the shared folder, then counted over all documents,
and a document's weight is the mean gain of its buckets. Gumbel noise from a keyed hash of
the id turns weights into scores, whose highest are a draw without replacement.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, numbered

BUCKETS = 10_000
SEED = 7
SHARE_PERCENT = 25
LEAST_WORDS = 20
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_GAP = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
#: Characters split at once, bytes of text a batch, words that a worker knows before it starts afresh.
PIECE, BATCH_BYTES, MOST_KEPT = 1 << 18, 2 << 20, 400_000
#: Words of more bytes are hashed pair by pair.
_LONG = 255
_POLYNOMIAL = 0xEDB88320


def _zero_bytes() -> np.ndarray:
    """[length, byte of a CRC, its value]: what that byte of a text's CRC becomes after so many further bytes."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = (step >> 1) ^ np.where(step & 1, np.uint32(_POLYNOMIAL), np.uint32(0))
    now = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    after = [now]
    for _ in range(_LONG):
        now = (now >> 8) ^ step[now & 255]
        after.append(now)
    return np.stack(after)


class _Words(dict):
    """Numbers of the words a worker has met, with the CRCs of each alone and before a space, and its bytes."""

    def __init__(self) -> None:
        super().__init__()
        self.raw: list[bytes] = []
        self.known = np.zeros((3, 0), np.uint32)

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self.raw)
        self.raw.append(word.encode())
        return number

    def table(self) -> np.ndarray:
        """Rows: CRC of each word, CRC of it and a space, its length in bytes."""
        new = self.raw[self.known.shape[1] :]
        if new:
            alone = [zlib.crc32(w) for w in new]
            self.known = np.hstack([self.known, np.array([alone, [zlib.crc32(b" ", c) for c in alone], [len(w) for w in new]], np.uint32)])
        return self.known


class Splitter:
    """The buckets of texts; one a worker."""

    def __init__(self) -> None:
        from tokenizers import PreTokenizedString, Regex, pre_tokenizers

        self.cut, self.holder = pre_tokenizers.Split(Regex(_WORD), "removed", invert=True), PreTokenizedString
        self.words, self.shift = _Words(), _zero_bytes()

    def _split(self, text: str) -> Iterator[list[tuple]]:
        """(word, offsets, none) of a text, a piece that ends between words at a time."""
        at = 0
        while at < len(text):
            end = _GAP.search(text, min(at + PIECE, len(text)))
            end = end.start() if end else len(text)
            piece = self.holder(text[at:end])
            self.cut.pre_tokenize(piece)
            yield piece.get_splits(offset_referential="original", offset_type="byte")
            at = end

    def buckets(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The buckets of all features of all texts (null: none), and where each text's end; words come before pairs."""
        if len(self.words) > MOST_KEPT:
            self.words = _Words()
        number, ends, n = [np.zeros(0, np.int64)], [], 0
        for text in texts:
            lowered = (text or "").encode().lower().decode()  # of bytes, so that A-Z alone change
            for found in self._split(lowered):
                number.append(np.fromiter((self.words[w] for w, _, _ in found), np.int64, len(found)))
                n += len(found)
            ends.append(n)
        return self._hashed(np.concatenate(number), np.array(ends, np.int64))

    def _hashed(self, number: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        alone, opening, length = self.words.table()
        last = np.zeros(len(number), bool)
        last[ends[ends > 0] - 1] = True
        left = np.flatnonzero(~last)
        first, second = number[left], number[left + 1]
        before, size = opening[first], length[second]
        pair = alone[second]
        for k in range(4):
            pair ^= self.shift[np.minimum(size, _LONG), k, (before >> np.uint32(8 * k)) & np.uint32(255)]
        for i in np.flatnonzero(size > _LONG):
            pair[i] = zlib.crc32(self.words.raw[second[i]], int(before[i]))
        n = np.diff(ends, prepend=0)
        upto = np.cumsum(np.maximum(2 * n - 1, 0))
        # of a text of n words the first n places hold its words, the others its n - 1 pairs
        place = np.arange(len(number)) + np.repeat(np.append(0, upto[:-1]) - (ends - n), n)
        features = np.empty(int(upto[-1]) if len(upto) else 0, np.uint32)
        features[place] = alone[number]
        features[(place + np.repeat(n, n))[left]] = pair
        return (features % np.uint32(BUCKETS)).astype(np.int16), upto


def featured(docs: DataFrame, text_col: str = "text", keep: list[Column] | None = None) -> DataFrame:
    """The columns ``keep`` (simple types) and ``buckets``, the list of a text's features' buckets; null or wordless: empty."""
    kept = docs.select(*(keep or []), F.col(text_col).cast("string").alias("buckets"))
    names = kept.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Splitter()
        for b in batches:
            size = pc.fill_null(pc.binary_length(b.column(len(names) - 1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            upto, lo = np.cumsum(size), 0
            while lo < len(size):
                hi = max(lo + 1, int(np.searchsorted(upto, upto[lo] - size[lo] + BATCH_BYTES, side="right")))
                part = b.slice(lo, hi - lo)
                flat, ends = own.buckets(part.column(len(names) - 1).to_pylist())
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(flat))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], lists], names=names)
                lo = hi

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1])
    return kept.mapInArrow(run, schema + ", " * bool(schema) + "buckets array<smallint>")


def histogram(features: DataFrame) -> np.ndarray:
    """How many features each bucket holds; a task counts its own first, so at most BUCKETS rows a task move."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(BUCKETS, np.int64)
        for b in batches:
            n += np.bincount(b.column(0).flatten().to_numpy(), minlength=BUCKETS)
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(n[used])], names=["bucket", "n"])

    found = features.select("buckets").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    n = np.zeros(BUCKETS, np.int64)
    n[[r.bucket for r in found]] = [r.n for r in found]
    return n


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket floor(1000 ln((t+1)(S+BUCKETS) / ((s+1)(T+BUCKETS)))): how much likelier the target makes it."""
    all_source, all_target = int(source.sum()) + BUCKETS, int(target.sum()) + BUCKETS
    return np.array([math.floor(1000 * math.log(float((t + 1) * all_source) / float((s + 1) * all_target))) for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def weighed(features: DataFrame, gain: np.ndarray) -> DataFrame:
    """Each row's other columns with n_features and weight, the floored mean gain (no features: 0)."""
    names = [c for c in features.columns if c != "buckets"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(len(names))
            bounds = np.append(0, np.cumsum(pc.list_value_length(lists).to_numpy()))
            sums = np.append(0, np.cumsum(gain[lists.flatten().to_numpy()]))[bounds]
            n = np.diff(bounds)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(n), pa.array(np.diff(sums) // np.maximum(n, 1))], names=[*names, "n_features", "weight"])

    schema = "".join(f"`{features.schema[c].name}` {features.schema[c].dataType.simpleString()}, " for c in names)
    return features.select(*names, "buckets").mapInArrow(run, schema + "n_features long, weight long")


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text", share_percent: int = SHARE_PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row of ``docs``; rank is null where it isn't drawn.

    Of the N rows with at least ``least_words`` words the floor(share_percent * N / 100) of
    highest score are drawn, ties to the smaller doc_id, null ids last. A null text has no
    features. A null id is hashed as if it were empty. Repeated rows are rows of their own,
    with equal scores and ranks side by side. An empty table gives no rows; an empty target
    has no features, so that rare buckets gain. Columns but the id and the text aren't read.
    """
    features = materialize(featured(docs, text_col, [F.col(id_col).cast("long").alias("doc_id")]), "features")
    gain = gains(histogram(features), histogram(featured(target, target_text_col)))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    scored = weighed(features, gain).withColumn("score", (F.col("weight") + noise).cast("long"))
    # the last column tells repeated rows apart and is fixed once written
    scored = materialize(scored.withColumn("copy", F.monotonically_increasing_id()), "scores")
    fit = F.col("n_features") >= 2 * max(least_words, 1) - 1 if least_words > 0 else F.lit(True)
    drawn = share_percent * scored.where(fit).count() // 100
    ranked = numbered(scored.where(fit), [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("copy").asc()], "place", "ranks")
    rank = F.when(F.col("place") < drawn, F.col("place") + 1).cast("long").alias("rank")
    out = ["doc_id", "n_features", "weight", "score"]
    return ranked.select(*out, rank).unionByName(scored.where(~fit).select(*out, F.lit(None).cast("long").alias("rank")))
