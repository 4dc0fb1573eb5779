"""Approximate nearest neighbours by multiprobe p-stable hashing with exact reranking.

Largest inner product becomes smallest Euclidean distance when each indexed vector gets one
more component that brings all norms to the greatest. A table hashes a vector to the slots
of a few Gaussian projections; a query visits slot combinations in order of the estimated
probability that a neighbour lies there, until the visited ones together hold the wished
share over all tables. Buckets lie on shelves of bounded size, a crowded bucket on several;
a query's vector goes once to each shelf that holds any of its buckets, is scored exactly in
double precision against these alone, and only the best pass on. A query that meets fewer
than k rows in its buckets is then held against all rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import ceil, erf, log, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize

#: Rows of the bounded samples that the index is fitted on.
SAMPLE_ROWS = 8192
SAMPLE_QUERIES = 256
#: Index rows that a bucket should have on average, and least hashes of a table.
BUCKET = 256
LEAST_HASHES = 2
TABLES = 4
#: Bytes of vectors on a shelf.
SHELF_BYTES = 16 << 20
#: Share of true neighbours that the estimate aims at.
AIM = 0.93
#: Queries scored together.
_TOGETHER = 64
_PAIRS_HELD = 1_000_000


def _reduced(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows divided by a power of two each, so that the greatest component is between a half and one, and its exponents."""
    exponent = np.frexp(np.abs(x).max(axis=1))[1]
    return np.ldexp(x, -exponent[:, None]), exponent


@dataclass(frozen=True)
class Index:
    """Projections a[table][hash], offsets, slot width and range, and how a neighbour's projection lies to a query's.

    Indexed vectors are hashed after division by two to the ``exponent``, so that no norm
    overflows; queries are brought to the ``length`` that these have in the mean.
    """

    a: np.ndarray
    b: np.ndarray
    width: float
    low: np.ndarray
    high: np.ndarray
    norm2: float
    slope: float
    spread: float
    exponent: int
    length: float

    def directed(self, q: np.ndarray) -> np.ndarray:
        """Queries brought to one length, which changes no query's order of neighbours."""
        q = _reduced(q)[0]
        return q * (self.length / np.linalg.norm(q, axis=1))[:, None]

    def projected(self, x: np.ndarray, indexed: bool) -> np.ndarray:
        """(rows, tables, hashes)"""
        rest = np.sqrt(np.maximum(0.0, self.norm2 - (x * x).sum(axis=1))) if indexed else np.zeros(len(x))
        return np.einsum("rd,thd->rth", np.column_stack([x, rest]), self.a)

    def codes(self, x: np.ndarray) -> np.ndarray:
        """(rows, tables): the bucket of each indexed vector."""
        x = np.ldexp(x, -self.exponent)
        slots = np.clip(np.floor((self.projected(x, indexed=True) + self.b) / self.width), self.low, self.high) - self.low
        code = np.zeros(slots.shape[:2], np.int64)
        for k in range(slots.shape[2]):
            code = code * (self.high - self.low + 1)[:, k].astype(np.int64) + slots[:, :, k].astype(np.int64)
        return code

    def probes(self, q: np.ndarray, aim: float = AIM) -> list[list[int]]:
        """For one query and each table the buckets to visit, most promising first."""
        at = self.projected(self.directed(q[None, :]), indexed=False)[0] * self.slope
        enough = 1 - (1 - aim) ** (1 / len(self.a))
        visits = []
        for t in range(len(self.a)):
            odds, base = [], []
            for k in range(self.a.shape[1]):
                edges = np.arange(self.low[t, k] + 1, self.high[t, k] + 1) * self.width - self.b[t, k]
                below = [0.0, *(0.5 * (1 + erf((e - at[t, k]) / (self.spread * sqrt(2)))) for e in edges), 1.0]
                p = np.diff(below)
                order = np.argsort(-p, kind="stable")
                odds.append([(float(p[s]), int(s)) for s in order])
                base.append(int(self.high[t, k] - self.low[t, k] + 1))
            visits.append(_likeliest(odds, base, enough))
        return visits


def _likeliest(odds: list[list[tuple[float, int]]], base: list[int], enough: float) -> list[int]:
    """Codes of slot combinations in falling order of the product of their odds, until these sum to ``enough``.

    From each combination taken, the ones after it move one position on, at or after the
    position moved last, so each is met once and never before a likelier one.
    """

    def worth(c: tuple[int, ...]) -> float:
        p = 1.0
        for k, s in enumerate(c):
            p *= odds[k][s][0]
        return p

    first = (0,) * len(odds)
    heap = [(-worth(first), 0, first)]
    codes, total = [], 0.0
    while heap and total < enough:
        p, moved, c = heapq.heappop(heap)
        total -= p
        code = 0
        for k, s in enumerate(c):
            code = code * base[k] + odds[k][s][1]
        codes.append(code)
        for k in range(moved, len(c)):
            if c[k] + 1 < len(odds[k]):
                step = (*c[:k], c[k] + 1, *c[k + 1 :])
                heapq.heappush(heap, (-worth(step), k, step))
    return codes


def fit(sample: np.ndarray, n_rows: int, norm2: float, k: int, tables: int = TABLES, bucket: int = BUCKET, seed: int = 17, exponent: int = 0) -> Index:
    """An index for ``n_rows`` vectors from a bounded sample of them; ``norm2`` is the greatest squared norm after division by two to the ``exponent``.

    The number of hashes grows with the logarithm of the rows, so that buckets stay about
    ``bucket`` large, and is never below LEAST_HASHES. Slope and spread describe where the
    projection of a query's k-th neighbour lies; from a sample, the neighbour of proportional rank stands in for it, one
    that is farther if anything.
    """
    rng = np.random.default_rng(seed)
    original, sample = sample, np.ldexp(sample, -exponent)
    d = sample.shape[1] + 1
    rest = np.sqrt(np.maximum(0.0, norm2 - (sample * sample).sum(axis=1)))
    x = np.column_stack([sample, rest])
    width = 1.5 * float(np.sqrt((x * x).sum(axis=1).mean()))
    hashes = max(LEAST_HASHES, min(16, round(log(max(1.0, n_rows / bucket)) / log(3.0))))
    a = rng.normal(size=(tables, hashes, d))
    b = rng.uniform(0, width, size=(tables, hashes))
    slots = np.floor((np.einsum("rd,thd->rth", x, a) + b) / width)
    length = float(np.sqrt((sample * sample).sum(axis=1).mean())) or float(np.sqrt(norm2))
    q = _reduced(original[:SAMPLE_QUERIES])[0]
    q = q * (length / np.linalg.norm(q, axis=1))[:, None]
    scores = q @ sample.T
    scores[np.arange(len(q)), np.arange(len(q))] = -np.inf
    rank = min(len(sample) - 1, max(1, round(k * len(sample) / max(1, n_rows))))
    slope, spread = 0.0, 1.0
    if rank >= 1:
        near = np.argsort(-scores, axis=1, kind="stable")[:, rank - 1]
        own = (q * q).sum(axis=1)
        s = scores[np.arange(len(q)), near] / own
        slope = float(s.mean())
        spread = float(np.sqrt(np.maximum(1e-12, norm2 - 2 * slope * scores[np.arange(len(q)), near] + slope * slope * own).mean()))
    return Index(a, b, width, slots.min(axis=0), slots.max(axis=0), norm2, slope, spread, exponent, length)


def _usable(v: Column) -> Column:
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return v.isNotNull() & F.coalesce(fine, F.lit(False)) & F.exists(v, lambda x: x != 0)


def _matrix(lists: pa.Array) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(lists), -1)


def _hashed(rows: DataFrame, index: Index) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                codes = index.codes(_matrix(b.column(1)))
                for t in range(codes.shape[1]):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(codes), t, np.int32)), pa.array(codes[:, t]), *b.columns], names=["t", "bucket", "id", "v"])

    return rows.mapInArrow(run, "t int, bucket long, id long, v array<double>")


def _probed(queries: DataFrame, index: Index) -> DataFrame:
    """(id, t, bucket) of every bucket that a query visits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 128):
                part = b.slice(at, 128)
                t, bucket, row = [], [], []
                for i, q in enumerate(_matrix(part.column(1))):
                    for table, codes in enumerate(index.probes(q)):
                        t += [table] * len(codes)
                        bucket += codes
                        row += [i] * len(codes)
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(row, pa.int64())), pa.array(t, pa.int32()), pa.array(bucket, pa.int64())], names=["id", "t", "bucket"])

    return queries.mapInArrow(run, "id long, t int, bucket long")


class _Best:
    """Scored pairs of a task, cut down to each query's k best whenever many have gathered."""

    def __init__(self, k: int) -> None:
        self.k = k
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, q: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        self.parts.append((q, ids, scores))
        self.held += len(q)
        if self.held > _PAIRS_HELD:
            self.reduce()

    def reduce(self) -> None:
        q, ids, scores = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        order = np.lexsort((ids, q))
        q, ids, scores = q[order], ids[order], scores[order]
        new = np.append(True, (q[1:] != q[:-1]) | (ids[1:] != ids[:-1]))[: len(q)]
        q, ids, scores = q[new], ids[new], scores[new]
        order = np.lexsort((ids, -scores, q))
        q, ids, scores = q[order], ids[order], scores[order]
        first = np.searchsorted(q, q, side="left")
        keep = np.arange(len(q)) - first < self.k
        self.parts, self.held = [(q[keep], ids[keep], scores[keep])], int(keep.sum())

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.parts:
            self.reduce()
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in self.parts[0]], names=["query_id", "vec_id", "score"])
        self.parts, self.held = [], 0


def _pairs(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, visits: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best of the rows that each query visits, with all that come within rounding of the k-th.

    A matrix product preselects; the score itself is a sum in a fixed order, so that equal
    vectors score equally on whatever shelf they lie.
    """
    (q, q_exponent), (x, x_exponent) = _reduced(q), _reduced(x)
    means = visits & (q_ids[:, None] != ids[None, :])
    with np.errstate(over="ignore", under="ignore", invalid="ignore"):
        rough = np.ldexp(q @ x.T, q_exponent[:, None] + x_exponent[None, :])
        rough[~means] = -np.inf
        kth = np.partition(rough, -k, axis=1)[:, -k] if len(ids) > k else np.full(len(q), -np.inf)
        slack = np.ldexp(1e-10 * q.shape[1], q_exponent + x_exponent.max())
        least = np.where(np.isinf(kth), kth, kth - slack)
        i, j = np.nonzero(means & (rough >= least[:, None]))
        # powers of two are exact: this is the sum of the original products, without an overflow between
        return q_ids[i], ids[j], np.ldexp((q[i] * x[j]).sum(axis=1), q_exponent[i] + x_exponent[j])


class _Shelf:
    """A shelf's rows in order of bucket, and which of them a query's list of buckets means."""

    def __init__(self, ids: np.ndarray, buckets: np.ndarray, vectors: np.ndarray) -> None:
        order = np.argsort(buckets, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        self.buckets, self.of = np.unique(buckets[order], return_inverse=True)

    def score(self, q_ids: np.ndarray, q: np.ndarray, asked: list[np.ndarray | None], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best pairs of some queries; a query without a list means every row."""
        visited = np.zeros((len(q), len(self.buckets)), bool)
        for i, own in enumerate(asked):
            visited[i] = True if own is None else np.isin(self.buckets, own, assume_unique=True)
        rows = np.flatnonzero(visited.any(axis=0)[self.of])
        if not len(rows):
            none = np.zeros(0, np.int64)
            return none, none, np.zeros(0)
        return _pairs(q_ids, q, self.ids[rows], self.vectors[rows], visited[:, self.of[rows]], k)


def _scored(k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (t, shelf, asks, bucket, id, v, buckets) come sorted by the first four: a shelf's vectors, then the queries that visit it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, key, shelf = _Best(k), None, None
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for b in batches:
            if not b.num_rows:
                continue
            keys = np.stack([b.column(i).to_numpy().astype(np.int64) for i in range(3)], axis=1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                if key != (now := tuple(keys[lo, :2])):
                    key, shelf, parts = now, None, []
                own = b.slice(lo, hi - lo)
                ids, x = own.column(4).to_numpy(), _matrix(own.column(5))
                if not keys[lo, 2]:
                    parts.append((ids, own.column(3).to_numpy(), x))
                elif parts:
                    shelf = shelf or _Shelf(*(np.concatenate(c) for c in zip(*parts, strict=True)))
                    asked = [None if a is None else np.array(a, np.int64) for a in own.column(6).to_pylist()]
                    for at in range(0, len(ids), _TOGETHER):
                        best.add(*shelf.score(ids[at : at + _TOGETHER], x[at : at + _TOGETHER], asked[at : at + _TOGETHER], k))
                if best.held > _PAIRS_HELD // 2:
                    yield from best.flush()
        yield from best.flush()

    return run


def nearest(rows: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", tables: int = TABLES) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best inner products found, ties to smaller ids.

    Queries are the rows where ``is_query`` holds; candidates are all rows but the query's
    own. Vectors that are null, empty, zero or hold a null or non-finite component take no
    part, nor do rows with a null id or vectors of another length than most. Rows that
    repeat an id with the same vector count once. A query with no candidate, or an empty
    table, gives no rows. The search is approximate, though every query finds k rows or all
    there are; see the tests for its recall and for the share of rows that it scores. Scores
    are right for all finite vectors, whatever their norms; only a product beyond what a double
    holds becomes infinite, or 0 below.
    """
    picked = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    picked = picked.where(F.col("id").isNotNull() & _usable(F.col("v")))
    out = "query_id long, rank int, vec_id long, score double"
    size = picked.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if size is None:
        return rows.sparkSession.createDataFrame([], out)
    even = materialize(picked.where(F.size("v") == size["n"]), "vectors")
    n_rows, greatest = even.agg(F.count(F.lit(1)), F.max(F.array_max(F.transform("v", F.abs)))).first()
    exponent = int(np.frexp(greatest)[1])
    half = [2.0 ** -(exponent // 2), 2.0 ** -(exponent - exponent // 2)]
    norm2 = even.agg(F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * half[0] * half[1] * (x * half[0] * half[1])))).first()[0]
    sample = np.array([r["v"] for r in even.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS).select("v").collect()])
    index = fit(sample, n_rows, norm2, k, tables, exponent=exponent)

    shelf_rows = max(1024, SHELF_BYTES // (8 * size["n"]))
    shelves = ceil(n_rows / shelf_rows)
    hashed = _hashed(even.select("id", "v"), index)
    counts = hashed.groupBy("t", "bucket").agg(F.ceil(F.count(F.lit(1)) / shelf_rows).cast("int").alias("blocks"))
    counts = materialize(counts, "buckets")
    shelf = F.pmod(F.xxhash64("t", "bucket", "block"), F.lit(shelves)).cast("int").alias("shelf")
    stored = hashed.join(counts, ["t", "bucket"]).withColumn("block", F.pmod(F.xxhash64("id", F.lit(3)), F.col("blocks")))
    stored = stored.select("t", shelf, F.lit(0).alias("asks"), "bucket", "id", "v", F.lit(None).cast("array<long>").alias("buckets"))
    queries = even.where("asks").select("id", "v")
    # ids alone meet the buckets; a vector then goes once to each shelf
    visits = _probed(queries, index).join(counts, ["t", "bucket"]).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - F.lit(1).cast("long"))))
    visits = visits.select("id", "t", shelf, "bucket").groupBy("id", "t", "shelf").agg(F.collect_set("bucket").alias("buckets"))
    asked = visits.join(queries, "id").select("t", "shelf", F.lit(1).alias("asks"), F.lit(0).cast("long").alias("bucket"), "id", "v", "buckets")

    def scored(rows: DataFrame, asking: DataFrame) -> DataFrame:
        met = rows.unionByName(asking).repartition("t", "shelf").sortWithinPartitions("t", "shelf", "asks", "bucket", "id")
        return met.mapInArrow(_scored(k), "query_id long, vec_id long, score double").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))

    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    rank = lambda pairs: pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    found = materialize(rank(scored(stored, asked)), "found")
    full = found.where(F.col("rank") == k).select(F.col("query_id").alias("id"))
    lacking = materialize(queries.join(full, "id", "left_anti"), "lacking")
    if lacking.isEmpty():
        return found
    everywhere = lacking.select(F.lit(0).alias("t"), F.explode(F.sequence(F.lit(0), F.lit(shelves - 1))).alias("shelf"), F.lit(1).alias("asks"), F.lit(0).cast("long").alias("bucket"), "id", "v", F.lit(None).cast("array<long>").alias("buckets"))
    whole = rank(scored(stored.where("t = 0"), everywhere))
    return found.join(lacking.select(F.col("id").alias("query_id")), "query_id", "left_anti").select("query_id", "rank", "vec_id", "score").unionByName(whole)
