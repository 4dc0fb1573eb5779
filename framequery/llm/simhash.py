"""SimHash near-duplicates found through a byte-position inverted index with count filtering.

A fingerprint has eight byte positions. Two fingerprints that differ in at most four bits
agree in at least four positions, since a differing bit spoils one position at most. The
posting list of one (position, byte) holds a 256th of the corpus, so the index is keyed on
intersections of three posting lists instead: of the eight positions, 20 triples suffice
for every set of four positions to hold one whole triple (a Turan design), and a list then
holds a 2^24th of unrelated fingerprints. Of each pair met in a list the shared positional
bytes are tallied; pairs below the guaranteed four are dropped, the rest verified bit by bit.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_hot, materialize, shielded
from .components import connected_components

MAX_BITS = 4
LEAST_BYTES = 8 - MAX_BITS
#: Fingerprints in one block of a long posting list; a task compares two blocks at a time.
BLOCK = 512
_SLICE = 1 << 16


def turan_triples() -> list[tuple[int, int, int]]:
    """Triples of the positions 0-7 of which every four positions hold at least one.

    Positions fall into three rings; a triple lies within a ring, or has two positions in
    one ring and the third in the next.
    """
    ring = [0, 0, 0, 1, 1, 1, 2, 2]
    chosen = []
    for t in combinations(range(8), 3):
        r = sorted(ring[p] for p in t)
        lone = [x for x in set(r) if r.count(x) == 1]
        if len(set(r)) == 1 or (len(set(r)) == 2 and lone[0] == (next(x for x in r if r.count(x) == 2) + 1) % 3):
            chosen.append(t)
    return chosen


def simhash(text: bytes | None, shingle: int = 4, seed: int = 42) -> int:
    """The 64-bit fingerprint of a text; 0 for one without words.

    bytes.lower() and bytes.split() touch ASCII only, as the fingerprint's definition asks.
    """
    words = text.lower().split() if text else []
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False)) if len(words) > shingle else [b" ".join(words)]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(seed)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, _SLICE):
        octets = hashes[at : at + _SLICE].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, seed: int = 42, also: list[str] | None = None) -> DataFrame:
    """(doc_id, fp): each row's fingerprint as a signed long, and the long columns ``also``. Null text counts as no words."""
    more = also or []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((simhash(t, shingle, seed) for t in b.column(1).to_pylist()), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64)), *b.columns[2:]], names=["doc_id", "fp", *more])

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"), *more)
    return picked.mapInArrow(run, ", ".join(f"{c} long" for c in ("doc_id", "fp", *more)))


def _byte(fp: Column, position: int) -> Column:
    return F.shiftright(fp, 8 * position).bitwiseAND(F.lit(255))


def postings(fps: DataFrame) -> DataFrame:
    """(key, fp): each distinct fingerprint under its 20 triples of positional bytes."""
    fp = F.col("fp")
    keys = []
    for k, triple in enumerate(turan_triples()):
        key = F.lit(k).cast("long")
        for p in triple:
            key = F.shiftleft(key, 8).bitwiseOR(_byte(fp, p))
        keys.append(key)
    return fps.select("fp").distinct().select("fp", F.explode(F.array(*keys)).alias("key"))


def _verified(pairs: DataFrame) -> DataFrame:
    """Keep pairs (a, b) with enough shared positional bytes and few enough differing bits."""
    differ = F.col("a").bitwiseXOR(F.col("b"))
    shared = sum((F.when(_byte(differ, p) == 0, 1).otherwise(0) for p in range(8)), F.lit(0))
    return pairs.where(shared >= LEAST_BYTES).where(F.bit_count(differ) <= MAX_BITS)


def forest(some: np.ndarray, every: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that join what verified pairs of ``some`` with ``every`` connect: fewer than there are fingerprints."""
    fps = np.unique(np.concatenate([some, every]))
    differ = some[:, None] ^ every[None, :]
    shared = (differ.view(np.uint8).reshape(*differ.shape, 8) == 0).sum(axis=2)
    i, j = np.nonzero((shared >= LEAST_BYTES) & (np.bitwise_count(differ) <= MAX_BITS))
    a, b = np.searchsorted(fps, some[i]), np.searchsorted(fps, every[j])
    label = np.arange(len(fps))
    while True:
        least = label.copy()
        np.minimum.at(least, a, label[b])
        np.minimum.at(least, b, label[a])
        least = least[least]
        if (least == label).all():
            break
        label = least
    moved = label != np.arange(len(fps))
    return fps[moved], fps[label[moved]]


def _group_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, bi, bj, far, fp) come sorted by the first three; each such group, a block of the far ones and a block of all, gives its forest."""

    def out(rows: np.ndarray) -> pa.RecordBatch:
        cut = np.flatnonzero((rows[1:, :3] != rows[:-1, :3]).any(axis=1)) + 1
        found = [forest(*(np.unique(g[g[:, 3] == far, 4]).view(np.uint64) for far in (1, 0))) for g in np.split(rows, cut)]
        a, b = (np.concatenate(x).view(np.int64) for x in zip(*found, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    rest: list[np.ndarray] = []
    for batch in batches:
        rows = np.stack([batch.column(i).to_numpy() for i in range(5)], axis=1)
        if not len(rows):
            continue
        last = int(np.flatnonzero((rows[:, :3] != rows[-1, :3]).any(axis=1)).max(initial=-1)) + 1
        if last or (rest and (rest[-1][-1, :3] != rows[0, :3]).any()):
            yield out(np.concatenate([*rest, rows[:last]]))
            rest = []
        rest.append(rows[last:])
    if rest:
        yield out(np.concatenate(rest))


def links(fps: DataFrame) -> DataFrame:
    """Edges (a, b) between distinct fingerprints that connect exactly those within MAX_BITS, transitively.

    Every list is first contracted: what lies within MAX_BITS of its least fingerprint is
    linked to that, in a time linear in the list, and of these no pair is looked at again.
    The others ("far") are compared with the whole list, a block of BLOCK far ones with a
    block of all at a time, each pair of blocks in a task of its own that returns a spanning
    forest. A list of near copies costs next to nothing and output stays linear in the list.
    """
    distinct = materialize(fps.select("fp").distinct(), "distinct")
    lists = postings(distinct)
    n_rows = 20 * distinct.count()
    met = materialize(lists.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).where("n > 1"), "lists")
    pairs = _verified(met.where("n = 2").select("a", "b").distinct())
    longer = join_hot(lists, met.where("n > 2").select("key", "a", "n", F.col("n").alias("size")), ["key"], "n", n_rows)
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("a"))) <= MAX_BITS
    longer = materialize(longer.select("key", "fp", "a", "size", near.alias("near")), "longer")
    hubs = _verified(longer.where("near and fp != a").select("a", F.col("fp").alias("b")).distinct())
    far = longer.where("not near").groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    far = materialize(far.select("key", F.col("n").alias("n_far"), "n"), "far")
    left = join_hot(longer, far, ["key"], "n", n_rows)
    blocks = lambda n: F.ceil(F.col(n) / BLOCK).cast("long")
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), blocks(n) - 1))
    own = lambda n: F.pmod(F.xxhash64("fp"), blocks(n))
    every = left.select("key", upto("n_far").alias("bi"), own("size").alias("bj"), F.lit(0).cast("long").alias("far"), "fp")
    others = left.where("not near").select("key", own("n_far").alias("bi"), upto("size").alias("bj"), F.lit(1).cast("long").alias("far"), "fp")
    dealt = every.unionByName(others).repartition("key", "bi", "bj").sortWithinPartitions("key", "bi", "bj")
    return pairs.unionByName(hubs).unionByName(dealt.mapInArrow(_group_edges, "a long, b long"))


def _with_root(rows: DataFrame) -> DataFrame:
    """(doc_id, fp, ..., root): the least fingerprint that links reach from each row's."""
    roots = connected_components(links(rows)).withColumnsRenamed({"vertex": "fp"})
    per = rows.groupBy("fp").agg(F.count(F.lit(1)).alias("n")).join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    return join_hot(rows, materialize(per, "roots"), ["fp"], "n", rows.count())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``.

    component_id is the smallest doc_id that links of at most MAX_BITS reach; every
    fingerprint links to itself. Texts without words (null, empty, white space) have
    fingerprint 0 and link like others. Repeated rows come back as often as they came in;
    a null doc_id keeps its row and never becomes a component_id unless the component has
    no other. An empty table gives no rows; other columns of ``docs`` are not read.
    """
    rows = materialize(fingerprints(docs, id_col, text_col), "fingerprints")
    rooted = materialize(_with_root(rows), "rooted")
    ids = rooted.groupBy("root").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("component_id"))
    named = join_hot(rooted, materialize(ids, "ids"), ["root"], "n", rooted.count())
    return named.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@shielded
def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component of ``docs``, that of least id (a null one last); all columns as they were.

    Rows are told apart by all their columns: of rows that share an id but not the text each
    goes or stays by its own text, and of equal rows one stays.
    """
    own = [F.xxhash64(*docs.columns, F.lit(k)).alias(f"__row{k}") for k in range(2)]
    keyed = docs.select("*", *own)
    rows = materialize(fingerprints(keyed, id_col, text_col, also=["__row0", "__row1"]), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__row0", "__row1")).alias("kept")
    chosen = _with_root(rows).groupBy("root").agg(first).select("kept.__row0", "kept.__row1")
    return keyed.join(chosen, ["__row0", "__row1"], "left_semi").dropDuplicates(["__row0", "__row1"]).select(*docs.columns)
