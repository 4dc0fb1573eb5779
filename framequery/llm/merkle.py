"""A Merkle manifest of a dataset: one binary hash tree a group, whose roots are the leaves of one more.

A group's leaves, numbered in order, are cut into aligned subtrees of 1,024 leaves. Each
is built in one small task and stored as one record, its digests in van Emde Boas order: the
tree is split at half its height, the upper half stands first and the lower subtrees follow,
each laid out in the same way, so that any path crosses few stretches whatever the block size
of the store. A node's place is arithmetic on its depth and index, for writing and for
reading siblings alike. The subtrees' roots are the leaves of the next tier, until one
subtree a group is left. Proofs run down the tiers: a subtree's own path to the root is
joined to it once and shared by all its leaves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_hot, materialize, numbered

#: Levels of an aligned subtree above its leaves, which number two to this power.
HEIGHT = 10
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_TIER = "grp string, block long, of long, n int, tree binary, root string"
_LEFT, _RIGHT, _LONE = "l", "r", "-"


@dataclass(frozen=True)
class Manifest:
    """Stored subtrees, tier by tier, of the groups and of their roots; ``root`` is None where there are no rows."""

    tiers: list[DataFrame]
    groups: DataFrame
    group_tiers: list[DataFrame]
    root: str | None
    height: int


def leaf(columns: list[Column]) -> Column:
    """Hex digest of a row: each value's UTF-8 byte count, a colon and the value; a null is a dash."""
    texts = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]).cast("binary"), 256)


def address(depth: np.ndarray, index: np.ndarray, levels: int) -> np.ndarray:
    """Places in van Emde Boas order of nodes of a full binary tree with ``levels`` levels, by depth and index in it."""
    if levels == 1:
        return np.zeros(len(depth), np.int64)
    upper = levels // 2
    lower = levels - upper
    place = np.empty(len(depth), np.int64)
    high = depth < upper
    place[high] = address(depth[high], index[high], upper)
    under, at = depth[~high] - upper, index[~high]
    subtree = at >> under
    place[~high] = (1 << upper) - 1 + subtree * ((1 << lower) - 1) + address(under, at - (subtree << under), lower)
    return place


@lru_cache
def _rows(levels: int) -> list[np.ndarray]:
    """The places of all nodes of each depth."""
    return [address(np.full(1 << d, d), np.arange(1 << d), levels) for d in range(levels)]


def levels_of(n: int, of: int, height: int) -> int:
    """Levels of a subtree of ``n`` of the ``of`` leaves: as many as end in one node where it is the whole tree, else all."""
    return (int(n - 1).bit_length() if of <= 1 << height else height) + 1


def _digest(*parts: bytes) -> bytes:
    return hashlib.sha256(b"".join(parts)).hexdigest().encode()


def grown(leaves: list[bytes], levels: int) -> tuple[bytes, bytes]:
    """The stored digests of a subtree, 32 bytes a node (absent ones zero), and its root in hex."""
    tree = np.zeros(((1 << levels) - 1, 32), np.uint8)
    now = leaves
    for depth in range(levels - 1, -1, -1):
        tree[_rows(levels)[depth][: len(now)]] = np.frombuffer(bytes.fromhex(b"".join(now).decode()), np.uint8).reshape(-1, 32)
        if depth:
            now = [_digest(*now[k : k + 2]) for k in range(0, len(now), 2)]
    return tree.tobytes(), now[0]


def paths(tree: bytes, n: int, levels: int) -> Iterator[tuple[bytes, list[bytes], str]]:
    """(leaf, siblings upwards, their sides) of each leaf of a stored subtree, in hex; a lone node has side ``-`` and no sibling."""
    raw = tree.hex().encode()
    node = [[raw[64 * p : 64 * p + 64] for p in _rows(levels)[d][: -(-n >> (levels - 1 - d))].tolist()] for d in range(levels)]
    for k in range(n):
        found, sides = [], []
        for up in range(levels - 1):
            row, own = node[levels - 1 - up], k >> up
            if own ^ 1 < len(row):
                found.append(row[own ^ 1])
                sides.append(_LEFT if own & 1 else _RIGHT)
            else:
                sides.append(_LONE)
        yield node[-1][k], found, "".join(sides)


def fold(digest: bytes, siblings: bytes, sides: str) -> bytes:
    """The root that a leaf and its siblings (hex, one after another) lead to."""
    at = 0
    for side in sides:
        if side == _LONE:
            digest = _digest(digest)
            continue
        sibling, at = siblings[at : at + 64], at + 64
        digest = _digest(sibling, digest) if side == _LEFT else _digest(digest, sibling)
    return digest


def _tiers(nodes: DataFrame, extra: dict[str, str], name: str, height: int) -> list[DataFrame]:
    """Written subtrees over (grp, pos, of, digest) and, in the first tier only, lists of ``extra`` columns (name: type)."""
    made = []
    while True:
        held = tuple(extra) if not made else ()

        def build(table: pa.Table) -> pa.Table:
            table = table.sort_by("pos").combine_chunks()
            n, of = len(table), table["of"][0].as_py()
            tree, root = grown([x.encode() for x in table["digest"].to_pylist()], levels_of(n, of, height))
            row = {"grp": table["grp"][:1], "block": table["block"][:1], "of": table["of"][:1], "n": pa.array([n], pa.int32()), "tree": pa.array([tree], pa.binary()), "root": pa.array([root.decode()])}
            lists = {c: pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), table[c].combine_chunks()) for c in held}
            return pa.table(row | lists)

        schema = ", ".join([_TIER, *[f"{c} array<{extra[c]}>" for c in held]])
        cut = nodes.select("grp", "pos", "of", "digest", *held, F.shiftright("pos", height).alias("block"))
        made.append(materialize(cut.groupBy("grp", "block").applyInArrow(build, schema), name))
        upper = made[-1].where(F.col("of") > 1 << height)
        if upper.isEmpty():
            return made
        nodes = upper.select("grp", F.col("block").alias("pos"), F.shiftright(F.col("of") + ((1 << height) - 1), height).alias("of"), F.col("root").alias("digest"))


def build(rows: DataFrame, height: int = HEIGHT) -> Manifest:
    """The manifest of (grp string, id long, leaf string, claim string).

    In a group leaves ascend by id, null first, then by leaf and claim; groups ascend
    bytewise, null first. claim, which may be null, is a digest to be checked later against
    the row's place. ``rows`` is read once. A group of one row has that leaf as its root, and
    one group alone its root as the whole's. Repeated rows are leaves of their own.
    """
    once = materialize(rows.select("grp", "id", "leaf", "claim", F.monotonically_increasing_id().alias("copy")), "leaves")
    order = [F.col(c).asc_nulls_first() for c in ("grp", "id", "leaf", "claim", "copy")]
    placed = numbered(once, order, "place", "leaves")
    sizes = materialize(placed.groupBy("grp").agg(F.count(F.lit(1)).alias("of"), F.min("place").alias("first")), "groups")
    n_rows = sizes.agg(F.coalesce(F.sum("of"), F.lit(0))).first()[0]
    # no group is met in one task: large ones come to the rows
    nodes = join_hot(placed, sizes.withColumn("n", F.col("of")), ["grp"], "n", n_rows)
    nodes = nodes.select("grp", "id", "claim", "of", (F.col("place") - F.col("first")).alias("pos"), F.col("leaf").alias("digest"))
    tiers = _tiers(nodes, {"id": "bigint", "claim": "string"}, "subtrees", height)
    tops = [t.where(F.col("of") <= 1 << height).select("grp", "root") for t in tiers]
    groups = materialize(numbered(materialize(reduce(DataFrame.unionByName, tops), "roots"), [F.col("grp").asc_nulls_first()], "pos", "roots"), "roots")
    upper = groups.select(F.lit(None).cast("string").alias("grp"), "pos", F.lit(groups.count()).cast("long").alias("of"), F.col("root").alias("digest"))
    group_tiers = _tiers(upper, {}, "subtrees", height)
    last = group_tiers[-1].first()
    return Manifest(tiers, groups, group_tiers, last.root if last else None, height)


def _below(blocks: DataFrame, height: int) -> DataFrame:
    """(grp, pos, subroot, siblings, sides) of each node under stored subtrees that have their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                out = [(r["grp"], (r["block"] << height) + k, r["subroot"], (b"".join(own)).decode() + r["siblings"], sides + r["sides"]) for k, (_, own, sides) in enumerate(paths(r["tree"], r["n"], levels_of(r["n"], r["of"], height)))]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()), strict=True)], names=["grp", "pos", "subroot", "siblings", "sides"])

    return blocks.select("grp", "block", "of", "n", "tree", "subroot", "siblings", "sides").mapInArrow(run, "grp string, pos long, subroot string, siblings string, sides string")


def _down(tiers: list[DataFrame], tops: DataFrame, height: int) -> DataFrame:
    """The first tier's subtrees with the way from each one's root upwards; ``tops`` (grp, subroot, siblings, sides) has a group's own."""
    below = None
    for t in reversed(tiers):
        # a group has one topmost subtree and each (group, block) is there once: no key repeats
        top = t.where(F.col("of") <= 1 << height).alias("t").join(tops.alias("w"), F.col("t.grp").eqNullSafe(F.col("w.grp"))).select("t.*", "subroot", "siblings", "sides")
        if below is not None:
            inner = t.where(F.col("of") > 1 << height).alias("t").join(below.alias("w"), F.col("t.grp").eqNullSafe(F.col("w.grp")) & (F.col("block") == F.col("pos")))
            top = top.unionByName(inner.select("t.*", "subroot", "siblings", "sides"))
        below = _below(top, height)
    return top


def proofs(manifest: Manifest) -> DataFrame:
    """(grp, id, leaf, subroot, root, siblings, sides, folded_root) of every leaf.

    siblings is the hex text of the digests met on the way up, one after another, and sides
    says for each level whether the sibling stands left (l), right (r) or is missing (-).
    folded_root is worked out afresh from the claim, or else the leaf, and the siblings.
    """
    root, height = manifest.root, manifest.height
    start = manifest.groups.select(F.lit(None).cast("string").alias("grp"), F.lit(None).cast("string").alias("subroot"), F.lit("").alias("siblings"), F.lit("").alias("sides")).limit(1)
    ways = _below(_down(manifest.group_tiers, start, height), height).select("pos", "siblings", "sides")
    tops = materialize(manifest.groups.join(ways, "pos").select("grp", F.col("root").alias("subroot"), "siblings", "sides"), "ways")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                own = list(paths(r["tree"], r["n"], levels_of(r["n"], r["of"], height)))
                leaves = [x.decode() for x, _, _ in own]
                siblings = [b"".join(s).decode() + r["siblings"] for _, s, _ in own]
                sides = [s + r["sides"] for _, _, s in own]
                folded = [fold((c or x).encode(), s.encode(), d).decode() for c, x, s, d in zip(r["claim"], leaves, siblings, sides, strict=True)]
                n = r["n"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["grp"]] * n, pa.string()), pa.array(r["id"], pa.int64()), *[pa.array(x, pa.string()) for x in (leaves, [r["subroot"]] * n, [root] * n, siblings, sides, folded)]],
                    names=["grp", "id", "leaf", "subroot", "root", "siblings", "sides", "folded_root"],
                )

    return _down(manifest.tiers, tops, height).mapInArrow(run, "grp string, id long, leaf string, subroot string, root string, siblings string, sides string, folded_root string")


def verify(docs: DataFrame, claimed: dict[str, Column], columns: tuple[str, ...] = COLUMNS, id_col: str = "doc_id", group_col: str = "lang") -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified): each row of ``docs`` checked against their manifest.

    ``claimed`` gives other values of some columns, null for "as stored"; where a row has any, its claim
    is the digest with them, which doesn't fold to the root. An empty table gives no rows.
    Columns but those hashed, the id and the group aren't read.
    """
    told = F.lit(False)
    for c in claimed.values():
        told = told | c.isNotNull()
    values = [F.coalesce(claimed[c], F.col(c)) if c in claimed else F.col(c) for c in columns]
    rows = docs.select(F.col(group_col).cast("string").alias("grp"), F.col(id_col).cast("long").alias("id"), leaf([F.col(c) for c in columns]).alias("leaf"), F.when(told, leaf(values)).alias("claim"))
    found = proofs(build(rows))
    return found.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.sha2(F.col("siblings").cast("binary"), 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def tampered(id_col: str = "doc_id", n_col: str = "n_chars", every: int = 7) -> dict[str, Column]:
    """One more character claimed where ``every`` divides the CRC-32 of the decimal id; null ids and counts stay."""
    return {n_col: F.when(F.crc32(F.col(id_col).cast("string").cast("binary")) % every == 0, F.col(n_col) + 1)}
