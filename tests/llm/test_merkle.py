"""The manifest against plain trees, its layout against the recursive definition."""

import hashlib
import zlib

import numpy as np
import pytest
from framequery.llm import merkle
from pyspark.sql import functions as F


def h(x):
    return hashlib.sha256(x.encode()).hexdigest()


def leaf(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(leaves):
    """All levels of a tree, lowest first."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        now = levels[-1]
        levels.append([h("".join(now[k : k + 2])) for k in range(0, len(now), 2)])
    return levels


def path(levels, k):
    out = []
    for now in levels[:-1]:
        out.append((now[k ^ 1] if k ^ 1 < len(now) else None, k & 1))
        k >>= 1
    return out


def up(digest, steps):
    for sibling, right in steps:
        digest = h(digest if sibling is None else sibling + digest if right else digest + sibling)
    return digest


def plain(rows):
    """Rows (doc_id, source, lang, n_chars, text) to the query's result."""
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    own = {g: sorted((r for r in rows if r[2] == g), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for g in langs}
    trees = {g: tree([leaf(r) for r in own[g]]) for g in langs}
    top = tree([trees[g][-1][0] for g in langs])
    out = []
    for j, g in enumerate(langs):
        for k, r in enumerate(own[g]):
            steps = path(trees[g], k) + path(top, j)
            told = list(r)
            if r[0] is not None and r[3] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0:
                told[3] += 1
            root, folded = top[-1][0], up(leaf(told), steps)
            assert up(leaf(r), steps) == root
            out.append((r[0], leaf(r), trees[g][-1][0], root, h("".join(s for s, _ in steps if s)), folded, folded == root))
    return sorted(out, key=str)


def checked(docs):
    found = merkle.verify(docs, merkle.tampered())
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got = sorted((tuple(r) for r in found.collect()), key=str)
    assert got == plain([tuple(r) for r in docs.select(*merkle.COLUMNS).collect()])
    return got


def test_whole_table(spark, sf):
    got = checked(spark.read.parquet(f"{sf}/documents.parquet"))
    assert 0 < sum(not r[-1] for r in got) < len(got) / 3


def test_edge_cases(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, root string, grp int, tree double"
    rows = [(1, None, None, None, None), (2, "", None, "s", 0), (None, "x", "en", None, 3), (None, "y", "en", None, None), (7, "w " * 50_000, "Z", "é", 9), (7, "same", "é", "s", 4), (7, "same", "é", "s", 4), (7, "same", "é", "s", 4), (8, "same", "é", "s", 4), (-9, "q", "", "s", 1)]
    docs = spark.createDataFrame([(*r, "r", 1, 0.5) for r in rows], schema)
    checked(docs)
    checked(docs.where("doc_id = 8"))
    assert merkle.verify(docs.limit(0), merkle.tampered()).count() == 0


def test_subtree_bounds(spark):
    sizes = {"a": 1, "b": 2, "c": 3, "d": 1023, "e": 1024, "f": 1025, "g": 2051}
    rows = [(k, "s", g, k, f"{g}{k}") for g, n in sizes.items() for k in range(n)]
    checked(spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5, F.col("doc_id") % 5))


@pytest.mark.parametrize("height", [1, 2, 3])
def test_many_tiers(spark, height):
    rows = [(g, k, h(f"{g}{k}"), None if k % 3 else h("other")) for g, n in (("a", 1), ("b", 2), ("c", 4), ("d", 9), ("e", 65), (None, 27)) for k in range(n)]
    found = merkle.proofs(merkle.build(spark.createDataFrame(rows, "grp string, id long, leaf string, claim string"), height)).collect()
    trees = {g: tree([r[2] for r in rows if r[0] == g]) for g in (None, "a", "b", "c", "d", "e")}
    top = tree([t[-1][0] for t in trees.values()])
    assert len(found) == len(rows)
    for r in found:
        steps = path(trees[r.grp], r.id) + path(top, list(trees).index(r.grp))
        assert (r.leaf, r.subroot, r.root, r.siblings) == (trees[r.grp][0][r.id], trees[r.grp][-1][0], top[-1][0], "".join(s for s, _ in steps if s))
        assert r.sides == "".join("-" if s is None else "l" if right else "r" for s, right in steps)
        assert r.folded_root == up(r.leaf if r.id % 3 else h("other"), steps)


def order(levels, depth=0, index=0):
    """Nodes in van Emde Boas order by the recursive definition."""
    if levels == 1:
        return [(depth, index)]
    upper = levels // 2
    out = order(upper, depth, index)
    for k in range(1 << upper):
        out += order(levels - upper, depth + upper, (index << upper) + k)
    return out


@pytest.mark.parametrize("levels", range(1, 12))
def test_layout(levels):
    nodes = order(levels)
    assert merkle.address(np.array([d for d, _ in nodes]), np.array([k for _, k in nodes]), levels).tolist() == list(range((1 << levels) - 1))
