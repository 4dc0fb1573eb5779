"""SimHash near-duplicates against brute force over all pairs of fingerprints."""

import re
from itertools import combinations

import numpy as np
import xxhash
from framequery.llm import simhash
from framequery.llm.components import connected_components


def plain_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps, ids):
    parent = {f: f for f in fps}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for a, b in combinations(set(fps), 2):
        if bin(a ^ b).count("1") <= 4:
            parent[root(a)] = root(b)
    low = {}
    for f, i in zip(fps, ids, strict=True):
        if i is not None:
            low[root(f)] = min(i, low.get(root(f), i))
    return [low.get(root(f)) for f in fps]


def held(df, rows):
    fps = [plain_fingerprint(t) for _, t in rows]
    want = [(i, f"{f:016x}", c) for (i, _), f, c in zip(rows, fps, plain_components(fps, [i for i, _ in rows]), strict=True)]
    got = [tuple(r) for r in df.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_every_four_positions_hold_a_triple():
    triples = [set(t) for t in simhash.turan_triples()]
    assert len(triples) == 20
    assert all(any(t <= set(four) for t in triples) for four in combinations(range(8), 4))


def test_whole_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    held(simhash.near_duplicates(docs), rows)


def test_edge_cases(spark):
    long = "Word " * 30_000
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (5, "one"), (None, "one"), (None, "lonely text here"), (7, long), (8, long + "x"), (9, "Éa b c d"), (10, "éa b c d")]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, fp string, component_id int")
    held(simhash.near_duplicates(docs), rows)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} >= {1, 4, None}


def test_dense_cluster_spans_blocks(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 16)
    rng = np.random.default_rng(5)
    centre = int(rng.integers(1 << 62))
    fps = {centre} | {centre ^ sum(1 << int(b) for b in rng.choice(64, 3, replace=False)) for _ in range(150)}
    fps = sorted(f - (1 << 64) if f >> 63 else f for f in fps)
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    edges = simhash.links(df)
    roots = {r.root for r in connected_components(edges).collect()}
    assert len(roots) == 1


def test_lists_of_several_clusters_link_exactly(spark, monkeypatch):
    """Fingerprints that share three bytes and form chains and clusters, against all pairs."""
    monkeypatch.setattr(simhash, "BLOCK", 8)
    rng = np.random.default_rng(8)
    fps = {0xABCDEF << 40 | int(rng.integers(1 << 12)) << int(rng.integers(28)) for _ in range(250)}
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    found = {r.vertex % (1 << 64): r.root % (1 << 64) for r in connected_components(simhash.links(df)).collect()}
    parts = {}
    for f in fps:
        parts.setdefault(found.get(f, f), set()).add(f)
    want = {}
    for f, low in zip(sorted(fps), plain_components(sorted(fps), list(range(len(fps)))), strict=True):
        want.setdefault(low, set()).add(f)
    assert sorted(map(sorted, parts.values())) == sorted(map(sorted, want.values()))


def test_keep_one_tells_rows_apart(spark):
    a, b = "the first text has these words in it", "quite other words stand here instead of those"
    rows = [(1, a, "en"), (1, b, "en"), (2, a, "en"), (3, b, "de"), (3, b, "de"), (None, a, "en"), (None, "a third text that nothing else is like", "fr"), (5, None, "x"), (4, None, "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = sorted(map(tuple, simhash.keep_one(df).collect()), key=str)
    assert got == sorted([(1, a, "en"), (1, b, "en"), (None, "a third text that nothing else is like", "fr"), (4, None, "y")], key=str)
