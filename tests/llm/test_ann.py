"""Multiprobe hashing: exact scores and order of what is found, and recall against brute force."""

import math
from itertools import product

import numpy as np
import pytest
from framequery.llm import ann
from pyspark.sql import functions as F


def brute(ids, x, queries, k=20):
    s = x[queries] @ x.T
    out = {}
    for row, q in zip(s, queries, strict=True):
        order = sorted((-v, i) for v, i in zip(row, ids, strict=True) if i != ids[q])
        out[int(ids[q])] = [int(i) for _, i in order[:k]]
    return out


def held(got, ids, x, queries, recall):
    place = {int(i): n for n, i in enumerate(ids)}
    want = brute(ids, x, queries)
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append(r)
    assert set(by) == {q for q, near in want.items() if near}
    hits = 0
    for q, rows in by.items():
        rows.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in rows] == list(range(1, len(want[q]) + 1))
        assert rows == sorted(rows, key=lambda r: (-r.score, r.vec_id))
        assert all(math.isclose(r.score, float(x[place[q]] @ x[place[r.vec_id]]), rel_tol=1e-12, abs_tol=1e-14) for r in rows)
        hits += len({r.vec_id for r in rows} & set(want[q]))
    assert hits >= recall * sum(map(len, want.values()))


@pytest.mark.parametrize(("folder", "shelf"), [(None, ann.SHELF_BYTES), ("/root/testdata/sf0.1", ann.SHELF_BYTES), ("/root/testdata/sf0.1", 1 << 10)])
def test_whole_table(spark, sf, monkeypatch, folder, shelf):
    """The registered setting, on 500 and 2,000 vectors, and with many small shelves."""
    monkeypatch.setattr(ann, "SHELF_BYTES", shelf)
    df = spark.read.parquet(f"{folder or sf}/embeddings.parquet")
    rows = df.orderBy("vec_id").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    got = ann.nearest(df, F.col("vec_id") % 20 == 0).collect()
    held(got, ids, x, np.flatnonzero(ids % 20 == 0), 0.9)


def shares(x, queries, k=20):
    """Share of rows scored and recall of the queries, from the registered index alone."""
    norm2 = float((x * x).sum(axis=1).max())
    index = ann.fit(x[: ann.SAMPLE_ROWS], len(x), norm2, k)
    assert index.a.shape[0] == ann.TABLES and index.a.shape[1] >= ann.LEAST_HASHES
    codes = index.codes(x)
    share, recall = [], []
    for q in queries:
        seen = np.zeros(len(x), bool)
        for t, visits in enumerate(index.probes(x[q])):
            seen |= np.isin(codes[:, t], visits)
        s = x @ x[q]
        s[q] = -np.inf
        share.append(seen.mean())
        recall.append(seen[np.argsort(-s, kind="stable")[:k]].mean())
    return np.mean(share), np.mean(recall)


def clustered(n, d=64):
    rng, clusters = np.random.default_rng(5), n // 50
    centres = rng.normal(size=(clusters, d))
    x = centres[rng.integers(0, clusters, n)] + 0.25 * rng.normal(size=(n, d))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def test_share_scored():
    """Neighbours that are near are found among few rows; of random vectors, whose neighbours are far, most must be scored."""
    rng = np.random.default_rng(6)
    for n, most in ((2000, 0.95), (20_000, 0.9)):
        random = rng.normal(size=(n, 64))
        share, recall = shares(random / np.linalg.norm(random, axis=1, keepdims=True), range(0, n, n // 100))
        assert recall >= 0.9 and share <= most
    for n, most in ((2000, 0.6), (20_000, 0.35)):
        share, recall = shares(clustered(n), range(0, n, n // 100))
        assert recall >= 0.9 and share <= most


def test_clustered_search(spark):
    x, ids = clustered(20_000), np.arange(20_000)
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x, strict=True)], "vec_id long, embedding array<double>")
    got = ann.nearest(df, F.col("vec_id") % 100 == 0).collect()
    held(got, ids, x, np.flatnonzero(ids % 100 == 0), 0.9)


def test_queries_that_meet_few_rows_search_all(spark, monkeypatch):
    monkeypatch.setattr(ann, "AIM", 0.0)
    monkeypatch.setattr(ann.Index.probes, "__defaults__", (0.0,))
    x, ids = clustered(500), np.arange(500)
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x, strict=True)], "vec_id long, embedding array<double>")
    got = ann.nearest(df, F.col("vec_id") % 50 == 0).collect()
    held(got, ids, x, np.flatnonzero(ids % 50 == 0), 1.0)


def test_lengths_that_differ_and_copies(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(700, 6)) * rng.uniform(0.2, 3, size=(700, 1))
    x[100:400] = x[100]
    ids = np.arange(700)
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x, strict=True)], "vec_id long, embedding array<double>")
    got = ann.nearest(df, F.col("vec_id") % 50 == 0).collect()
    held(got, ids, x, np.flatnonzero(ids % 50 == 0), 0.9)


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.0, 0.0]), (2, None), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (6, []), (7, [0.5, 0.5]), (7, [0.5, 0.5]), (None, [1.0, 1.0]), (8, [1.0, 2.0, 3.0]), (20, [1.0, 0.0]), (40, [-1.0, 0.0])]
    df = spark.createDataFrame([(*r, 1, 2.0) for r in rows], "vec_id long, embedding array<double>, rank int, score double")
    got = ann.nearest(df, F.col("vec_id") % 20 == 0).collect()
    found = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in got}
    assert found == {(0, 1): (20, 1.0), (0, 2): (7, 0.5), (0, 3): (40, -1.0), (20, 1): (0, 1.0), (20, 2): (7, 0.5), (20, 3): (40, -1.0), (40, 1): (7, -0.5), (40, 2): (0, -1.0), (40, 3): (20, -1.0)}
    assert ann.nearest(df.limit(0), F.lit(True)).count() == 0
    assert ann.nearest(df, F.lit(False)).count() == 0


def test_probes_come_in_falling_order():
    odds = [[(0.5, 2), (0.3, 0), (0.2, 1)], [(0.6, 1), (0.4, 0)], [(0.7, 0), (0.2, 1), (0.1, 2)]]
    p = {sum(c * m for c, m in zip((a[1], b[1], d[1]), (6, 3, 1), strict=True)): a[0] * b[0] * d[0] for a, b, d in product(*odds)}
    codes = ann._likeliest(odds, [3, 2, 3], 2.0)
    assert sorted(codes) == sorted(p) and [p[c] for c in codes] == pytest.approx(sorted(p.values(), reverse=True))
    some = ann._likeliest(odds, [3, 2, 3], 0.81)
    assert sum(p[c] for c in some) >= 0.81 > sum(p[c] for c in some[:-1])


@pytest.mark.parametrize("kind", ["huge", "tiny", "mixed", "far apart"])
def test_any_finite_norms(spark, kind):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(600, 8))
    x /= np.linalg.norm(x, axis=1)[:, None]
    if kind == "huge":
        x *= 1e150
    elif kind == "tiny":
        x *= 1e-150
    elif kind == "mixed":
        x *= 10.0 ** rng.uniform(-2, 2, size=(600, 1))
    else:
        x = np.array([[1e200 * (n + 1), 1e200] if n % 2 else [1e-170 * (n + 1), 1e-170] for n in range(60)])
    rows = spark.createDataFrame([(n, v.tolist()) for n, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = ann.nearest(rows, F.col("vec_id") % 20 == 0).collect()
    ids, queries = np.arange(len(x)), np.arange(0, len(x), 20)
    with np.errstate(over="ignore"):
        held(got, ids, x, queries, 0.8 if kind == "far apart" else 0.9)
