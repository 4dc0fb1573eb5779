"""Nested block elimination against dense solutions."""

import numpy as np
import pytest
from framequery.operators import elimination as e


def system(rng, n, edges, shared=()):
    """A positive definite block system: variables 0..n-1 and shared negative ones, coupled along edges."""
    ids = list(shared) + list(range(n))
    at = {v: k for k, v in enumerate(ids)}
    a = np.zeros((len(ids) * 6, len(ids) * 6))
    for p, q in edges:
        j = rng.normal(size=(6, 12))
        rows = np.r_[6 * at[p] : 6 * at[p] + 6, 6 * at[q] : 6 * at[q] + 6]
        a[np.ix_(rows, rows)] += j.T @ j
    a += 0.5 * np.eye(len(a))
    return ids, a, rng.normal(size=len(a))


def rows_of(graph, ids, a, b):
    order = sorted(ids)
    at = {v: k for k, v in enumerate(ids)}
    blocks = []
    for x, p in enumerate(order):
        for q in order[x:]:
            h = a[6 * at[p] : 6 * at[p] + 6, 6 * at[q] : 6 * at[q] + 6]
            if p == q or np.any(h):
                blocks.append((graph, p, q, *map(float, h.ravel())))
    return blocks, [(graph, p, *map(float, b[6 * at[p] : 6 * at[p] + 6])) for p in order]


def solved(spark, systems):
    blocks, sides = [], []
    for graph, (ids, a, b) in systems.items():
        own = rows_of(graph, ids, a, b)
        blocks += own[0]
        sides += own[1]
    names = lambda c: ", ".join(f"{x} double" for x in c)
    got = e.solve(spark.createDataFrame(blocks, "graph long, p long, q long, " + names(e.H)), spark.createDataFrame(sides, "graph long, p long, " + names(e.G))).collect()
    return {(r.graph, r.p): list(r[2:]) for r in got}


def test_levels_shared_columns_and_loops(spark):
    rng = np.random.default_rng(1)
    chain = [(k, k + d) for k in range(700) for d in (1, 2, 3) if k + d < 700]
    systems = {
        0: system(rng, 700, chain + [(3, 650), (70, 400), *[(-1, k) for k in range(700)], *[(-2, k) for k in range(0, 700, 3)]], (-2, -1)),
        1: system(rng, 5, [(0, 1), (1, 2), (2, 3), (3, 4), (-1, 2)], (-1,)),
        2: system(rng, 1, []),
        3: system(rng, 300, [(k, k + 1) for k in range(299)]),
    }
    got = solved(spark, systems)
    for graph, (ids, a, b) in systems.items():
        x = np.linalg.solve(a, b).reshape(-1, 6)
        for k, v in enumerate(ids):
            assert got.pop((graph, v)) == pytest.approx(x[k].tolist(), rel=1e-6, abs=1e-8)
    assert not got


def test_no_rows(spark):
    names = lambda c: ", ".join(f"{x} double" for x in c)
    blocks, sides = spark.createDataFrame([], "graph long, p long, q long, " + names(e.H)), spark.createDataFrame([], "graph long, p long, " + names(e.G))
    assert e.solve(blocks, sides).count() == 0


def test_five_thousand_keyframes(spark):
    rng = np.random.default_rng(2)
    n, blocks = 5000, {}
    for p in range(n):
        for q in [p + 1, p + 2, p + 3, *([4000] if p == 17 else [])]:
            if q < n:
                j = rng.normal(size=(6, 12))
                h = j.T @ j
                for a, b, v in ((p, p, h[:6, :6]), (p, q, h[:6, 6:]), (q, q, h[6:, 6:])):
                    blocks[a, b] = blocks.get((a, b), 0.1 * np.eye(6) if a == b else np.zeros((6, 6))) + v
    side = rng.normal(size=(n, 6))
    names = lambda c: ", ".join(f"{x} double" for x in c)
    rows = spark.createDataFrame([(0, p, q, *map(float, h.ravel())) for (p, q), h in blocks.items()], "graph long, p long, q long, " + names(e.H))
    found = e.solve(rows, spark.createDataFrame([(0, p, *map(float, s)) for p, s in enumerate(side)], "graph long, p long, " + names(e.G))).collect()
    x = np.zeros((n, 6))
    x[[r.p for r in found]] = [r[2:] for r in found]
    left = side.copy()
    for (p, q), h in blocks.items():
        left[p] -= h @ x[q]
        if p != q:
            left[q] -= h.T @ x[p]
    assert len(found) == n and np.abs(left).max() < 1e-8 * max(1, np.abs(x).max())
