"""Entropy balancing against a plain solution of the same problem."""

import math
import re

import pytest
from framequery.llm import mixing


def plain_targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, target, free = 1.5 * sum(sizes.values()), {}, set(names)
    while free:
        w = sum(weight[s] for s in free)
        full = {s for s in free if left * weight[s] / w > 2 * sizes[s]}
        if not full:
            target |= {s: left * weight[s] / w for s in free}
            break
        target |= {s: 2.0 * sizes[s] for s in full}
        left -= sum(2 * sizes[s] for s in full)
        free -= full
    return target


def held(rows, docs):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes, largest, by_source = {}, {}, {}
    for _, t, s in docs:
        sizes[s] = sizes.get(s, 0) + size(t)
        largest[s] = max(largest.get(s, 0), size(t))
    want = plain_targets(sizes)
    assert sorted((str(r.doc_id), r["size"]) for r in rows) == sorted((str(i), size(t)) for i, t, _ in docs)
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert math.isclose(r.target, want[r.source], rel_tol=1e-9, abs_tol=1e-9)
        assert 0 <= r.taken <= 2 * r["size"] and (r["size"] == 0 or r.taken % r["size"] == 0)
        by_source.setdefault(r.source, []).append(r)
    for s, of in by_source.items():
        assert abs(sum(r.taken for r in of) - want[s]) <= 1e-6 * want[s] + 2 * largest[s]
    return by_source


def test_whole_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = mixing.mixture(docs).collect()
    by_source = held(rows, [tuple(r) for r in docs.select("doc_id", "text", "source").collect()])
    # rates are one exponential of size: within a source, mean copies rise or fall with size throughout
    for of in by_source.values():
        of.sort(key=lambda r: r["size"])
        half = len(of) // 2
        low, high = (sum(r.copies for r in part) / len(part) for part in (of[:half], of[half:]))
        assert abs(low - high) < 0.35 or (high > low) == (of[0].target > of[0].source_size)
    assert sorted(rows) == sorted(mixing.mixture(docs.repartition(7)).collect())


def test_rates_solve_the_dual(spark):
    counts = spark.createDataFrame([("a", s, 10 + s) for s in range(1, 60)] + [("b", 5, 3)], "source string, size long, n long")
    total = sum((10 + s) * s for s in range(1, 60))
    for part in (0.01, 0.4, 1.0, 1.7, 1.999):
        goals = spark.createDataFrame([("a", total, part * total), ("b", 15, 30.0)], "source string, source_size long, target double")
        found = {r.source: r for r in mixing.balance(counts, goals).collect()}
        r = found["a"]
        taken = sum((10 + s) * s * min(2, math.exp(r.multiplier * s / r.scale)) for s in range(1, 60))
        assert taken == pytest.approx(part * total, rel=1e-6)
        assert found["b"].multiplier is None


def test_edge_cases(spark):
    docs = [(1, None, "a"), (2, "", "a"), (3, "w " * 20_000, None), (4, "x y", "b"), (4, "x y", "b"), (4, "x y", "b"), (None, "one two three", "b"), (5, "p q\tr\ns", "Z"), (6, "é", "é"), (7, "u v w", "")]
    df = spark.createDataFrame([(*d, "e", 1) for d in docs], "doc_id long, text string, source string, size string, copies int")
    held(mixing.mixture(df).collect(), docs)
    assert mixing.mixture(df.limit(0)).count() == 0
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns
    rows = {}
    for r in mixing.mixture(df).collect():
        rows[r.doc_id] = rows.get(r.doc_id, 0) + r.copies
    assert {k: v for k, v in rows.items() if v} == {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
