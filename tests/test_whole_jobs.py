"""Queries on tables that reach beyond the given ones, against plain versions."""

import math

import numpy as np

from framequery.operators import lookups
from framequery.plans import maps, windows


def test_ema_scale_of_a_long_stream(spark, monkeypatch):
    score = [(k * 7919 % 1000) / 100 for k in range(3000)]
    long = spark.createDataFrame([(1, k, x) for k, x in enumerate(score)], "stream_id long, frame_idx long, score double")
    monkeypatch.setattr(windows, "streams", lambda *_: long)
    got = {r.frame_idx: r.ema for r in windows.ema_scale(spark, "").collect()}
    assert len(got) == 3000
    ema = math.log(1 + score[0])
    for k, x in enumerate(score):
        ema = 0.9 * ema + 0.1 * math.log(1 + x) if k else ema
        assert abs(got[k] - ema) < 1e-4


def test_k_nearest_at_any_distance(spark):
    at = [(0.001 * k, 0.0, 0.0) for k in range(8)] + [(0.05, 0.0, 0.0), (3.0, 1.0, 0.0), (-40.0, 2.0, 7.0), (0.0, 500.0, 0.0)]
    frame = lambda p: spark.createDataFrame([(k, *x) for k, x in enumerate(at)], f"{p}_id long, {p}_x double, {p}_y double, {p}_z double")
    got = {(r.q_id, r.rank): r.p_id for r in lookups.k_nearest_whole(frame("q"), frame("p"), 4, 0.01).collect()}
    d2 = lambda a, b: sum(((x - y) * (x - y) for x, y in zip(a, b, strict=True)), 0.0)
    want = {(i, n + 1): j for i, a in enumerate(at) for n, (_, j) in enumerate(sorted((d2(a, b), j) for j, b in enumerate(at))[:4])}
    assert got == want


def test_cells_narrow_where_points_are_dense(spark, monkeypatch):
    """Many points and copies in one cell: the first cell narrows, and the nearest are the same."""
    rng = np.random.default_rng(12)
    at = [*rng.uniform(0, 0.009, (400, 3)).tolist(), *[[0.001, 0.002, 0.003]] * 60, [0.5, 0.5, 0.5]]
    rows = [(k, *x) for k, x in enumerate(at)]
    frame = lambda side: spark.createDataFrame(rows, f"{side}_id long, {side}_x double, {side}_y double, {side}_z double")
    cells, plain = [], lookups.k_nearest

    def noted(queries, points, k, cell, *more):
        cells.append((cell, points.count()))
        return plain(queries, points, k, cell, *more)

    monkeypatch.setattr(lookups, "k_nearest", noted)
    got = {(r.q_id, r["rank"]): r.p_id for r in lookups.k_nearest_whole(frame("q").where("q_id % 20 = 0"), frame("p"), 4, 0.01, dense=True).collect()}
    assert cells[0][0] < 0.006 and cells[0][1] == 400 + 4 + 1
    p = np.array(at)
    for q in range(0, len(at), 20):
        d = ((p - p[q]) ** 2).sum(1)
        assert [got[q, n + 1] for n in range(4)] == sorted(range(len(at)), key=lambda k: (d[k], k))[:4]


def test_nearest_lists_at_any_distance(spark):
    """Pixels of several cells, groups with few points or none, and queries that only wider cells answer."""
    rng = np.random.default_rng(14)
    at = {f: [(r, c) for r in range(9) for c in range(14)] for f in (1, 2, 3)}
    some = {1: rng.choice(126, 40, replace=False).tolist(), 2: [0, 5], 3: []}
    q = spark.createDataFrame([(f, k, *x) for f in at for k, x in enumerate(at[f])], "f long, q_id long, q_r long, q_c long")
    p = spark.createDataFrame([(f, k, *at[f][k], f"{f}-{k}") for f in at for k in some[f]], "f long, p_id long, p_r long, p_c long, name string")
    want = {}
    for f in (1, 2):
        for n, (r, c) in enumerate(at[f]):
            want[f, n] = sorted((float((r - at[f][k][0]) ** 2 + (c - at[f][k][1]) ** 2), k, f"{f}-{k}") for k in some[f])[:3]
    for cell in (2.0, 4.0, 32.0):
        rows = lookups.nearest_lists(q, p, 3, cell, ("r", "c"), ("f",), ("name",)).collect()
        assert len(rows) == len(want) and {(x.f, x.q_id): [tuple(y) for y in x.near] for x in rows} == want


def test_small_frames_meet_as_lists(spark, sf, monkeypatch):
    """Frames no wider than a cell are fitted and filled without a row a pair of pixels."""
    monkeypatch.setattr(lookups, "k_nearest", lambda *_: 1 / 0)
    assert maps.knn_weighted_fit(spark, sf).count() == 500 * 64
    assert maps.map_infill_nn(spark, sf).count() > 0
