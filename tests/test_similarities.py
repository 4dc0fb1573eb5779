"""Exponentials and logarithms of similarities, and inverse Jacobians, against matrix series."""

import numpy as np
from framequery.functions import geometry as g
from framequery.operators import resampling
from pyspark.sql import functions as F


def hat(v):
    return np.array([[0, -v[2], v[1]], [v[2], 0, -v[0]], [-v[1], v[0], 0]])


def expm(a):
    """The exponential of a matrix, by halving and its series."""
    out, term = np.eye(len(a)), np.eye(len(a))
    for k in range(1, 25):
        term = term @ (a / 64) / k
        out = out + term
    for _ in range(6):
        out = out @ out
    return out


def test_against_series(spark):
    rng = np.random.default_rng(12)
    x = [rng.normal(size=7) * s for s in (1.0, 0.3, 1e-3, 1e-5, 0.0) for _ in range(6)]
    x += [np.append(v[:6], 0.0) for v in x[:6]] + [np.array([*v[:3], 0, 0, 0, v[6]]) for v in x[:6]]
    df = spark.createDataFrame([(k, *map(float, v)) for k, v in enumerate(x)], "k long, " + ", ".join(f"x{n} double" for n in range(7)))
    c = [F.col(f"x{n}") for n in range(7)]
    s = g.sim3_exp(tuple(c[:3]), tuple(c[3:6]), c[6])
    made = df.select("k", *c, *[v.alias(n) for n, v in s.pose.named("p_").items()], s.scale.alias("s"), *[v.alias(f"j{n}") for n, v in enumerate(g.so3_jinv(tuple(c[3:6]), tuple(c[:3])))])
    tau, phi, sigma = g.sim3_log(g.Similarity(g.pose("p_"), F.col("s")))
    for r in made.select("*", *[v.alias(f"l{n}") for n, v in enumerate((*tau, *phi, sigma))]).collect():
        v = x[r.k]
        a = np.zeros((4, 4))
        a[:3, :3], a[:3, 3] = hat(v[3:6]) + v[6] * np.eye(3), v[:3]
        want = expm(a)
        assert np.allclose([r.p_tx, r.p_ty, r.p_tz], want[:3, 3], atol=1e-7) and np.isclose(r.s, np.cbrt(np.linalg.det(want[:3, :3])))
        assert np.allclose([r[f"l{n}"] for n in range(7)], v, atol=1e-6)
        left = sum((np.linalg.matrix_power(hat(v[3:6]), n) / np.prod(range(1, n + 2)) for n in range(25)), np.zeros((3, 3)))
        assert np.allclose([r.j0, r.j1, r.j2], np.linalg.solve(left, v[:3]), atol=1e-7)


def test_panorama_edges(spark):
    pano = spark.createDataFrame([(0, r, c, float(10 * r + c)) for r in range(2) for c in range(4)], "f long, pr long, pc long, v double")
    asked = spark.createDataFrame([(0, 1, 0.0, 0.5), (0, 2, 1.0, 0.5), (0, 3, 0.375, 0.0), (0, 4, 0.375, 1.0), (0, 5, None, 0.5), (0, 6, float("nan"), 0.5)], "f long, id long, u double, w double")
    got = {r.id: r.v for r in resampling.panorama_sampled(asked, pano, "f", "v", 2, 4).collect()}
    assert got == {1: 6.5, 2: 6.5, 3: 1.0, 4: 11.0, 5: None, 6: None}


def test_panorama_blocks(spark):
    """Places of a panorama of many blocks, pixels missing, null or given twice, without a row a pixel of a place."""
    rng = np.random.default_rng(15)
    height, width = 11, 19
    pixels = [(f, r, c, float(rng.normal())) for f in (0, 1) for r in range(height) for c in range(width) if rng.random() < 0.9]
    pixels += [(0, 3, 4, 2.5), (0, 5, 18, None), (None, 2, 2, 9.0)]
    v = {}
    for f, r, c, x in pixels:
        v[f, r, c] = v.get((f, r, c), 0.0) + (x or 0.0)
    places = [(int(f), k, float(u), float(w)) for k, (f, u, w) in enumerate(zip(rng.integers(0, 3, 400), rng.uniform(-0.2, 1.2, 400), rng.uniform(-0.2, 1.2, 400), strict=True))]
    pano = spark.createDataFrame(pixels, "f long, pr long, pc long, v double")
    found = resampling.panorama_sampled(spark.createDataFrame(places, "f long, id long, u double, w double"), pano, "f", "v", height, width)
    # before, places were dealt to their pixels and gathered by an Aggregate above the join
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan[: plan.index("Join LeftOuter")]
    got = {r.id: r.v for r in found.collect()}
    assert len(got) == 400
    for f, k, u, w in places:
        x, y = u * width - 0.5, w * height - 0.5
        x0, y0 = int(np.floor(x)), int(np.floor(y))
        want = sum((x - x0 if a else 1 - x + x0) * (y - y0 if b else 1 - y + y0) * v.get((f, max(0, min(height - 1, y0 + b)), (x0 + a) % width), 0.0) for a in (0, 1) for b in (0, 1))
        assert abs(got[k] - want) < 1e-12
