"""Levenberg-Marquardt by groups against a plain loop over each group."""

import numpy as np
import pytest
from framequery.operators import levenberg
from framequery.operators.levenberg import Settings, perspective_field
from framequery.plans import calibration


def plain(rows, params, model, s):
    """One group's fit; also (cost, damping) after every trial."""

    def at(p):
        loss, g, h = 0.0, np.zeros(len(p)), np.zeros((len(p), len(p)))
        for (r, j), scale in zip(model(rows, np.tile(p, (len(next(iter(rows.values()))), 1))), s.scales, strict=True):
            x = (r * r).sum(1)
            w = np.ones_like(x) if scale is None else np.where(x <= scale**2, 1.0, scale / np.sqrt(np.maximum(x, 1e-300)))
            loss += (x if scale is None else np.where(x <= scale**2, x, 2 * scale * np.sqrt(x) - scale**2)).mean()
            g += np.einsum("n,nm,nmk->k", w, r, j)
            h += np.einsum("n,nma,nmb->ab", w, j, j)
        return loss, g, h

    lam, steps = s.damping, 0
    cost, g, h = at(params)
    while steps < s.most_steps:
        d = np.maximum(np.diag(h) * lam, s.eps)
        trial = params + np.linalg.solve(h + np.diag(d), -g)
        new, g2, h2 = at(trial)
        steps += 1
        better, high = new <= cost, lam >= s.most
        lam = float(np.clip(lam * (0.1 if better else 10), s.least, s.most))
        old = cost
        if better or not s.refuse:
            params, cost, g, h = trial, new, g2, h2
            if abs(new - old) <= s.atol + s.rtol * abs(old):
                return params, cost, steps, True
        elif high:
            return params, cost, steps, True
    return params, cost, steps, False


def curve(columns, params):
    """y = a exp(b x): rough enough that trials get refused."""
    e = np.exp(np.clip(params[:, 1] * columns["x"], -50, 50))
    return [((params[:, 0] * e - columns["y"])[:, None], np.stack([e, params[:, 0] * columns["x"] * e], 1)[:, None, :])]


@pytest.mark.parametrize("refuse", [True, False])
def test_many_groups_equal_plain_loops(spark, refuse):
    rng = np.random.default_rng(5)
    data, start = [], []
    for k in range(300):
        x = np.linspace(-1, 2, 5 + k % 7)
        y = rng.uniform(0.5, 3) * np.exp(rng.uniform(-1, 1.5) * x) + 0.05 * rng.normal(size=len(x))
        data += [(k, float(a), float(b), "extra") for a, b in zip(x, y, strict=True)]
        start.append((k, [float(rng.uniform(0.1, 4)), float(rng.uniform(-3, 3))]))
    start += [(1000, [1.0, 1.0]), (None, [1.0, 1.0])]  # without rows, without a group
    rows = spark.createDataFrame(data, "grp long, x double, y double, cost string").drop("cost")
    s = Settings(refuse=refuse, most_steps=12)
    got = {r.grp: r for r in levenberg.fit(rows, spark.createDataFrame(start, "grp long, params array<double>"), "grp", curve, s).collect()}
    assert sorted(got) == list(range(300))
    refused = 0
    for k in range(300):
        own = {c: np.array([d[n] for d in data if d[0] == k]) for n, c in ((1, "x"), (2, "y"))}
        params, cost, steps, done = plain(own, np.array(start[k][1]), curve, s)
        assert got[k].cost == pytest.approx(cost, rel=1e-6, abs=1e-9)
        assert got[k].params == pytest.approx(params.tolist(), rel=1e-4, abs=1e-6)
        refused += got[k].damping > 1e-6
        if abs(got[k].steps - steps) == 0:
            assert got[k].converged == done
    assert refused > 10


def test_calibration_recovers_planted_cameras(spark):
    want = [(k, 0.02 * k - 0.3, 0.3 - 0.015 * k, 6.0 + 0.1 * k) for k in range(40)]
    px = [(k, u + 0.5, v + 0.5, r, p, f) for k, r, p, f in want for u in range(-4, 4) for v in range(-4, 4)]
    rows = calibration.up_and_latitude(spark.createDataFrame(px, "k long, u double, v double, roll double, pitch double, focal double")).drop("roll", "pitch", "focal")
    start = spark.createDataFrame([(k, [0.0, 0.0, float(np.log(8))]) for k, *_ in want], "k long, params array<double>")
    found = {r.k: r for r in levenberg.fit(rows, start, "k", perspective_field, Settings(scales=(0.01, 0.01), atol=1e-14)).collect()}
    for k, r, p, f in want:
        assert found[k].converged and found[k].cost < 1e-10
        assert [found[k].params[0], found[k].params[1], np.exp(found[k].params[2])] == pytest.approx([r, p, f], abs=1e-4)


def test_jacobians_are_derivatives():
    rng = np.random.default_rng(3)
    n = 50
    columns = {c: rng.normal(size=n) for c in ("u", "v", "up_u", "up_v", "sin_lat")}
    params = rng.normal(size=(n, 3)) * 0.3 + [0, 0, 2]
    for kind in range(2):
        _, j = perspective_field(columns, params)[kind]
        for k in range(3):
            step = np.zeros(3)
            step[k] = 1e-6
            hi, lo = (perspective_field(columns, params + s * step)[kind][0] for s in (1, -1))
            assert np.allclose((hi - lo) / 2e-6, j[:, :, k], atol=1e-6)


def test_edge_cases(spark):
    rows = spark.createDataFrame([("a", float("nan"), 1.0), ("b", 0.0, 2.0), (None, 1.0, 1.0)], "g string, x double, y double")
    start = spark.createDataFrame([("a", [1.0, 1.0]), ("b", [1.0, 1.0]), (None, [1.0, 1.0])], "g string, params array<double>")
    got = {r.g: r for r in levenberg.fit(rows, start, "g", curve).collect()}
    assert set(got) == {"a", "b"} and got["b"].params[0] == pytest.approx(2.0, abs=1e-3)
    assert levenberg.fit(rows.limit(0), start, "g", curve).count() == 0
    assert levenberg.fit(rows, start.limit(0), "g", curve).count() == 0
