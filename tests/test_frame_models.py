"""Lever arms, chained tiles and correlation lookups against plain versions."""

import numpy as np
import pytest
from framequery.operators import correlation, tiles, trajectories
from pyspark.sql import functions as F


def rotation(q):
    x, y, z, w = q / np.linalg.norm(q)
    return np.array([[1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w)], [2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w)], [2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y)]])


@pytest.mark.parametrize("scaled", [True, False])
def test_lever_arms_are_recovered(spark, scaled):
    rng = np.random.default_rng(8)
    rows, want = [], {}
    for track in range(40):
        arm, shift, q0 = rng.normal(size=3), rng.normal(size=3), rng.normal(size=4)
        scale = rng.uniform(0.5, 3) if scaled else 1.0
        want[track] = arm
        for _ in range(30):
            p, q = 3 * rng.normal(size=3), rng.normal(size=4)
            q /= np.linalg.norm(q)
            b = scale * rotation(q0) @ (rotation(q) @ arm + p) + shift
            rows.append((track, *map(float, p), *map(float, q), *map(float, b)))
    rows.append((0, None, *rows[0][2:]))
    df = spark.createDataFrame(rows, "track long, tx double, ty double, tz double, qx double, qy double, qz double, qw double, b0 double, b1 double, b2 double")
    found = trajectories.lever_arms(df, "track", scaled).collect()
    assert len(found) == 40
    for r in found:
        assert r.n == 30 and [r.arm_x, r.arm_y, r.arm_z] == pytest.approx(want[r.track].tolist(), abs=1e-6) and r.error < 1e-5
    # a sensor that never turns tells no arm, but the transform still fits
    still = spark.createDataFrame([(1, float(k), float(k * k), 1.0, 0.0, 0.0, 0.0, 1.0, float(k) + 2, float(k * k), 1.0) for k in range(9)], df.schema)
    assert trajectories.lever_arms(still, "track", scaled).first().error < 1e-5
    assert trajectories.lever_arms(df.limit(0), "track", scaled).count() == 0


def chained(frames, spoil, t):
    """The plain fold over a stream: list of grids."""
    n, out, references = len(frames), [], []
    for tile in range(-(-n // t.stride)):
        places = [tile * t.stride + p for p in range(t.length)]
        if tile:
            places[: len(t.keys)] = [(tile - 1) * t.stride + k for k in t.keys]
        x = [spoil(tile, frames[min(f, n - 1)]) for f in places]
        if not references:
            out, references = x, [x[k] for k in t.keys]
            continue
        p, q = np.concatenate(x[: len(t.keys)]), np.concatenate(references)
        scale, shift = np.linalg.lstsq(np.stack([p, np.ones_like(p)], 1), q, rcond=None)[0]
        x = [np.maximum(v * scale + shift, 0) for v in x]
        for k in range(t.blend):
            w = k / (t.blend - 1)
            out[k - t.blend] = out[k - t.blend] * (1 - w) + x[t.overlap - t.blend + k] * w
        out += x[t.overlap :]
        references = [references[0], *[x[k] for k in t.keys[1:]]]
    return out[:n]


@pytest.mark.parametrize("lengths", [(3000, 1, 22, 33), (65,)])
def test_chained_tiles(spark, lengths):
    rng, t = np.random.default_rng(3), tiles.Tiling()
    streams = {k: [np.abs(rng.normal(size=4)) * (k + 1) for _ in range(n)] for k, n in enumerate(lengths)}
    spoil = lambda tile, x: x * (0.7 + 0.2 * (tile % 4)) - 0.1 * (tile % 3)
    rows = [(s, k, [float(v) for v in x], len(own) - 1) for s, own in streams.items() for k, x in enumerate(own)]
    frames = spark.createDataFrame(rows, "s long, k long, grid array<double>, last long").repartition(5)
    shown = tiles.tiled(frames, "s", "k", "last")
    assert shown.groupBy("s", "tile").count().where("count != 32").count() == 0
    seen = shown.select("s", "tile", "place", F.transform("grid", lambda x: x * (0.7 + 0.2 * (F.col("tile") % 4)) - 0.1 * (F.col("tile") % 3)).alias("grid"))
    found = tiles.blended(seen, tiles.chain(seen, "s", "grid"), "s", "grid").collect()
    got = {(r.s, r.frame): np.array(r.grid) for r in found}
    for s, own in streams.items():
        for k, x in enumerate(chained(own, spoil, t)):
            assert np.allclose(got[s, k], x, rtol=1e-6, atol=1e-8), (s, k)


def test_correlation_lookup(spark):
    rng = np.random.default_rng(2028)
    h, w, dim, levels, radius = 12, 17, 8, 3, 3
    maps = {k: rng.normal(size=(h, w, dim)).astype(np.float32) for k in range(4)}
    edges = [(0, 1), (1, 2), (2, 3), (3, 3)]
    coords = [(i, j, r, c, float(c + 0.4 * rng.normal() + 3 * (r == 5)), float(r + 0.4 * rng.normal() - 9 * (c == 2))) for i, j in edges for r in range(h) for c in range(w)]
    schema = "i long, j long, r long, c long, u double, v double"
    odd = [(0, 1, 50, 0, 1.0, 1.0), (0, 99, 0, 0, 1.0, 1.0), (0, 2, 0, 0, float("nan"), 1.0)]
    df = spark.createDataFrame([(k, h, w, dim, x.ravel().tolist()) for k, x in maps.items()], "frame long, h int, w int, dim int, data array<float>")
    got = {(r.i, r.j, r.r, r.c): np.array(r.corr) for r in correlation.looked_up(df, spark.createDataFrame(coords + odd, schema), levels, radius).collect()}
    halves = {}
    for k, x in maps.items():
        halves[k] = [x]
        for _ in range(levels - 1):
            y = halves[k][-1]
            y = y[: y.shape[0] // 2 * 2, : y.shape[1] // 2 * 2]
            halves[k].append((y[::2, ::2] + y[1::2, ::2] + y[::2, 1::2] + y[1::2, 1::2]) / 4)
    assert len(got) == len(coords)
    for i, j, r, c, u, v in coords[::7]:
        want = []
        for level in range(levels):
            volume = np.tensordot(halves[j][level] / 4, maps[i][r, c] / 4, 1)
            at = lambda x, y: volume[y, x] if 0 <= x < volume.shape[1] and 0 <= y < volume.shape[0] else 0.0  # noqa: B023, E731
            for dx in range(-radius, radius + 1):
                for dy in range(-radius, radius + 1):
                    x, y = u / 2**level + dx, v / 2**level + dy
                    x0, y0 = int(np.floor(x)), int(np.floor(y))
                    a, b = x - x0, y - y0
                    want.append((1 - a) * (1 - b) * at(x0, y0) + a * (1 - b) * at(x0 + 1, y0) + (1 - a) * b * at(x0, y0 + 1) + a * b * at(x0 + 1, y0 + 1))
        assert np.allclose(got[i, j, r, c], want, atol=2e-4, rtol=1e-4)


def test_long_lever_arms_of_small_turns(spark):
    """An arm far longer than the path, under turns of a hundredth: alternation stands still long before it is found."""
    rng = np.random.default_rng(3)
    rows, want = [], {}
    for track in range(6):
        want[track] = np.array([2.0 + 20 * track, -0.2, 0.05])
        for _ in range(50):
            p, q = 0.0125 * rng.normal(size=3), np.append(0.0125 * rng.normal(size=3), 1.0)
            q /= np.linalg.norm(q)
            x = rotation(q) @ want[track] + p
            rows.append((track, *map(float, p), *map(float, q), 2 * x[1] + 1, -2 * x[0], 2 * x[2] - 3))
    df = spark.createDataFrame([tuple(map(float, r[1:])) + (r[0],) for r in rows], "tx double, ty double, tz double, qx double, qy double, qz double, qw double, b0 double, b1 double, b2 double, track long")
    for r in trajectories.lever_arms(df, "track").collect():
        assert [r.arm_x, r.arm_y, r.arm_z] == pytest.approx(want[r.track].tolist(), abs=1e-5) and r.scale == pytest.approx(2, abs=1e-6) and r.error < 1e-4
        assert [r.tx, r.ty, r.tz] == pytest.approx([1, 0, -3], abs=1e-4)


def test_lookups_end_without_a_gathering(spark):
    """Levels of an edge's pixels are met in one task: two shuffles of pixels fewer, and maps of unlike shapes side by side."""
    shapes = {0: (6, 5), 1: (3, 9), 2: (1, 1)}
    rng = np.random.default_rng(5)
    maps = {k: rng.normal(size=(h, w, 2)).astype(np.float32) for k, (h, w) in shapes.items()}
    df = spark.createDataFrame([(k, *x.shape, x.ravel().tolist()) for k, x in maps.items()], "frame long, h int, w int, dim int, data array<float>")
    coords = [(i, j, r, c, c + 0.25, r + 0.5) for i, j in ((0, 1), (1, 2), (2, 0)) for r in range(shapes[i][0]) for c in range(shapes[i][1])]
    found = correlation.looked_up(df, spark.createDataFrame(coords, "i long, j long, r long, c long, u double, v double"), 2, 1)
    assert "collect_list(struct(level, level#" in (plan := found._jdf.queryExecution().optimizedPlan().toString()) and "collect_list(struct(level, level#" not in plan.split("MapInArrow")[0]
    got = {(x.i, x.j, x.r, x.c): x.corr for x in found.collect()}
    assert len(got) == len(coords) and {len(x) for (_, j, _, _), x in got.items() if j == 2} == {9} and len(got[0, 1, 0, 0]) == 18
    at = lambda k, r, c, one: float(maps[k][r, c] @ one) / 16 if 0 <= r < shapes[k][0] and 0 <= c < shapes[k][1] else 0.0
    for i, j, r, c, _, _ in coords:
        one = maps[i][r, c].astype(float)
        want = sum(wx * 0.5 * at(j, r + dr, c + dc, one) for dc, wx in ((0, 0.75), (1, 0.25)) for dr in (0, 1))
        assert got[i, j, r, c][4] == pytest.approx(want, abs=1e-6)


def test_shifted_products(spark):
    rng = np.random.default_rng(6)
    maps = {0: rng.normal(size=(3, 4)), 1: rng.normal(size=(3, 4)), 2: rng.normal(size=(2, 5))}
    df = spark.createDataFrame([(k, *x.shape, x.ravel().tolist()) for k, x in maps.items()], "frame long, h int, w int, data array<double>")
    found = correlation.shifted(df, spark.createDataFrame([(0, 1), (1, 2), (2, 0)], "i long, j long"), 1).collect()
    assert len(found) == 27
    for x in found:
        a, b = maps[x.i], maps[x.j]
        want = sum(a[r, c] * b[r + x.dr, c + x.dc] for r in range(a.shape[0]) for c in range(a.shape[1]) if 0 <= r + x.dr < b.shape[0] and 0 <= c + x.dc < b.shape[1])
        assert x.corr == pytest.approx(want)
