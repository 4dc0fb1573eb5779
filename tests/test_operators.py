"""Operators on small made-up rows, against plain versions."""

import numpy as np
import pytest
from framequery.functions import geometry as g
from framequery.operators import alignment, bundle, lookups, scatter, sequences
from framequery.plans import maps
from framequery.sources import frames
from framequery.streaming import replay
from pyspark.sql import functions as F


def _quat_matrix(q):
    x, y, z, w = q
    return np.array([[1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w)], [2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w)], [2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y)]])


def _random_poses(n, seed=0):
    rng = np.random.default_rng(seed)
    q = rng.normal(size=(n, 4))
    q /= np.linalg.norm(q, axis=1, keepdims=True)
    return np.column_stack([rng.normal(size=(n, 3)), q])


def _frame(spark, rows, names=g.Pose._fields):
    return spark.createDataFrame([tuple(map(float, r)) for r in rows], ", ".join(f"{n} double" for n in names))


def test_rotations_through_matrices(spark):
    p = _random_poses(200)
    df = _frame(spark, p)
    m = df.select(*[c.alias(f"m{k}") for k, c in enumerate(g.matrix(g.pose()))])
    got = np.array(m.collect())
    want = np.array([np.column_stack([_quat_matrix(r[3:]), r[:3]]).ravel() for r in p])
    assert np.allclose(got, want)
    q = np.array(m.select(*g.quaternion([F.col(f"m{k}") for k in (0, 1, 2, 4, 5, 6, 8, 9, 10)])).collect())
    assert np.allclose(np.abs((q * p[:, 3:]).sum(axis=1)), 1)


def test_exponential_undoes_logarithm(spark):
    p = _random_poses(100, 1)
    p[:, 3:] *= np.sign(p[:, 6:7])
    p[0] = [1, 2, 3, 0, 0, 0, 1]
    tau, phi = g.se3_log(g.pose())
    twist = _frame(spark, p).select(*[c.alias(f"x{k}") for k, c in enumerate((*tau, *phi))])
    x = [F.col(f"x{k}") for k in range(6)]
    got = np.array(twist.select(*g.se3_exp(tuple(x[:3]), tuple(x[3:]))).collect())
    assert np.allclose(got, p, atol=1e-9)


def test_inverse_and_composition(spark):
    p = _random_poses(50, 2)
    df = _frame(spark, p)
    both = g.compose(g.pose(), g.inverse(g.pose()))
    got = np.array(df.select(*both).collect())
    assert np.allclose(got, [[0, 0, 0, 0, 0, 0, 1]] * 50, atol=1e-12)


def test_as_of_keeps_ties_and_misses(spark):
    left = spark.createDataFrame([("a", 1), ("a", 5), ("a", 9), ("b", 4)], "k string, t int")
    right = spark.createDataFrame([("a", 5, "x"), ("a", 7, "y"), ("c", 1, "z")], "k string, t int, v string")
    got = sorted(map(tuple, lookups.as_of(left, right, "k", ["t"], "v", "m").collect()))
    assert got == [("a", 1, None), ("a", 5, "x"), ("a", 9, "y"), ("b", 4, None)]


def test_nearest_within_reach(spark):
    rng = np.random.default_rng(4)
    p, q = rng.random((300, 3)), rng.random((40, 3))
    pts = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(p)], "p_id long, p_x double, p_y double, p_z double")
    ask = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(q)], "q_id long, q_x double, q_y double, q_z double")
    got = {(r.q_id, r["rank"]): r.p_id for r in lookups.k_nearest(ask, pts, 3, 0.15).collect()}
    want = {}
    for i, r in enumerate(q):
        d = ((p - r) ** 2).sum(axis=1)
        for n, k in enumerate(np.argsort(d)[:3]):
            if d[k] <= 0.15**2:
                want[i, n + 1] = int(k)
    assert got == want


@pytest.mark.parametrize("block", [4, 1000])
def test_smoothing_is_the_fold(spark, block):
    x = np.random.default_rng(6).normal(size=37)
    df = spark.createDataFrame([("s", i, float(v)) for i, v in enumerate(x)] + [("t", 0, 2.5)], "k string, n int, x double")
    got = {(r.k, r.n): r.e for r in sequences.smoothed(df, "k", "n", F.col("x"), 0.9, "e", block).collect()}
    now = x[0]
    for i, v in enumerate(x):
        now = v if i == 0 else 0.9 * now + 0.1 * v
        assert got["s", i] == pytest.approx(now)
    assert got["t", 0] == 2.5


def test_keyframes_and_their_streaming_twin(spark, tmp_path):
    rng = np.random.default_rng(8)
    rows = [(int(u), n, float(rng.random() * 100)) for u in range(3) for n in range(40)]
    df = spark.createDataFrame(rows, "user_id long, event_id long, value double").withColumn("ts", F.timestamp_seconds("event_id"))
    got = sorted(map(tuple, sequences.select_keyframes(df, "user_id", "event_id", "value", 30.0).collect()))
    want = []
    for u in range(3):
        ref = None
        for _, n, x in [r for r in rows if r[0] == u]:
            if ref is None or abs(x - ref) > 30 or n == 39:
                want.append((u, n))
                ref = x
    assert got == want
    for k in range(4):
        df.where(f"event_id div 10 = {k}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = replay.keyframes(replay.source(spark, str(tmp_path / "in"), df), 30.0)
    q = stream.writeStream.format("memory").queryName("walked").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    live = sorted(map(tuple, spark.table("walked").collect()))
    assert set(want) - set(live) <= {(u, 39) for u in range(3)} and set(live) <= set(want)
    totals = replay.daily_totals(replay.source(spark, str(tmp_path / "in"), df))
    q = totals.writeStream.format("memory").queryName("totals").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert sum(r.n for r in spark.table("totals").collect()) == 120


def test_block_products(spark):
    rng = np.random.default_rng(9)
    a, b = rng.normal(size=(6, 4)), rng.normal(size=(4, 8))
    blocks = lambda m: spark.createDataFrame([(r // 2, c // 2, r % 2, c % 2, float(m[r, c])) for r in range(m.shape[0]) for c in range(m.shape[1])], "i long, j long, row long, col long, x double")
    got = np.zeros((6, 8))
    for r in scatter.block_matmul(blocks(a), blocks(b)).collect():
        got[2 * r.i + r.row, 2 * r.j + r.col] = r.x
    assert np.allclose(got, a @ b)
    back = scatter.block_add(scatter.transpose(scatter.transpose(blocks(a))), blocks(a), minus=True)
    assert all(abs(r.x) < 1e-12 for r in back.collect())


def test_numbering_crosses_ranges(spark):
    ids = spark.createDataFrame([(x,) for x in (5, 5000, 7, -3, 5000, 1024)], "v long")
    assert {r.v: r.n for r in scatter.dense_number(ids, "v", "n", 100).collect()} == {-3: 0, 5: 1, 7: 2, 1024: 3, 5000: 4}


CAM = g.Camera(8.0, 8.0, 4.0, 4.0)


def _problem(spark):
    rng = np.random.default_rng(11)
    px = [(i, r, c, float(rng.uniform(0.8, 1.2))) for i in range(3) for r in range(3) for c in range(3)]
    rel = {e: np.r_[rng.uniform(-0.05, 0.05, 3), rng.uniform(-0.02, 0.02, 3), 1] for e in ((0, 1), (1, 0), (0, 2), (2, 1))}
    for p in rel.values():
        p[3:] /= np.linalg.norm(p[3:])
    targets = [(i, j, r, c, c + float(rng.normal() * 0.2), r + float(rng.normal() * 0.2), float(rng.uniform(0.5, 1))) for i, j in rel for r in range(3) for c in range(3)]
    pixels = spark.createDataFrame(px, "i long, r long, c long, disp double")
    edges = spark.createDataFrame([(*e, *map(float, p)) for e, p in rel.items()], "i long, j long, " + ", ".join(f"r_{n} double" for n in g.Pose._fields))
    aims = spark.createDataFrame(targets, "i long, j long, r long, c long, tu double, tv double, weight double")
    return px, rel, targets, pixels, edges, aims


def _plain(pose, disp, r, c, twist=np.zeros(6), before=np.zeros(6)):
    x = np.array([(c - 4) / 8, (r - 4) / 8, 1])
    x = x + disp * before[:3] + np.cross(before[3:], x)
    x = _quat_matrix(pose[3:]) @ x + disp * pose[:3]
    x = x + disp * twist[:3] + np.cross(twist[3:], x)
    return np.array([8 * x[0] / x[2] + 4, 8 * x[1] / x[2] + 4])


def test_jacobians_against_differences(spark):
    px, rel, targets, pixels, edges, aims = _problem(spark)
    disp = {(i, r, c): d for i, r, c, d in px}
    aim = {t[:4]: t[4:] for t in targets}
    for row in bundle.residuals(pixels, edges, aims, CAM).collect():
        pose, d = rel[row.i, row.j], disp[row.i, row.r, row.c]
        at = _plain(pose, d, row.r, row.c)
        assert np.allclose([row.ru, row.rv], np.array(aim[row.i, row.j, row.r, row.c][:2]) - at)
        h = 1e-6
        assert np.allclose([row.du, row.dv], (_plain(pose, d + h, row.r, row.c) - at) / h, atol=1e-4)
        for k in range(6):
            step = np.eye(6)[k] * h
            assert np.allclose([row[f"au{k}"], row[f"av{k}"]], (_plain(pose, d, row.r, row.c, step) - at) / h, atol=1e-4)
            # a twist of i moves the point, before the relative pose, the other way
            assert np.allclose([row[f"bu{k}"], row[f"bv{k}"]], (_plain(pose, d, row.r, row.c, before=-step) - at) / h, atol=1e-4)


def test_solution_of_the_dense_system(spark):
    """Pose and disparity steps against one dense least-squares system, with damping, a fixed pose and sensed disparities."""
    _, rel, _, pixels, edges, aims = _problem(spark)
    res = bundle.residuals(pixels, edges, aims, CAM)
    rows = res.collect()
    keys = sorted({k for e in rel for k in e})
    spots = sorted({(r.i, r.r, r.c) for r in rows})
    disp = {(r.i, r.r, r.c): r.disp for r in pixels.collect()}
    sensed = {s: disp[s] + 0.1 for n, s in enumerate(spots) if n % 2}
    jac, rhs, w = np.zeros((2 * len(rows), 6 * len(keys) + len(spots))), np.zeros(2 * len(rows)), np.zeros(2 * len(rows))
    for n, r in enumerate(rows):
        for a, axis in enumerate("uv"):
            for side, x in ((r.i, "b"), (r.j, "a")):
                at = 6 * keys.index(side)
                jac[2 * n + a, at : at + 6] += [r[f"{x}{axis}{k}"] for k in range(6)]
            jac[2 * n + a, 6 * len(keys) + spots.index((r.i, r.r, r.c))] = r[f"d{axis}"]
            rhs[2 * n + a], w[2 * n + a] = r[f"r{axis}"], r.weight
    h, b = jac.T @ (w[:, None] * jac), jac.T @ (w * rhs)
    n_pose = 6 * len(keys)
    for n, s in enumerate(spots):
        if s in sensed:
            h[n_pose + n, n_pose + n] += 0.3
            b[n_pose + n] += 0.3 * (sensed[s] - disp[s])
    d = np.diag(h).copy()
    d[:n_pose], d[n_pose:] = d[:n_pose] * 1e-2 + 0.5, d[n_pose:] * 0.1 + 1e-3
    h += np.diag(d)
    x = np.zeros(len(b))
    x[6:] = np.linalg.solve(h[6:, 6:], b[6:])

    sens = spark.createDataFrame([(*s, v) for s, v in sensed.items()], "i long, r long, c long, sens double")
    depths = bundle.depth_system(res, pixels, 0.1, 1e-3, sens, 0.3)
    blocks, g_ = bundle.normal_equations(res)
    steps = bundle.pose_steps(*bundle.eliminated(blocks, g_, depths, 1e-2, 0.5), lambda p: F.lit(0), lambda p: p == keys[0])
    got = {r.p: [r[f"x{k}"] for k in range(6)] for r in steps.collect()}
    assert sorted(got) == keys[1:]
    assert np.allclose([got[k] for k in keys[1:]], x[6:n_pose].reshape(-1, 6), rtol=1e-8, atol=1e-10)
    found = {(r.i, r.r, r.c): r.step for r in bundle.depth_steps(depths, steps).collect()}
    assert np.allclose([found[s] for s in spots], x[n_pose:], rtol=1e-8, atol=1e-10)


def test_similarity_is_found(spark):
    rng = np.random.default_rng(12)
    a = rng.normal(size=(40, 3))
    q = rng.normal(size=4)
    rot = _quat_matrix(q / np.linalg.norm(q))
    b = 1.7 * a @ rot.T + [1, -2, 0.5]
    df = spark.createDataFrame([(0, *map(float, x), *map(float, y)) for x, y in zip(a, b, strict=True)] + [(1, *[1.0] * 6)] * 3, "k long, " + ", ".join(f"{s}_{x} double" for s in "ab" for x in "xyz"))
    got = {r.k: r for r in alignment.similarity(df, "k").collect()}
    assert got[0].scale == pytest.approx(1.7)
    assert np.allclose([[got[0][f"r{p}{q}"] for q in range(3)] for p in range(3)], rot)
    assert np.allclose([got[0].tx, got[0].ty, got[0].tz], [1, -2, 0.5])
    assert got[1].scale == 1.0


def test_greedy_edges_keep_apart(spark):
    rng = np.random.default_rng(13)
    rows = [(int(k), int(i), int(j), float(rng.random())) for k in range(2) for i in range(15) for j in range(i + 1, min(15, i + 8))]
    df = spark.createDataFrame(rows, "k long, i long, j long, d double")
    got = sorted((r.k, r.i, r.j) for r in alignment.greedy_edges(df, "k", 2, 6).collect())
    want = []
    for k in range(2):
        taken = []
        for d, i, j in sorted((d, i, j) for g_, i, j, d in rows if g_ == k):
            if len(taken) < 6 and all(abs(i - p) + abs(j - q) > max(min(abs(i - j) - 2, 2), 0) for p, q in taken):
                taken.append((i, j))
        want += [(k, *t) for t in taken]
    assert got == sorted(want)


def test_bundle_rounds_lower_the_energy(spark, sf):
    p = frames.poses(spark, sf).where("frame_idx % 5 = 0 AND frame_idx < 40")
    cams = p.select((F.col("frame_idx") / 5).cast("long").alias("k"), *[c.alias(m) for m, c in g.inverse(g.pose()).named().items()])
    px = frames.grid(spark, sf).where("frame_idx % 5 = 0 AND frame_idx < 40").select((F.col("frame_idx") / 5).cast("long").alias("i"), "r", "c", "disp")
    e = frames.edges(spark, sf).where("i < 8 AND j < 8")
    targets = px.select("i", "r", "c").join(e, "i").select("i", "j", "r", "c", (F.col("c") + 0.03 * (F.col("j") - F.col("i"))).alias("tu"), (F.col("r") - 0.02 * (F.col("j") - F.col("i"))).alias("tv"), F.lit(0.07).alias("weight"))

    def energy():
        return bundle.residuals(px, bundle.relative(cams, e), targets, maps.CAM).agg(F.sum(F.col("weight") * (F.col("ru") * F.col("ru") + F.col("rv") * F.col("rv")))).first()[0]

    before = energy()
    cams, px = (d.cache() for d in bundle.adjusted(cams, px, e, targets, maps.CAM, lambda k: F.lit(0), lambda k: k == 0, (1e-2, 1.0), (0.0, 1.0)))
    after = energy()
    assert after < 0.9 * before


def test_bundle_step_without_a_row_a_residual(spark, sf, monkeypatch):
    """The step of whole bands is the one of residuals summed a row an edge and pixel, which it doesn't make."""
    p = frames.poses(spark, sf).where("frame_idx % 5 = 0 AND frame_idx < 25")
    cams = p.select((F.col("frame_idx") / 5).cast("long").alias("k"), *[c.alias(m) for m, c in g.inverse(g.pose()).named().items()])
    px = frames.grid(spark, sf).where("frame_idx % 5 = 0 AND frame_idx < 25").select((F.col("frame_idx") / 5).cast("long").alias("i"), "r", "c", "disp")
    e = frames.edges(spark, sf).where("i < 5 AND j < 5")
    targets = px.select("i", "r", "c").join(e, "i").select("i", "j", "r", "c", (F.col("c") + 0.3).alias("tu"), (F.col("r") - 0.2).alias("tv"), (0.1 + 0.01 * F.col("r")).alias("weight"))
    sensed = px.where("c % 2 = 0").select("i", "r", "c", (F.col("disp") + 0.1).alias("sens"))
    res = bundle.residuals(px, bundle.relative(cams, e), targets, maps.CAM).cache()
    depths = bundle.depth_system(res, px, 0.1, 1e-3, sensed, 0.3)
    steps = bundle.pose_steps(*bundle.eliminated(*bundle.normal_equations(res), depths, 1e-2, 0.5), lambda k: F.lit(0), lambda k: k == 0)
    want = {(r.i, r.r, r.c): r.step for r in bundle.depth_steps(depths, steps).collect()}
    monkeypatch.setattr(bundle, "residuals", lambda *_: 1 / 0)
    moved, new = bundle.adjusted(cams, px, e, targets, maps.CAM, lambda k: F.lit(0), lambda k: k == 0, (1e-2, 0.5), (0.1, 1e-3), sensed, 0.3, 0.5)
    old = {(r.i, r.r, r.c): r.disp for r in px.collect()}
    got = {(r.i, r.r, r.c): r.disp for r in new.collect()}
    assert len(got) == len(old) and all(got[s] == pytest.approx(max(1e-3, old[s] + 0.5 * want[s]), abs=1e-9) for s in old)
    x = [0.5 * F.col(f"x{k}") for k in range(6)]
    there = cams.join(steps.withColumnRenamed("p", "k"), "k").select("k", *[c.alias(m) for m, c in g.compose(g.se3_exp(tuple(x[:3]), tuple(x[3:])), g.pose()).named().items()])
    there = {r.k: list(r)[1:] for r in there.unionByName(cams.where("k = 0")).collect()}
    moved = {r.k: list(r)[1:] for r in moved.select("k", *g.Pose._fields).collect()}
    assert sorted(moved) == sorted(there) and all(np.allclose(moved[k], there[k], atol=1e-9) for k in there)


def test_similarities_undo_and_compose(spark):
    rng = np.random.default_rng(21)
    n = lambda v: v / np.linalg.norm(v)
    a, b = (np.r_[rng.normal(size=3), n(rng.normal(size=4))] for _ in range(2))
    x = rng.normal(size=3)
    df = spark.createDataFrame([(*map(float, a), *map(float, b), *map(float, x))], ", ".join(f"{p}{c} double" for p in "ab" for c in g.Pose._fields) + ", x double, y double, z double")
    sa, sb = g.Similarity(g.pose("a"), F.lit(1.7)), g.Similarity(g.pose("b"), F.lit(0.4))
    p = tuple(F.col(c) for c in "xyz")
    out = [g.sim3_act(g.sim3_compose(sa, sb), p), g.sim3_act(sa, g.sim3_act(sb, p)), g.sim3_act(g.sim3_inverse(sa), g.sim3_act(sa, p))]
    r = df.select(*[v.alias(f"o{k}{j}") for k, o in enumerate(out) for j, v in enumerate(o)]).first()
    got = np.array(r).reshape(3, 3)
    want = 1.7 * _quat_matrix(a[3:]) @ (0.4 * _quat_matrix(b[3:]) @ x + b[:3]) + a[:3]
    assert np.allclose(got, [want, want, x])


def test_adjoints(spark):
    """The adjoint turns a twist before a pose into one after it; its transpose keeps products."""
    rng = np.random.default_rng(22)
    q = rng.normal(size=4)
    p = np.r_[rng.normal(size=3), q / np.linalg.norm(q)]
    v, w = rng.normal(size=6), rng.normal(size=6)
    df = spark.createDataFrame([tuple(map(float, (*p, *v, *w)))], ", ".join(f"{c} double" for c in (*g.Pose._fields, *(f"v{k}" for k in range(6)), *(f"w{k}" for k in range(6)))))
    col = lambda n: (tuple(F.col(f"{n}{k}") for k in range(3)), tuple(F.col(f"{n}{k}") for k in range(3, 6)))
    out = [x for pair in (g.adjoint(g.pose(), *col("v")), g.adjoint_transposed(g.pose(), *col("w"))) for part in pair for x in part]
    r = np.array(df.select(*[c.alias(f"c{k}") for k, c in enumerate(out)]).first())
    rot, t = _quat_matrix(p[3:]), p[:3]
    skew = np.array([[0, -t[2], t[1]], [t[2], 0, -t[0]], [-t[1], t[0], 0]])
    adj = np.block([[rot, skew @ rot], [np.zeros((3, 3)), rot]])
    assert np.allclose(r[:6], adj @ v) and np.allclose(r[6:], adj.T @ w)


def test_mean_pose_is_the_eigenvector(spark):
    rng = np.random.default_rng(23)
    rows = [(k // 10, *map(float, rng.normal(size=3)), *map(float, (lambda q: q / np.linalg.norm(q))(np.r_[0.3 * rng.normal(size=3), 1.0]) * rng.choice([-1, 1]))) for k in range(30)]
    df = spark.createDataFrame(rows, "k long, " + ", ".join(f"{c} double" for c in g.Pose._fields))
    for r in alignment.mean_poses(df, "k").collect():
        own = np.array([x[1:] for x in rows if x[0] == r.k])
        v = np.linalg.eigh(own[:, 3:].T @ own[:, 3:])[1][:, -1]
        assert np.allclose([r.tx, r.ty, r.tz], own[:, :3].mean(axis=0)) and np.allclose([r.qx, r.qy, r.qz, r.qw], v * np.sign(v[3]))


def test_rigid_alignment(spark):
    rng = np.random.default_rng(24)
    a = rng.normal(size=(30, 3))
    q = rng.normal(size=4)
    rot = _quat_matrix(q / np.linalg.norm(q))
    b = 1.3 * a @ rot.T + [1, 2, 3]
    df = spark.createDataFrame([(0, *map(float, x), *map(float, y)) for x, y in zip(a, b, strict=True)], "k long, " + ", ".join(f"{s}_{x} double" for s in "ab" for x in "xyz"))
    r = alignment.similarity(df, "k", rigid=True).first()
    assert r.scale == 1.0 and np.allclose([[r[f"r{p}{c}"] for c in range(3)] for p in range(3)], rot)
    assert np.allclose([r.tx, r.ty, r.tz], b.mean(axis=0) - rot @ a.mean(axis=0))
