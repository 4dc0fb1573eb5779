"""retract_pose, pose_predict and pose_interp against 4x4 matrix exponentials and logarithms by their series."""

import numpy as np
from framequery.functions import geometry as g
from framequery.plans import registry
from framequery.sources import frames

NAMES = list(g.Pose._fields)


def matrix(p):
    x, y, z, w = p[3:]
    r = np.array([[1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w)], [2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w)], [2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y)]])
    m = np.eye(4)
    m[:3, :3], m[:3, 3] = r, p[:3]
    return m


def twist(x):
    m = np.zeros((4, 4))
    m[:3, :3], m[:3, 3] = [[0, -x[5], x[4]], [x[5], 0, -x[3]], [-x[4], x[3], 0]], x[:3]
    return m


def exp(m):
    out, term = np.eye(4), np.eye(4)
    for k in range(1, 40):
        term = term @ m / k
        out = out + term
    return out


def log(m):
    """By its series; motions between the table's poses are small."""
    x, term, out = m - np.eye(4), np.eye(4), np.zeros((4, 4))
    for k in range(1, 400):
        term = term @ x
        out = out + (-1) ** (k + 1) * term / k
    return out


def all_poses(spark, sf):
    return {r.frame_idx: np.array([r[c] for c in NAMES]) for r in frames.poses(spark, sf).collect()}


def held(spark, sf, name, want):
    got = {r.frame_idx: matrix(np.array([r[c] for c in NAMES])) for r in registry.QUERIES[name](spark, sf).collect()}
    assert sorted(got) == sorted(want)
    assert all(np.allclose(got[k], want[k], atol=1e-5) for k in want)


def test_retract_pose(spark, sf):
    step = lambda p: 0.1 * p[[1, 2, 0, 5, 3, 4]]
    held(spark, sf, "retract_pose", {k: exp(twist(step(p))) @ matrix(p) for k, p in all_poses(spark, sf).items()})


def test_pose_predict(spark, sf):
    p = all_poses(spark, sf)
    want = {}
    for k in sorted(p):
        before = [j for j in p if j < k and j // 100 == k // 100]
        if before:
            here = matrix(p[k])
            want[k] = exp(0.5 * log(here @ np.linalg.inv(matrix(p[max(before)])))) @ here
    held(spark, sf, "pose_predict", want)


def test_pose_interp(spark, sf):
    p = all_poses(spark, sf)
    want = {}
    for k in p:
        a, b = k // 5 * 5, k // 5 * 5 + 5
        if a in p and b in p:
            start = matrix(p[a])
            want[k] = exp((k % 5) / (5 + 1e-3) * log(matrix(p[b]) @ np.linalg.inv(start))) @ start
    held(spark, sf, "pose_interp", want)
