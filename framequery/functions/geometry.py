"""Rigid transforms and cameras as Column expressions.

A pose is seven columns, translation and unit quaternion with the scalar last, and maps
camera coordinates to world coordinates unless a function says otherwise.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

Vec = tuple[Column, Column, Column]

#: Below this angle the series of the exponential and logarithm are used.
SMALL = 1e-6
#: Points nearer than this are not in view.
NEAR = 0.1


class Pose(NamedTuple):
    tx: Column
    ty: Column
    tz: Column
    qx: Column
    qy: Column
    qz: Column
    qw: Column

    @property
    def t(self) -> Vec:
        return self.tx, self.ty, self.tz

    @property
    def q(self) -> tuple[Column, Column, Column, Column]:
        return self.qx, self.qy, self.qz, self.qw

    def named(self, prefix: str = "") -> dict[str, Column]:
        return {prefix + n: c for n, c in self._asdict().items()}


def pose(prefix: str = "") -> Pose:
    """The pose in the columns ``<prefix>tx`` to ``<prefix>qw``."""
    return Pose(*(F.col(prefix + n) for n in Pose._fields))


def r6(x: Column) -> Column:
    """Rounded to six digits, without a negative zero."""
    return F.round(x, 6) + F.lit(0.0)


def dot(a: Vec, b: Vec) -> Column:
    return a[0] * b[0] + a[1] * b[1] + a[2] * b[2]


def cross(a: Vec, b: Vec) -> Vec:
    return a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]


def add(a: Vec, b: Vec) -> Vec:
    return a[0] + b[0], a[1] + b[1], a[2] + b[2]


def scale(a: Vec, s: Column | float) -> Vec:
    return a[0] * s, a[1] * s, a[2] * s


def rotate(q: tuple[Column, ...], v: Vec) -> Vec:
    """v + 2 w (u x v) + 2 u x (u x v) for the quaternion (u, w)."""
    u, w = (q[0], q[1], q[2]), q[3]
    c = scale(cross(u, v), 2.0)
    return add(add(v, scale(c, w)), cross(u, c))


def quat_mul(a: tuple[Column, ...], b: tuple[Column, ...]) -> tuple[Column, Column, Column, Column]:
    ax, ay, az, aw = a
    bx, by, bz, bw = b
    return (aw * bx + ax * bw + ay * bz - az * by, aw * by - ax * bz + ay * bw + az * bx, aw * bz + ax * by - ay * bx + az * bw, aw * bw - ax * bx - ay * by - az * bz)


def act(p: Pose, x: Vec) -> Vec:
    """The point ``x`` moved by the pose."""
    return add(rotate(p.q, x), p.t)


def inverse(p: Pose) -> Pose:
    q = (-p.qx, -p.qy, -p.qz, p.qw)
    return Pose(*scale(rotate(q, p.t), -1.0), *q)


def compose(a: Pose, b: Pose) -> Pose:
    """First ``b``, then ``a``."""
    return Pose(*act(a, b.t), *quat_mul(a.q, b.q))


def matrix(p: Pose) -> list[Column]:
    """The upper three rows of the 4x4 matrix, row by row."""
    x, y, z, w = p.q
    return [
        1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w), p.tx,
        2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w), p.ty,
        2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y), p.tz,
    ]


def quaternion(m: list[Column]) -> tuple[Column, Column, Column, Column]:
    """The unit quaternion of a rotation given as nine columns row by row, from its largest component."""
    a, b, c, d, e, f, g, h, i = m
    four = {"x": 1 + a - e - i, "y": 1 - a + e - i, "z": 1 - a - e + i, "w": 1 + a + e + i}
    top = F.greatest(*four.values())
    s = 2 * F.sqrt(top)
    by_top = {"x": (s / 4, (b + d) / s, (c + g) / s, (h - f) / s), "y": ((b + d) / s, s / 4, (f + h) / s, (c - g) / s), "z": ((c + g) / s, (f + h) / s, s / 4, (d - b) / s), "w": ((h - f) / s, (c - g) / s, (d - b) / s, s / 4)}
    return tuple(F.when(four["w"] == top, by_top["w"][k]).when(four["x"] == top, by_top["x"][k]).when(four["y"] == top, by_top["y"][k]).otherwise(by_top["z"][k]) for k in range(4))


def so3_log(q: tuple[Column, ...]) -> Vec:
    """The rotation vector of a unit quaternion."""
    x, y, z, w = q
    n = F.sqrt(x * x + y * y + z * z)
    factor = F.when(n < SMALL, 2.0 / w).otherwise(2 * F.atan2(n, w) / n)
    return x * factor, y * factor, z * factor


def so3_exp(v: Vec) -> tuple[Column, Column, Column, Column]:
    angle = F.sqrt(dot(v, v))
    half = F.when(angle < SMALL, 0.5 - angle * angle / 48).otherwise(F.sin(angle / 2) / angle)
    return v[0] * half, v[1] * half, v[2] * half, F.cos(angle / 2)


def se3_exp(tau: Vec, phi: Vec) -> Pose:
    """The pose of a twist: translation part ``tau``, rotation vector ``phi``."""
    angle2 = dot(phi, phi)
    angle = F.sqrt(angle2)
    a = F.when(angle < SMALL, 0.5 - angle2 / 24).otherwise((1 - F.cos(angle)) / angle2)
    b = F.when(angle < SMALL, 1.0 / 6 - angle2 / 120).otherwise((angle - F.sin(angle)) / (angle2 * angle))
    c = cross(phi, tau)
    return Pose(*add(add(tau, scale(c, a)), scale(cross(phi, c), b)), *so3_exp(phi))


def se3_log(p: Pose) -> tuple[Vec, Vec]:
    """The twist of a pose; the inverse of se3_exp."""
    phi = so3_log(p.q)
    angle2 = dot(phi, phi)
    angle = F.sqrt(angle2)
    k = F.when(angle < SMALL, 1.0 / 12).otherwise((1 - angle * F.cos(angle / 2) / (2 * F.sin(angle / 2))) / angle2)
    c = cross(phi, p.t)
    return add(add(p.t, scale(c, -0.5)), scale(cross(phi, c), k)), phi


class Camera(NamedTuple):
    """Focal lengths and principal point, as numbers or columns."""

    fx: Column | float
    fy: Column | float
    cx: Column | float
    cy: Column | float

    def ray(self, u: Column, v: Column) -> Vec:
        """The point at depth one that pixel (u, v) sees."""
        return (u - self.cx) / self.fx, (v - self.cy) / self.fy, F.lit(1.0)

    def project(self, x: Vec) -> tuple[Column, Column, Column]:
        """(u, v, in view); a point nearer than NEAR is projected as if at depth one."""
        z = F.when(x[2] < NEAR, F.lit(1.0)).otherwise(x[2])
        return self.fx * x[0] / z + self.cx, self.fy * x[1] / z + self.cy, x[2] > NEAR


def unified_ray(cam: Camera, k1: Column, u: Column, v: Column) -> Vec:
    """The unified sphere model's point at depth one; ``k1`` is the mirror offset."""
    x, y, _ = cam.ray(u, v)
    r2 = x * x + y * y
    factor = (k1 + F.sqrt(1 + (1 - k1 * k1) * r2)) / (1 + r2)
    return x * factor / (factor - k1), y * factor / (factor - k1), F.lit(1.0)


def unified_project(cam: Camera, k1: Column, x: Vec) -> tuple[Column, Column, Column]:
    """(u, v, in view) in the unified sphere model."""
    z = F.when(x[2] < NEAR, F.lit(1.0)).otherwise(x[2])
    norm = F.sqrt(x[0] * x[0] + x[1] * x[1] + z * z)
    return cam.fx * x[0] / (z + k1 * norm) + cam.cx, cam.fy * x[1] / (z + k1 * norm) + cam.cy, x[2] > NEAR


def panorama_project(x: Vec) -> tuple[Column, Column]:
    """Longitude and latitude of a direction, both scaled to [0, 1]."""
    norm = F.sqrt(dot(x, x))
    return F.atan2(x[0], x[2]) / (2 * F.pi()) + 0.5, F.acos(-x[1] / norm) / F.pi()


def focal_from_fov(size: Column, fov: Column) -> Column:
    return size / (2 * F.tan(fov / 2))


def huber(x: Column, delta: float) -> Column:
    """Weight of a residual norm."""
    return F.when(x <= delta, 1.0).otherwise(delta / x)


def tukey(x: Column, c: float) -> Column:
    return F.when(x <= c, (1 - (x / c) * (x / c)) * (1 - (x / c) * (x / c))).otherwise(0.0)


def truncated_gnc(r2: Column, c2: float, mu: float) -> Column:
    """Graduated truncated least squares: one, then falling, then nought."""
    low, high = mu / (mu + 1) * c2, (mu + 1) / mu * c2
    return F.when(r2 <= low, 1.0).when(r2 >= high, 0.0).otherwise(F.sqrt(F.lit(c2 * mu * (mu + 1)) / r2) - mu)


def adjoint(p: Pose, tau: Vec, phi: Vec) -> tuple[Vec, Vec]:
    """The twist that, after the pose, moves as (tau, phi) does before it."""
    turned = rotate(p.q, phi)
    return add(rotate(p.q, tau), cross(p.t, turned)), turned


def adjoint_transposed(p: Pose, tau: Vec, phi: Vec) -> tuple[Vec, Vec]:
    """A co-twist after the pose, taken to before it."""
    back = (-p.qx, -p.qy, -p.qz, p.qw)
    return rotate(back, tau), rotate(back, add(phi, cross(tau, p.t)))


class Similarity(NamedTuple):
    """A rotation and translation with a positive scale: x goes to scale * rotated x + t."""

    pose: Pose
    scale: Column


def sim3_act(s: Similarity, x: Vec) -> Vec:
    return add(scale(rotate(s.pose.q, x), s.scale), s.pose.t)


def sim3_compose(a: Similarity, b: Similarity) -> Similarity:
    """First ``b``, then ``a``."""
    return Similarity(Pose(*sim3_act(a, b.pose.t), *quat_mul(a.pose.q, b.pose.q)), a.scale * b.scale)


def sim3_inverse(s: Similarity) -> Similarity:
    back = (-s.pose.qx, -s.pose.qy, -s.pose.qz, s.pose.qw)
    return Similarity(Pose(*scale(rotate(back, s.pose.t), -1 / s.scale), *back), 1 / s.scale)


def yaw_pitch(yaw: Column, pitch: Column) -> tuple[Column, Column, Column, Column]:
    """The rotation that first pitches about x, then yaws about y, with a scalar part that isn't negative."""
    sy, cy, sp, cp = F.sin(yaw / 2), F.cos(yaw / 2), F.sin(pitch / 2), F.cos(pitch / 2)
    q = (cy * sp, sy * cp, -sy * sp, cy * cp)
    sign = F.when(q[3] < 0, -1.0).otherwise(1.0)
    return tuple(sign * v for v in q)


def so3_jinv(phi: Vec, x: Vec) -> Vec:
    """The inverse left Jacobian of the rotation vector ``phi`` applied to ``x``: how a rotation's logarithm turns a small rotation before it."""
    angle2 = dot(phi, phi)
    angle = F.sqrt(angle2)
    k = F.when(angle < SMALL, 1.0 / 12).otherwise(1 / angle2 - (1 + F.cos(angle)) / (2 * angle * F.sin(angle)))
    c = cross(phi, x)
    return add(add(x, scale(c, -0.5)), scale(cross(phi, c), k))


def rxso3_exp(phi: Vec, sigma: Column) -> tuple[tuple[Column, Column, Column, Column], Column]:
    """(rotation, scale) of a rotation vector and the logarithm of a scale."""
    return so3_exp(phi), F.exp(sigma)


def rxso3_log(q: tuple[Column, ...], s: Column) -> tuple[Vec, Column]:
    """The rotation vector and the logarithm of the scale; the inverse of rxso3_exp."""
    return so3_log(q), F.log(s)


def _similar_weights(phi: Vec, sigma: Column) -> tuple[Column, Column, Column]:
    """a, b, c of a phi^ + b phi^2 + c, the integral of exp(t (phi^ + sigma)) over t from 0 to 1; series where an angle or sigma is small."""
    angle2, s = dot(phi, phi), F.exp(sigma)
    angle = F.sqrt(angle2)
    still, flat = angle < 1e-4, F.abs(sigma) < 1e-4
    c = F.when(flat, 1 + sigma / 2 + sigma * sigma / 6).otherwise((s - 1) / sigma)
    a_still = F.when(flat, 0.5 + sigma / 3).otherwise((1 + (sigma - 1) * s) / (sigma * sigma))
    b_still = F.when(flat, 1.0 / 6 + sigma / 8).otherwise((s * (sigma * sigma / 2 - sigma + 1) - 1) / (sigma * sigma * sigma))
    sin, cos, both = s * F.sin(angle), s * F.cos(angle), angle2 + sigma * sigma
    a_turned = (sin * sigma + (1 - cos) * angle) / (angle * both)
    b_turned = (c - ((cos - 1) * sigma + sin * angle) / both) / angle2
    return F.when(still, a_still).otherwise(a_turned), F.when(still, b_still).otherwise(b_turned), c


def sim3_exp(tau: Vec, phi: Vec, sigma: Column) -> Similarity:
    """The similarity of a translation part, a rotation vector and the logarithm of a scale."""
    a, b, c = _similar_weights(phi, sigma)
    turned = cross(phi, tau)
    t = add(add(scale(tau, c), scale(turned, a)), scale(cross(phi, turned), b))
    return Similarity(Pose(*t, *so3_exp(phi)), F.exp(sigma))


def sim3_log(s: Similarity) -> tuple[Vec, Vec, Column]:
    """(tau, phi, sigma); the inverse of sim3_exp."""
    phi, sigma = rxso3_log(s.pose.q, s.scale)
    a, b, c = _similar_weights(phi, sigma)
    angle2 = dot(phi, phi)
    # along the axis c alone acts; across it the plane's complex number p + i q
    p, q2 = c - b * angle2, a * a * angle2
    turned = cross(phi, s.pose.t)
    back = -a / (p * p + q2)
    # t - (part along phi) = -phi x (phi x t) / angle^2
    whole = F.when(angle2 < 1e-16, 0.0).otherwise((1 / c - p / (p * p + q2)) / F.when(angle2 < 1e-16, 1.0).otherwise(angle2))
    return add(add(scale(s.pose.t, 1 / c), scale(turned, back)), scale(cross(phi, turned), whole)), phi, sigma
