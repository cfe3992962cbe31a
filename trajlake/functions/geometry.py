"""Geometry as column expressions, all inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

AXES = ("x", "y", "z")


def interval_gap(lo_a: Column, hi_a: Column, lo_b: Column, hi_b: Column) -> Column:
    """The distance of two intervals; 0 where they meet."""
    return F.greatest(lo_a - hi_b, lo_b - hi_a, F.lit(0.0))


def overlap(lo_a: Column, hi_a: Column, lo_b: Column, hi_b: Column) -> Column:
    return F.greatest(F.least(hi_a, hi_b) - F.greatest(lo_a, lo_b), F.lit(0.0))


def box_distance(a: str, b: str) -> Column:
    """Euclidean distance of two boxes whose columns are prefixed a_ and b_: a lower bound of the distance of any points in them."""
    gaps = [interval_gap(F.col(f"{a}min_{x}"), F.col(f"{a}max_{x}"), F.col(f"{b}min_{x}"), F.col(f"{b}max_{x}")) for x in AXES]
    return F.sqrt(sum((g * g for g in gaps[1:]), gaps[0] * gaps[0]))


def iou_2d(a: str, b: str) -> Column:
    """Struct of the ground-plane overlap of two boxes: iou, ratio_a, ratio_b (of each area), area_ratio_ab, area_ratio_ba; all 0 where an area is 0."""
    c = lambda p, m, x: F.col(f"{p}{m}_{x}")
    area = lambda p: (c(p, "max", "x") - c(p, "min", "x")) * (c(p, "max", "y") - c(p, "min", "y"))
    inter = overlap(c(a, "min", "x"), c(a, "max", "x"), c(b, "min", "x"), c(b, "max", "x")) * overlap(c(a, "min", "y"), c(a, "max", "y"), c(b, "min", "y"), c(b, "max", "y"))
    safe = (area(a) > 0) & (area(b) > 0)
    part = lambda n, d: F.when(safe, n / F.nullif(d, F.lit(0.0))).otherwise(0.0)
    return F.struct(
        part(inter, area(a) + area(b) - inter).alias("iou"),
        part(inter, area(a)).alias("ratio_a"),
        part(inter, area(b)).alias("ratio_b"),
        part(area(a), area(b)).alias("area_ratio_ab"),
        part(area(b), area(a)).alias("area_ratio_ba"),
    )


def in_polygon(x: Column, y: Column, polygon: Column) -> Column:
    """The half-open crossing rule: whether a ray to the right crosses an odd number of edges."""
    n = F.size(polygon)

    def crosses(p: Column, i: Column) -> Column:
        q = F.get(polygon, (i + 1) % n)
        over = (p["y"] > y) != (q["y"] > y)
        return F.when(over & (x < p["x"] + (y - p["y"]) * (q["x"] - p["x"]) / F.nullif(q["y"] - p["y"], F.lit(0.0))), 1).otherwise(0)

    return F.aggregate(F.transform(polygon, crosses), F.lit(0), lambda s, v: s + v) % 2 == 1


def orientation(px: Column, py: Column, qx: Column, qy: Column, rx: Column, ry: Column) -> Column:
    """1 clockwise, -1 counter-clockwise, 0 on a line."""
    return F.signum((qy - py) * (rx - qx) - (qx - px) * (ry - qy)).cast("int")


def on_segment(px: Column, py: Column, qx: Column, qy: Column, rx: Column, ry: Column) -> Column:
    """Whether q, on the line of p and r, lies between them."""
    return (qx <= F.greatest(px, rx)) & (qx >= F.least(px, rx)) & (qy <= F.greatest(py, ry)) & (qy >= F.least(py, ry))


def segments_intersect(a: tuple[Column, Column, Column, Column], b: tuple[Column, Column, Column, Column]) -> Column:
    """Whether two segments (x1, y1, x2, y2) have a point in common, ends and collinear cases included."""
    (ax, ay, bx, by), (cx, cy, dx, dy) = a, b
    o1, o2 = orientation(ax, ay, bx, by, cx, cy), orientation(ax, ay, bx, by, dx, dy)
    o3, o4 = orientation(cx, cy, dx, dy, ax, ay), orientation(cx, cy, dx, dy, bx, by)
    return (
        ((o1 != o2) & (o3 != o4))
        | ((o1 == 0) & on_segment(ax, ay, cx, cy, bx, by))
        | ((o2 == 0) & on_segment(ax, ay, dx, dy, bx, by))
        | ((o3 == 0) & on_segment(cx, cy, ax, ay, dx, dy))
        | ((o4 == 0) & on_segment(cx, cy, bx, by, dx, dy))
    )


def wrap(angle: Column) -> Column:
    """An angle in (-pi, pi]."""
    return F.atan2(F.sin(angle), F.cos(angle))


def yaw_quaternion(yaw: Column) -> Column:
    """[w, x, y, z] of a turn about the vertical."""
    return F.array(F.cos(yaw / 2), F.lit(0.0), F.lit(0.0), F.sin(yaw / 2))


def hamilton(a: Column, b: Column) -> Column:
    """The product of two quaternions [w, x, y, z]."""
    g = lambda q, i: F.get(q, F.lit(i))
    (aw, ax, ay, az), (bw, bx, by, bz) = ([g(q, i) for i in range(4)] for q in (a, b))
    return F.array(
        aw * bw - ax * bx - ay * by - az * bz,
        aw * bx + ax * bw + ay * bz - az * by,
        aw * by - ax * bz + ay * bw + az * bx,
        aw * bz + ax * by - ay * bx + az * bw,
    )


def look_at(x: Column, y: Column, z: Column, tx: Column, ty: Column, tz: Column) -> Column:
    """The quaternion that turns by yaw towards a target and then pitches to it."""
    yaw = F.atan2(ty - y, tx - x)
    pitch = -F.atan2(tz - z, F.sqrt((tx - x) * (tx - x) + (ty - y) * (ty - y)))
    return hamilton(yaw_quaternion(yaw), F.array(F.cos(pitch / 2), F.lit(0.0), F.sin(pitch / 2), F.lit(0.0)))


def side_faces(p: str = "") -> Column:
    """The two opposing upright faces of a box with the larger area, as an array of (cx, cy, cz, nx, ny); equal areas and thin boxes give the faces across x."""
    c = lambda m, x: F.col(f"{p}{m}_{x}")
    mid = lambda x: (c("min", x) + c("max", x)) / 2
    across_x = (c("max", "y") - c("min", "y")) * (c("max", "z") - c("min", "z"))
    across_y = (c("max", "x") - c("min", "x")) * (c("max", "z") - c("min", "z"))
    face = lambda cx, cy, nx, ny: F.struct(cx.alias("cx"), cy.alias("cy"), mid("z").alias("cz"), F.lit(nx).alias("nx"), F.lit(ny).alias("ny"))
    xs = F.array(face(c("max", "x"), mid("y"), 1.0, 0.0), face(c("min", "x"), mid("y"), -1.0, 0.0))
    ys = F.array(face(mid("x"), c("max", "y"), 0.0, 1.0), face(mid("x"), c("min", "y"), 0.0, -1.0))
    return F.when((across_x >= across_y) | (F.greatest(across_x, across_y) < 1e-6), xs).otherwise(ys)


def side_faces_yxz(p: str = "") -> Column:
    """``side_faces`` of a box whose columns x and y hold the other axis first: measured in the swapped frame and given back in the box's own, lower face first."""
    c = lambda m, x: F.col(f"{p}{m}_{x}")
    mid = lambda x: (c("min", x) + c("max", x)) / 2
    across_y = (c("max", "x") - c("min", "x")) * (c("max", "z") - c("min", "z"))
    across_x = (c("max", "y") - c("min", "y")) * (c("max", "z") - c("min", "z"))
    face = lambda cx, cy, nx, ny: F.struct(cx.alias("cx"), cy.alias("cy"), mid("z").alias("cz"), F.lit(nx).alias("nx"), F.lit(ny).alias("ny"))
    ys = F.array(face(mid("x"), c("min", "y"), 0.0, -1.0), face(mid("x"), c("max", "y"), 0.0, 1.0))
    xs = F.array(face(c("min", "x"), mid("y"), -1.0, 0.0), face(c("max", "x"), mid("y"), 1.0, 0.0))
    return F.when((across_y >= across_x) | (F.greatest(across_x, across_y) < 1e-6), ys).otherwise(xs)


def front_face(x: Column, y: Column, z: Column, p: str = "") -> Column:
    """One face (cx, cy, cz, nx, ny, nz) of a box: of the pair of upright faces with the larger area that which looks away from (x, y, z), the
    lower one if both or none do. Boxes without upright faces of any size give one of their largest pair, the ground pair too."""
    c = lambda m, a: F.col(f"{p}{m}_{a}")
    mid = {a: (c("min", a) + c("max", a)) / 2 for a in AXES}
    size = {a: c("max", a) - c("min", a) for a in AXES}
    at = dict(zip(AXES, (x, y, z), strict=True))
    area = {"x": size["y"] * size["z"], "y": size["x"] * size["z"], "z": size["x"] * size["y"]}

    def face(axis: str) -> Column:
        one = lambda m, s: F.struct(*((c(m, a) if a == axis else mid[a]).alias(f"c{a}") for a in AXES), *(F.lit(s if a == axis else 0.0).alias(f"n{a}") for a in AXES))
        # The lower face's normal is minus the axis; the point lies behind it if it lies above the face.
        return F.when(at[axis] > c("min", axis), one("min", -1.0)).otherwise(one("max", 1.0))

    upright = F.when(area["x"] >= area["y"], face("x")).otherwise(face("y"))
    any_ = F.when((area["y"] >= area["z"]) & (area["y"] >= area["x"]), face("y")).when(area["z"] >= area["x"], face("z")).otherwise(face("x"))
    return F.when(F.greatest(area["x"], area["y"]) < 1e-6, any_).otherwise(upright)


def rotation_to(o: tuple[Column, ...], a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    """Rows of the rotation matrix that turns direction ``o`` to the direction from a to b, about the normal of both; the identity where a and b
    are one point or the directions agree. Opposite directions turn half a circle about a normal of ``o``."""
    unit = lambda v, n: [x / F.nullif(n, F.lit(0.0)) for x in v]
    norm = lambda v: F.sqrt(v[0] * v[0] + v[1] * v[1] + v[2] * v[2])
    cross = lambda p, q: [p[1] * q[2] - p[2] * q[1], p[2] * q[0] - p[0] * q[2], p[0] * q[1] - p[1] * q[0]]
    step = [q - p for p, q in zip(a, b, strict=True)]
    v, w = unit(o, norm(o)), unit(step, norm(step))
    d = v[0] * w[0] + v[1] * w[1] + v[2] * w[2]
    k, flat = cross(v, w), F.abs(v[0]) > 1 - 1e-12
    # About the normal k of length sin: I + [k] + [k]^2 / (1 + cos).
    about = lambda k, s, t: [[F.lit(float(i == j)) + s * e + t * (k[i] * k[j] - (kk if i == j else F.lit(0.0))) for j, e in enumerate(row)] for kk in [k[0] * k[0] + k[1] * k[1] + k[2] * k[2]] for i, row in enumerate([[F.lit(0.0), -k[2], k[1]], [k[2], F.lit(0.0), -k[0]], [-k[1], k[0], F.lit(0.0)]])]
    side = [F.when(flat, p).otherwise(q) for p, q in zip(cross(v, [F.lit(0.0), F.lit(1.0), F.lit(0.0)]), cross(v, [F.lit(1.0), F.lit(0.0), F.lit(0.0)]), strict=True)]
    half = about(unit(side, norm(side)), F.lit(0.0), F.lit(2.0))
    turn = about(k, F.lit(1.0), 1 / F.nullif(1 + d, F.lit(0.0)))
    same = (norm(step) < 1e-6) | (F.abs(d - 1) <= 1e-5)
    rows = lambda m: F.array(*(F.array(*r) for r in m))
    one = [[F.lit(float(i == j)) for j in range(3)] for i in range(3)]
    return F.when(same, rows(one)).when(F.abs(d + 1) <= 1e-5, rows(half)).otherwise(rows(turn))


def let(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def quaternion_matrix(q: Column) -> Column:
    """Rows of the rotation matrix of a unit quaternion [w, x, y, z]."""
    return let(q, _matrix)


def _matrix(q: Column) -> Column:
    w, x, y, z = (F.get(q, F.lit(i)) for i in range(4))
    return F.array(
        F.array(1 - 2 * (y * y + z * z), 2 * (x * y - w * z), 2 * (x * z + w * y)),
        F.array(2 * (x * y + w * z), 1 - 2 * (x * x + z * z), 2 * (y * z - w * x)),
        F.array(2 * (x * z - w * y), 2 * (y * z + w * x), 1 - 2 * (x * x + y * y)),
    )


def euler_quaternion(roll: Column, pitch: Column, yaw: Column) -> Column:
    """[w, x, y, z] of a roll about x, then a pitch about y, then a yaw about z, all about fixed axes."""
    zero = F.lit(0.0)
    about_x = F.array(F.cos(roll / 2), F.sin(roll / 2), zero, zero)
    about_y = F.array(F.cos(pitch / 2), zero, F.sin(pitch / 2), zero)
    return hamilton(yaw_quaternion(yaw), hamilton(about_y, about_x))


def quaternion_euler(q: Column) -> Column:
    """Struct (roll, pitch, yaw) of a unit quaternion, the inverse of ``euler_quaternion`` for pitches within a quarter circle."""
    return let(q, _euler)


def _euler(q: Column) -> Column:
    w, x, y, z = (F.get(q, F.lit(i)) for i in range(4))
    sine = F.greatest(F.least(2 * (w * y - z * x), F.lit(1.0)), F.lit(-1.0))
    return F.struct(F.atan2(2 * (w * x + y * z), 1 - 2 * (x * x + y * y)).alias("roll"), F.asin(sine).alias("pitch"), F.atan2(2 * (w * z + x * y), 1 - 2 * (y * y + z * z)).alias("yaw"))


def matrix_quaternion(m: Column) -> Column:
    """The unit quaternion with w >= 0 of a rotation matrix (rows)."""
    return let(m, _quaternion)


def _quaternion(m: Column) -> Column:
    g = lambda i, j: F.get(F.get(m, F.lit(i)), F.lit(j))
    root = lambda v: F.sqrt(F.greatest(v, F.lit(0.0))) / 2
    sign = lambda v, s: F.when(s < 0, -v).otherwise(v)
    xx, yy, zz = g(0, 0), g(1, 1), g(2, 2)
    return F.array(root(1 + xx + yy + zz), sign(root(1 + xx - yy - zz), g(2, 1) - g(1, 2)), sign(root(1 - xx + yy - zz), g(0, 2) - g(2, 0)), sign(root(1 - xx - yy + zz), g(1, 0) - g(0, 1)))


def pose_matrix(q: Column, x: Column, y: Column, z: Column) -> Column:
    """The four rows of a homogeneous pose from a quaternion and a place."""
    last = F.array(*(F.lit(v) for v in (0.0, 0.0, 0.0, 1.0)))
    return let(quaternion_matrix(q), lambda m: F.array(*(F.concat(F.get(m, F.lit(i)), F.array(t)) for i, t in enumerate((x, y, z))), last))


def matrix_pose(m: Column) -> Column:
    """Struct (q, x, y, z) of a homogeneous pose: the inverse of ``pose_matrix`` up to the quaternion's sign."""
    at = lambda m, i: F.get(F.get(m, F.lit(i)), F.lit(3))
    return let(m, lambda m: F.struct(_quaternion(m).alias("q"), at(m, 0).alias("x"), at(m, 1).alias("y"), at(m, 2).alias("z")))


def segment_distance(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """The distance of a point to a segment."""
    ux, uy = bx - ax, by - ay
    t = F.greatest(F.least(((px - ax) * ux + (py - ay) * uy) / F.nullif(ux * ux + uy * uy, F.lit(0.0)), F.lit(1.0)), F.lit(0.0))
    t = F.coalesce(t, F.lit(0.0))
    dx, dy = px - (ax + t * ux), py - (ay + t * uy)
    return F.sqrt(dx * dx + dy * dy)
