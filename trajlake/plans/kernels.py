"""Queries whose kernels SQL can't express; tests hold them against invariants and small cases."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from trajlake.functions import geometry as G
from trajlake.kernels import search as K
from trajlake.kernels import shapes as P
from trajlake.operators import planning as L
from trajlake.plans.catalog import query, table
from trajlake.plans.grids import _POINTS, _draws, _points
from trajlake.operators import trajectory as T
from trajlake.plans.trajectories import CROSS, _lines
from trajlake.sources.testbed import CELLS, OBJECTS, STEPS, cells, objects, steps


def _rounded(paths):
    return paths.select("traj", "step", *((F.round(c, 6) + 0).alias(c) for c in ("x", "y")))


_LINE = """p AS (SELECT c_custkey AS key, CAST(c_custkey * 3 % 64 AS INTEGER) AS r0, CAST(c_custkey * 5 % 64 AS INTEGER) AS c0, CAST(c_custkey * 7 % 64 AS INTEGER) AS r1, CAST(c_custkey * 11 % 64 AS INTEGER) AS c1 FROM customer),
n AS (SELECT *, greatest(abs(r1 - r0), abs(c1 - c0)) AS n FROM p),
l AS (SELECT key, CAST(i AS INTEGER) AS i, CAST(r0 + sign(r1 - r0) * CASE WHEN n = 0 THEN 0 ELSE (2 * i * abs(r1 - r0) + n) // (2 * n) END AS INTEGER) AS row, CAST(c0 + sign(c1 - c0) * CASE WHEN n = 0 THEN 0 ELSE (2 * i * abs(c1 - c0) + n) // (2 * n) END AS INTEGER) AS col FROM n, range(0, 64) t(i) WHERE i <= n)"""


def _gaussian_sql(sigma: float) -> str:
    r = int(4.0 * sigma + 0.5)
    w = [math.exp(-0.5 * (k / sigma) ** 2) for k in range(-r, r + 1)]
    rows = ", ".join(f"({k - r}, {v / sum(w)!r}::DOUBLE)" for k, v in enumerate(w))
    return f"""WITH {STEPS}, c AS (SELECT *, count(*) OVER (PARTITION BY traj) AS n FROM steps), g AS (SELECT traj, step, n, w, ((step + k) % (2 * n) + 2 * n) % (2 * n) AS m FROM c, (VALUES {rows}) v(k, w))
SELECT g.traj, g.step, round(sum(w * s.x), 6) + 0 AS x, round(sum(w * s.y), 6) + 0 AS y FROM g JOIN steps s ON s.traj = g.traj AND s.step = CASE WHEN m < n THEN m ELSE 2 * n - 1 - m END GROUP BY g.traj, g.step"""


def _polynomial_sql(window: int = 21, order: int = 3) -> str:
    """The hat matrices of all odd windows, by their rule."""
    import numpy as np

    rows = []
    for w in range(order + 2 if order % 2 else order + 1, window + 1, 2):
        a = np.vander(np.arange(-(w // 2), w // 2 + 1), order + 1, increasing=True).astype(float)
        rows += [f"({w}, {i}, {j}, {float(v)!r}::DOUBLE)" for i, r in enumerate(a @ np.linalg.pinv(a)) for j, v in enumerate(r)]
    return f"""WITH {STEPS}, hat AS (SELECT * FROM (VALUES {", ".join(rows)}) v(w, i, j, v)), c AS (SELECT *, count(*) OVER (PARTITION BY traj) AS n FROM steps),
b AS (SELECT *, least({window}, CASE WHEN n % 2 = 1 THEN n ELSE n - 1 END) AS w FROM c), s0 AS (SELECT *, least(greatest(step - w // 2, 0), n - w) AS s FROM b)
SELECT s0.traj, s0.step, round(sum(h.v * p.x), 6) + 0 AS x, round(sum(h.v * p.y), 6) + 0 AS y FROM s0 JOIN hat h ON h.w = s0.w AND h.i = s0.step - s0.s JOIN steps p ON p.traj = s0.traj AND p.step = s0.s + h.j GROUP BY s0.traj, s0.step
UNION ALL SELECT traj, step, x, y FROM b WHERE w <= {order}"""


_SPLINE = f"""WITH {STEPS}, c AS (SELECT *, count(*) OVER w AS n, lead(x) OVER v AS nx, lag(x) OVER v AS px, lead(y) OVER v AS ny, lag(y) OVER v AS py FROM steps WINDOW w AS (PARTITION BY traj), v AS (PARTITION BY traj ORDER BY step)),
g AS (SELECT *, CASE WHEN px IS NULL THEN nx - x WHEN nx IS NULL THEN x - px ELSE (nx - px) / 2 END AS mx, CASE WHEN py IS NULL THEN ny - y WHEN ny IS NULL THEN y - py ELSE (ny - py) / 2 END AS my FROM c),
k AS (SELECT traj, n, k, CAST(k AS DOUBLE) * (CAST(n - 1 AS DOUBLE) / (4 * n - 1)) AS t FROM (SELECT DISTINCT traj, n FROM c WHERE n >= 3), range(0, 100000) r(k) WHERE k < 4 * n),
u AS (SELECT *, least(CAST(floor(t) AS BIGINT), n - 2) AS i FROM k), h AS (SELECT *, t - i AS u FROM u),
f AS (SELECT *, 2 * u ** 3 - 3 * u ** 2 + 1 AS h00, u ** 3 - 2 * u ** 2 + u AS h10, -2 * u ** 3 + 3 * u ** 2 AS h01, u ** 3 - u ** 2 AS h11 FROM h)
SELECT f.traj, f.k AS step, round(h00 * a.x + h10 * a.mx + h01 * b.x + h11 * b.mx, 6) + 0 AS x, round(h00 * a.y + h10 * a.my + h01 * b.y + h11 * b.my, 6) + 0 AS y FROM f JOIN g a ON a.traj = f.traj AND a.step = f.i JOIN g b ON b.traj = f.traj AND b.step = f.i + 1
UNION ALL SELECT traj, step, x, y FROM c WHERE n < 3"""

_SIMPLE = f"""WITH RECURSIVE {STEPS.replace("steps AS (", "steps AS MATERIALIZED (")}, c AS MATERIALIZED (SELECT *, lead(x) OVER w AS nx, lead(y) OVER w AS ny FROM steps WINDOW w AS (PARTITION BY traj ORDER BY step)),
k AS (SELECT traj, step, x, y, true AS kept, x AS lx, y AS ly FROM c WHERE step = 0
  UNION ALL SELECT traj, step, x, y, kept, CASE WHEN kept THEN x ELSE lx END, CASE WHEN kept THEN y ELSE ly END FROM (
    SELECT c.traj, c.step, c.x, c.y, k.lx, k.ly, c.nx IS NULL OR coalesce(((c.x - k.lx) * (c.nx - c.x) + (c.y - k.ly) * (c.ny - c.y)) / nullif(sqrt((c.x - k.lx) ** 2 + (c.y - k.ly) ** 2) * sqrt((c.nx - c.x) ** 2 + (c.ny - c.y) ** 2), 0) < 1 - 1e-6, false) AS kept
    FROM k JOIN c ON c.traj = k.traj AND c.step = k.step + 1)),
small AS (SELECT traj FROM c GROUP BY traj HAVING count(*) < 3),
p AS MATERIALIZED (SELECT traj, row_number() OVER (PARTITION BY traj ORDER BY step) - 1 AS i, x, y FROM (SELECT traj, step, x, y FROM k WHERE kept UNION SELECT traj, step, x, y FROM c WHERE traj IN (SELECT traj FROM small))),
t AS (SELECT traj, CAST(0 AS BIGINT) AS a, max(i) AS b FROM p GROUP BY traj
  UNION ALL SELECT traj, CASE side WHEN 0 THEN a ELSE far END, CASE side WHEN 0 THEN far ELSE b END FROM (
    SELECT t.traj, t.a, t.b, f.far FROM t, LATERAL (SELECT min(i) FILTER (WHERE d = top) AS far, any_value(top) AS top FROM (SELECT i, d, max(d) OVER () AS top FROM (
      SELECT m.i, CASE WHEN n > 0 THEN abs((m.x - u.x) * (v.y - u.y) - (m.y - u.y) * (v.x - u.x)) / n ELSE sqrt((m.x - u.x) ** 2 + (m.y - u.y) ** 2) END AS d
      FROM p m, (SELECT * FROM p WHERE p.traj = t.traj AND p.i = t.a) u, (SELECT * FROM p WHERE p.traj = t.traj AND p.i = t.b) v, LATERAL (SELECT sqrt((v.x - u.x) ** 2 + (v.y - u.y) ** 2) AS n) WHERE m.traj = t.traj AND m.i > t.a AND m.i < t.b))) f WHERE f.top > 0.3), range(0, 2) s(side)),
e AS (SELECT traj, a AS i FROM t UNION SELECT traj, b FROM t)
SELECT traj, row_number() OVER (PARTITION BY traj ORDER BY i) - 1 AS step, x, y FROM e JOIN p USING (traj, i)"""

_FOLLOW = f"""WITH RECURSIVE {STEPS.replace("steps AS (", "steps AS MATERIALIZED (")},
go AS (SELECT s.traj, CAST(1 AS BIGINT) AS goal, CAST(0 AS BIGINT) AS n, -1 AS action, s.x, s.y, atan2(q.y - s.y, q.x - s.x) AS heading FROM steps s JOIN steps q ON q.traj = s.traj AND s.step = 0 AND q.step = 1
  UNION ALL SELECT traj, CASE WHEN near OR (NOT turns AND sqrt((tx - fx) ** 2 + (ty - fy) ** 2) > d) THEN goal + 1 ELSE goal END, CASE WHEN near THEN n ELSE n + 1 END, CASE WHEN near THEN -1 WHEN turns THEN CASE WHEN off > 0 THEN 2 ELSE 3 END ELSE 1 END,
    CASE WHEN near OR turns THEN x ELSE fx END, CASE WHEN near OR turns THEN y ELSE fy END, CASE WHEN turns AND NOT near THEN heading + CASE WHEN off > 0 THEN radians(15) ELSE -radians(15) END ELSE heading END
  FROM (SELECT *, d < 0.125 AS near, abs(off) > radians(15) / 2 + 1e-9 AS turns, x + 0.25 * cos(heading) AS fx, y + 0.25 * sin(heading) AS fy FROM (
    SELECT g.*, s.x AS tx, s.y AS ty, sqrt((s.x - g.x) ** 2 + (s.y - g.y) ** 2) AS d, (atan2(s.y - g.y, s.x - g.x) - g.heading + pi()) - 2 * pi() * floor((atan2(s.y - g.y, s.x - g.x) - g.heading + pi()) / (2 * pi())) - pi() AS off FROM go g JOIN steps s ON s.traj = g.traj AND s.step = g.goal))),
done AS (SELECT traj, n - 1 AS i, action FROM go WHERE action > 0)
SELECT traj, i, action FROM done UNION ALL SELECT s.traj, coalesce(max(i) + 1, 0), 0 FROM (SELECT DISTINCT traj FROM steps) s LEFT JOIN done USING (traj) GROUP BY s.traj"""

_HULLS = f"""WITH {_POINTS}, d AS MATERIALIZED (SELECT DISTINCT vec_id, x, y, z FROM pts), o AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY x, y, z) AS k FROM d),
n AS (SELECT a.vec_id, a.k AS k1, b.k AS k2, c.k AS k3, a.x AS px, a.y AS py, a.z AS pz, (b.y - a.y) * (c.z - a.z) - (b.z - a.z) * (c.y - a.y) AS nx, (b.z - a.z) * (c.x - a.x) - (b.x - a.x) * (c.z - a.z) AS ny, (b.x - a.x) * (c.y - a.y) - (b.y - a.y) * (c.x - a.x) AS nz
  FROM o a JOIN o b ON a.vec_id = b.vec_id AND a.k < b.k JOIN o c ON c.vec_id = b.vec_id AND b.k < c.k),
s AS (SELECT n.vec_id, k1, k2, k3, any_value(px) AS px, any_value(py) AS py, any_value(pz) AS pz, any_value(nx) AS nx, any_value(ny) AS ny, any_value(nz) AS nz, min(nx * (q.x - px) + ny * (q.y - py) + nz * (q.z - pz)) AS lo, max(nx * (q.x - px) + ny * (q.y - py) + nz * (q.z - pz)) AS hi
  FROM n JOIN o q ON q.vec_id = n.vec_id GROUP BY n.vec_id, k1, k2, k3),
f AS MATERIALIZED (SELECT *, CASE WHEN lo >= 0 THEN -1 ELSE 1 END AS side FROM s WHERE (lo >= 0) <> (hi <= 0)),
r AS (SELECT p.vec_id AS a, p.vec_id + 1 AS b, p.i, max(side * (nx * (p.x - px) + ny * (p.y - py) + nz * (p.z - pz))) AS out FROM pts p LEFT JOIN f ON f.vec_id = p.vec_id + 1 WHERE p.vec_id + 1 IN (SELECT vec_id FROM pts) GROUP BY p.vec_id, p.i)
SELECT a, b, avg(CASE WHEN out <= 0 THEN 1.0::DOUBLE ELSE 0 END) AS share FROM r GROUP BY a, b"""

_SNAPPED = f"""WITH RECURSIVE {STEPS.replace("steps AS (", "steps AS MATERIALIZED (")}, q AS (SELECT traj, step, x, y FROM steps WHERE step = 0
UNION ALL SELECT s.traj, s.step, CASE WHEN abs(abs(s.x - q.x) - 0.25) <= 1e-6 THEN q.x ELSE s.x END, CASE WHEN abs(abs(s.y - q.y) - 0.25) <= 1e-6 THEN q.y ELSE s.y END FROM q JOIN steps s ON s.traj = q.traj AND s.step = q.step + 1)
SELECT traj, step, x, y FROM q"""


def _world(spark) -> K.World:
    return K.World(L.raster_array(cells(spark)), 0.0, 0.0, 0.25)


@query(
    "clear_cells",
    f"""WITH {CELLS} SELECT c.row, c.col, c.free AND NOT coalesce(bool_or(NOT o.free), false) AS clear FROM cells c LEFT JOIN cells o ON abs(o.row - c.row) <= 1 AND abs(o.col - c.col) <= 1 GROUP BY c.row, c.col, c.free""",
)
def clear_cells(spark, sf_dir):
    """Cells that the planner may enter with a footprint of one cell about it."""
    w = _world(spark)
    return cells(spark).select("row", "col").mapInPandas(lambda batches: (p.assign(clear=w.clear(1)[p["row"], p["col"]]) for p in batches), "row int, col int, clear boolean")


@query("planned_paths")
def planned_paths(spark, sf_dir):
    """Paths of poses for each nation's goal from a few starts."""
    k = F.col("n_nationkey").cast("long")
    g = table(spark, sf_dir, "nation").select(k.alias("goal"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(3).cast("long"))).alias("order"), ((k * 5 % 14 + 1) * 1.0).alias("gx"), ((k * 3 % 3 + 1) * 0.75).alias("gy"))
    g = g.withColumns({"sx": (F.col("order") * 3 + 1) * 1.0, "sy": F.lit(0.5)})
    return L.plan_goals(g, _world(spark))


@query("grid_paths")
def grid_paths(spark, sf_dir):
    k = F.col("c_custkey")
    at = lambda m: (k * m % 64).cast("int")
    p = table(spark, sf_dir, "customer").select(k.alias("key"), at(3).alias("r0"), at(5).alias("c0"), at(7).alias("r1"), at(11).alias("c1"))
    return L.grid_paths(p, L.raster_array(cells(spark)))


@query(
    "lines",
    f"""WITH {CELLS}, {_LINE}, bad AS (SELECT c.row, c.col, bool_or(NOT coalesce(o.free, false)) AS hit FROM cells c CROSS JOIN (SELECT a AS dr, b AS dc FROM range(-1, 2) x(a), range(-1, 2) y(b)) LEFT JOIN cells o ON o.row = c.row + dr AND o.col = c.col + dc GROUP BY c.row, c.col)
SELECT key, i, row, col, bool_or(hit) OVER (PARTITION BY key) AS blocked FROM l JOIN bad USING (row, col)""",
)
def lines(spark, sf_dir):
    k = F.col("c_custkey")
    at = lambda m: (k * m % 64).cast("int")
    p = table(spark, sf_dir, "customer").select(k.alias("key"), at(3).alias("r0"), at(5).alias("c0"), at(7).alias("r1"), at(11).alias("c1"))
    return L.line_table(p, L.raster_array(cells(spark)), 1)


@query("discrete_actions", _FOLLOW)
def discrete_actions(spark, sf_dir):
    return L.discrete_actions(steps(spark, sf_dir))


@query("simplified_paths", _SIMPLE)
def simplified_paths(spark, sf_dir):
    return L.per_path(steps(spark, sf_dir), lambda p: P.simplify(P.drop_collinear(p), 0.3))


@query("gaussian_paths", _gaussian_sql(2.0))
def gaussian_paths(spark, sf_dir):
    return _rounded(L.per_path(steps(spark, sf_dir), lambda p: P.gaussian_smooth(p, 2.0)))


@query("polynomial_paths", _polynomial_sql())
def polynomial_paths(spark, sf_dir):
    return _rounded(L.per_path(steps(spark, sf_dir), P.polynomial_smooth))


@query("spline_paths", _SPLINE)
def spline_paths(spark, sf_dir):
    return _rounded(L.per_path(steps(spark, sf_dir), lambda p: P.spline(p, 4 * len(p))))


@query("bspline_paths")
def bspline_paths(spark, sf_dir):
    return _rounded(L.per_path(steps(spark, sf_dir), P.bspline_smooth))


@query("tidy_paths")
def tidy_paths(spark, sf_dir):
    """The whole pipeline for found paths, laid over the raster in cells; its forms are tested with free rasters against their parts."""
    free = L.raster_array(cells(spark))
    s = steps(spark, sf_dir).withColumns({"x": F.col("x") * 4 + 32, "y": F.col("y") * 4 + 32})
    return L.per_path(s, lambda p: P.tidy(p, free, "cells"))


@query(
    "densify_every",
    f"""WITH {STEPS}, l AS (SELECT *, lead(x) OVER w AS nx, lead(y) OVER w AS ny, sqrt((lead(x) OVER w - x) ** 2 + (lead(y) OVER w - y) ** 2) AS leg FROM steps WINDOW w AS (PARTITION BY traj ORDER BY step))
SELECT traj, step, CAST(i AS INTEGER) AS sub, round(x + (nx - x) * (i * 0.1::DOUBLE / leg), 6) + 0 AS x, round(y + (ny - y) * (i * 0.1::DOUBLE / leg), 6) + 0 AS y FROM l, range(1, 10) r(i) WHERE leg > 0 AND i <= floor(leg / 0.1::DOUBLE)
UNION ALL SELECT traj, step, 0, x, y FROM l WHERE step = 0 UNION ALL SELECT traj, step, CASE WHEN step = 0 THEN 1 ELSE 0 END, x, y FROM l WHERE nx IS NULL""",
)
def densify_every(spark, sf_dir):
    """A point each tenth of a metre along every leg."""
    return T.densify_every(steps(spark, sf_dir), 0.1).select("traj", "step", "sub", *((F.round(c, 6) + 0).alias(c) for c in ("x", "y")))


@query(
    "raster_paths",
    f"""WITH {STEPS}, l AS (SELECT traj, step, CAST(floor(y * 16 + 0.5) AS BIGINT) AS r0, CAST(floor(x * 16 + 0.5) AS BIGINT) AS c0, CAST(floor(lead(y) OVER w * 16 + 0.5) AS BIGINT) AS r1, CAST(floor(lead(x) OVER w * 16 + 0.5) AS BIGINT) AS c1 FROM steps WINDOW w AS (PARTITION BY traj ORDER BY step)),
n AS (SELECT *, greatest(abs(r1 - r0), abs(c1 - c0)) AS n FROM l WHERE r1 IS NOT NULL)
SELECT traj, step, CAST(i AS INTEGER) AS i, CAST(r0 + sign(r1 - r0) * CASE WHEN n = 0 THEN 0 ELSE (2 * i * abs(r1 - r0) + n) // (2 * n) END AS INTEGER) AS row, CAST(c0 + sign(c1 - c0) * CASE WHEN n = 0 THEN 0 ELSE (2 * i * abs(c1 - c0) + n) // (2 * n) END AS INTEGER) AS col
FROM n, range(0, 64, 2) t(i) WHERE i <= n AND (step = 0 OR i > 0)""",
)
def raster_paths(spark, sf_dir):
    """Paths as every second cell of their lines."""
    return T.raster_path(steps(spark, sf_dir).withColumns({"x": F.col("x") * 16, "y": F.col("y") * 16}), 2)


@query(
    "paths_through_doors",
    f"""WITH {CROSS}, met AS (SELECT DISTINCT traj, line, (rx + sx) / 2 AS qx, (ry + sy) / 2 AS qy FROM hits), ends AS (SELECT traj, arg_min(x, step) AS ax, arg_min(y, step) AS ay, arg_max(x, step) AS bx, arg_max(y, step) AS by, count(*) AS n FROM steps GROUP BY traj)
SELECT e.traj, m.line, CASE WHEN m.line IS NULL THEN e.n ELSE 3 END AS n, e.ax, e.ay, m.qx, m.qy, e.bx, e.by FROM ends e LEFT JOIN met m USING (traj)""",
)
def paths_through_doors(spark, sf_dir):
    """Paths cut down to start, door and end for each door line that they meet."""
    p = T.through_door(steps(spark, sf_dir), _lines(spark))
    at = lambda i, k: F.get(F.get("path", i), F.lit(k))
    last = F.size("path") - 1
    door = lambda k: F.when(F.col("line").isNotNull(), at(F.lit(1), k))
    return p.select("traj", "line", F.size("path").cast("long").alias("n"), at(F.lit(0), 0).alias("ax"), at(F.lit(0), 1).alias("ay"), door(0).alias("qx"), door(1).alias("qy"), at(last, 0).alias("bx"), at(last, 1).alias("by"))


@query("safe_paths")
def safe_paths(spark, sf_dir):
    """Smoothing that keeps clear of obstacles, with paths laid over the raster in cells."""
    free = L.raster_array(cells(spark))
    s = steps(spark, sf_dir).withColumns({"x": F.col("x") * 4 + 32, "y": F.col("y") * 4 + 32})
    return L.per_path(s, lambda p: P.safe_smooth(p, free, 2.0))


@query("snapped_paths", _SNAPPED)
def snapped_paths(spark, sf_dir):
    return L.per_path(steps(spark, sf_dir), lambda p: P.snap_jitters(p, (0.25,)))


@query("hull_shares", _HULLS)
def hull_shares(spark, sf_dir):
    p = _points(spark, sf_dir)
    pairs = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("a")).distinct().withColumn("b", F.col("a") + 1)
    return L.hull_shares(pairs, p, "vec_id")


@query("representative_points")
def representative_points(spark, sf_dir):
    d = _draws(spark).select(F.col("room").cast("long").alias("room"), F.col("col").cast("double").alias("x"), F.col("row").cast("double").alias("y"))
    return L.representative_points(d, "room", 5)


_Q = "atan2(my - 8, mx - 8)"


@query(
    "camera_poses",
    f"""WITH {OBJECTS}, m AS (SELECT id, (min_x + max_x) / 2 AS mx, (min_y + max_y) / 2 AS my, (min_z + max_z) / 2 AS mz FROM objects),
a AS (SELECT id, {_Q} AS yaw, -atan2(mz - 1.5, sqrt((mx - 8) ** 2 + (my - 8) ** 2)) AS pitch FROM m)
SELECT id, round(cos(yaw / 2) * cos(pitch / 2), 6) + 0 AS w, round(-sin(yaw / 2) * sin(pitch / 2), 6) + 0 AS x, round(cos(yaw / 2) * sin(pitch / 2), 6) + 0 AS y, round(sin(yaw / 2) * cos(pitch / 2), 6) + 0 AS z FROM a""",
)
def camera_poses(spark, sf_dir):
    """Quaternions that look from the middle of the scene at each object."""
    mid = lambda c: (F.col(f"min_{c}") + F.col(f"max_{c}")) / 2
    q = objects(spark, sf_dir).select("id", G.look_at(F.lit(8.0), F.lit(8.0), F.lit(1.5), mid("x"), mid("y"), mid("z")).alias("q"))
    return q.select("id", *((F.round(F.get("q", F.lit(i)), 6) + 0).alias(n) for i, n in enumerate("wxyz")))


@query(
    "turned_yaws",
    "SELECT event_id, round(atan2(sin(radians(value % 360) + radians(15)), cos(radians(value % 360) + radians(15))), 6) + 0 AS yaw FROM events",
)
def turned_yaws(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", (F.round(G.wrap(F.radians(F.col("value") % 360) + math.radians(15)), 6) + 0).alias("yaw"))
