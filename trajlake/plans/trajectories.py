"""Trajectory queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from trajlake.functions import geometry as G
from trajlake.operators import trajectory as T
from trajlake.plans.catalog import query
from trajlake.sources.testbed import STEPS, steps

_W = "(PARTITION BY traj ORDER BY step)"
HEADINGS = STEPS + f""",
d AS (SELECT *, x - lag(x) OVER w AS dx, y - lag(y) OVER w AS dy, lead(x) OVER w - x AS nx, lead(y) OVER w - y AS ny,
  CASE lag(action) OVER w WHEN 2 THEN radians(15) WHEN 3 THEN -radians(15) ELSE 0 END AS turn FROM steps WINDOW w AS {_W}),
b AS (SELECT *, coalesce(sqrt(dx * dx + dy * dy) > 0.01, false) AS moved,
  CASE WHEN coalesce(sqrt(dx * dx + dy * dy) > 0.01, false) THEN atan2(dy, dx) WHEN dx IS NULL THEN coalesce(atan2(ny, nx), 0) END AS base FROM d),
i AS (SELECT *, sum(CASE WHEN base IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY traj ORDER BY step ROWS UNBOUNDED PRECEDING) AS island FROM b),
y AS (SELECT *, first_value(base) OVER w + sum(CASE WHEN base IS NULL THEN turn ELSE 0 END) OVER w AS raw
  FROM i WINDOW w AS (PARTITION BY traj, island ORDER BY step ROWS UNBOUNDED PRECEDING)),
headings AS (SELECT traj, step, action, x, y, coalesce(base, atan2(sin(raw), cos(raw))) AS yaw FROM y)"""


@query("headings", f"WITH {HEADINGS} SELECT traj, step, round(cos(yaw), 6) + 0 AS c, round(sin(yaw), 6) + 0 AS s FROM headings")
def headings(spark, sf_dir):
    """Yaw by gaps and islands, as its cosine and sine (pi and -pi are one heading)."""
    return T.headings(steps(spark, sf_dir)).select("traj", "step", (F.round(F.cos("yaw"), 6) + 0).alias("c"), (F.round(F.sin("yaw"), 6) + 0).alias("s"))


@query("yaw_quaternions", f"WITH {HEADINGS} SELECT traj, step, round(abs(cos(yaw / 2)), 6) AS w, round(abs(sin(yaw / 2)), 6) AS z FROM headings")
def yaw_quaternions(spark, sf_dir):
    q = T.headings(steps(spark, sf_dir)).select("traj", "step", G.yaw_quaternion(F.col("yaw")).alias("q"))
    return q.select("traj", "step", F.round(F.abs(F.get("q", F.lit(0))), 6).alias("w"), F.round(F.abs(F.get("q", F.lit(3))), 6).alias("z"))


@query(
    "trim_leading_turns",
    f"""WITH {STEPS}, s AS (SELECT *, (x <> first_value(x) OVER w OR y <> first_value(y) OVER w) AS away, x - lag(x) OVER w AS dx, y - lag(y) OVER w AS dy FROM steps WINDOW w AS {_W}),
m AS (SELECT *, min(step) FILTER (WHERE away) OVER (PARTITION BY traj) AS first_move FROM s),
a AS (SELECT *, max(CASE WHEN step = first_move THEN atan2(dy, dx) END) OVER (PARTITION BY traj) AS angle FROM m)
SELECT traj, step, action, x, y, round(coalesce(angle, 0), 6) AS initial_angle FROM a WHERE first_move IS NULL OR step >= first_move - 1""",
)
def trim_leading_turns(spark, sf_dir):
    t = T.trim_leading_turns(steps(spark, sf_dir))
    return t.withColumn("initial_angle", F.round("initial_angle", 6))


@query("progress", f"WITH {STEPS} SELECT traj, step, round(coalesce(step / nullif(count(*) OVER (PARTITION BY traj) - 1, 0), 0), 6) AS progress FROM steps")
def progress(spark, sf_dir):
    return T.progress(steps(spark, sf_dir)).select("traj", "step", F.round("progress", 6).alias("progress"))


@query("path_lengths", f"WITH {STEPS}, d AS (SELECT traj, coalesce(sqrt((x - lag(x) OVER w) ** 2 + (y - lag(y) OVER w) ** 2), 0) AS d FROM steps WINDOW w AS {_W}) SELECT traj, round(sum(d), 6) AS length, count(*) AS n_steps FROM d GROUP BY traj HAVING sum(d) >= 5")
def path_lengths(spark, sf_dir):
    """Paths of a least length."""
    return T.path_lengths(steps(spark, sf_dir)).where("length >= 5").select("traj", F.round("length", 6).alias("length"), "n_steps")


@query("end_poses", f"WITH {STEPS} SELECT traj, arg_min(x, step) AS start_x, arg_min(y, step) AS start_y, arg_max(x, step) AS goal_x, arg_max(y, step) AS goal_y FROM steps GROUP BY traj")
def end_poses(spark, sf_dir):
    return T.end_poses(steps(spark, sf_dir))


@query("ordered_paths", f"WITH {STEPS} SELECT traj, md5(string_agg(CAST(CAST(x * 4 AS BIGINT) AS VARCHAR) || ',' || CAST(CAST(y * 4 AS BIGINT) AS VARCHAR), ';' ORDER BY step)) AS path FROM steps GROUP BY traj")
def ordered_paths(spark, sf_dir):
    p = T.ordered_path(steps(spark, sf_dir))
    cell = lambda v, i: (F.get(v, F.lit(i)) * 4).cast("long").cast("string")
    return p.select("traj", F.md5(F.array_join(F.transform("path", lambda v: F.concat_ws(",", cell(v, 0), cell(v, 1))), ";")).alias("path"))


@query(
    "replay_frames",
    f"""WITH {STEPS}, s AS (SELECT *, min(step) FILTER (WHERE action = 0) OVER (PARTITION BY traj) AS stop FROM steps),
l AS (SELECT * FROM s WHERE stop IS NULL OR step < stop)
SELECT traj, CAST(row_number() OVER {_W} AS INTEGER) AS frame, sum(CASE action WHEN 2 THEN 15.0::DOUBLE WHEN 3 THEN -15.0::DOUBLE ELSE 0 END) OVER (PARTITION BY traj ORDER BY step ROWS UNBOUNDED PRECEDING) AS heading FROM l
UNION ALL SELECT DISTINCT traj, 0, 0.0::DOUBLE FROM steps""",
)
def replay_frames(spark, sf_dir):
    return T.replay(steps(spark, sf_dir))


@query(
    "dead_reckoning",
    f"""WITH {STEPS}, h AS (SELECT *, coalesce(sum(CASE action WHEN 2 THEN radians(15) WHEN 3 THEN -radians(15) ELSE 0 END) OVER (PARTITION BY traj ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS heading FROM steps),
g AS (SELECT *, CASE WHEN action = 1 THEN 0.25 * cos(heading) ELSE 0 END AS gx, CASE WHEN action = 1 THEN 0.25 * sin(heading) ELSE 0 END AS gy FROM h)
SELECT traj, step, round(coalesce(sum(gx) OVER w, 0), 4) + 0 AS px, round(coalesce(sum(gy) OVER w, 0), 4) + 0 AS py FROM g WINDOW w AS (PARTITION BY traj ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
)
def dead_reckoning(spark, sf_dir):
    return T.dead_reckoning(steps(spark, sf_dir)).select("traj", "step", (F.round("px", 4) + 0).alias("px"), (F.round("py", 4) + 0).alias("py"))


_COUNTS = "SELECT traj, count(*) FILTER (WHERE action = 0) AS n_stop, count(*) FILTER (WHERE action = 1) AS n_forward, count(*) FILTER (WHERE action = 2) AS n_left, count(*) FILTER (WHERE action = 3) AS n_right FROM steps GROUP BY traj"


@query("action_counts", f"WITH {STEPS} {_COUNTS}")
def action_counts(spark, sf_dir):
    return T.action_counts(steps(spark, sf_dir))


@query("action_descriptions", f"WITH {STEPS}, c AS ({_COUNTS}) SELECT traj, printf('Forward: %dx (%.2fm), Left: %dx (%d°), Right: %dx (%d°)', n_forward, n_forward * 0.25::DOUBLE, n_left, n_left * 15, n_right, n_right * 15) AS description FROM c")
def action_descriptions(spark, sf_dir):
    return T.describe_actions(T.action_counts(steps(spark, sf_dir)))


@query("moving_average", f"WITH {STEPS} SELECT traj, step, round(CASE WHEN count(*) OVER w = 5 THEN avg(x) OVER w ELSE x END, 6) AS x, round(CASE WHEN count(*) OVER w = 5 THEN avg(y) OVER w ELSE y END, 6) AS y FROM steps WINDOW w AS (PARTITION BY traj ORDER BY step ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)")
def moving_average(spark, sf_dir):
    return T.moving_average(steps(spark, sf_dir), 5).select("traj", "step", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


@query(
    "smooth_corners",
    f"""WITH {STEPS}, k AS (SELECT *, lag(x) OVER w IS NULL OR lead(x) OVER w IS NULL OR (lag(x) OVER w = x AND lead(x) OVER w = x) OR (lag(y) OVER w = y AND lead(y) OVER w = y) AS keep FROM steps WINDOW w AS {_W})
SELECT traj, step, round(CASE WHEN keep THEN x ELSE avg(x) OVER w END, 6) AS x, round(CASE WHEN keep THEN y ELSE avg(y) OVER w END, 6) AS y FROM k WINDOW w AS (PARTITION BY traj ORDER BY step ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)""",
)
def smooth_corners(spark, sf_dir):
    return T.smooth_corners(steps(spark, sf_dir), 5).select("traj", "step", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


@query(
    "densify",
    f"""WITH {STEPS}, l AS (SELECT *, lead(x) OVER w AS nx, lead(y) OVER w AS ny, sqrt((lead(x) OVER w - x) ** 2 + (lead(y) OVER w - y) ** 2) AS leg FROM steps WINDOW w AS {_W}),
p AS (SELECT *, CAST(ceil(leg / 0.1::DOUBLE) AS INTEGER) AS parts FROM l WHERE leg > 1e-6)
SELECT traj, step, CAST(i AS INTEGER) AS sub, round(x + (nx - x) * i / parts, 6) AS x, round(y + (ny - y) * i / parts, 6) AS y FROM p, range(0, 10) r(i) WHERE i < parts
UNION ALL SELECT traj, step, 0, x, y FROM l WHERE nx IS NULL""",
)
def densify(spark, sf_dir):
    return T.densify(steps(spark, sf_dir), 0.1).select("traj", "step", "sub", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


_ORIENT = "CAST(sign(({1}y - {0}y) * ({2}x - {1}x) - ({1}x - {0}x) * ({2}y - {1}y)) AS INTEGER)"
_ON = "({1}x BETWEEN least({0}x, {2}x) AND greatest({0}x, {2}x) AND {1}y BETWEEN least({0}y, {2}y) AND greatest({0}y, {2}y))"
_LINES = [(0, -1.1, -1.1, 1.1, 1.15), (1, 0.6, -2.0, 0.6, 2.0), (2, -0.5, 0.5, 1.5, 0.5)]
CROSS = STEPS + f""",
lines AS (SELECT line, rx::DOUBLE AS rx, ry::DOUBLE AS ry, sx::DOUBLE AS sx, sy::DOUBLE AS sy FROM (VALUES {', '.join(str(x) for x in _LINES)}) v(line, rx, ry, sx, sy)),
legs AS (SELECT traj, step, x AS px, y AS py, lead(x) OVER w AS qx, lead(y) OVER w AS qy FROM steps WINDOW w AS {_W}),
o AS (SELECT *, {_ORIENT.format('p', 'q', 'r')} AS o1, {_ORIENT.format('p', 'q', 's')} AS o2, {_ORIENT.format('r', 's', 'p')} AS o3, {_ORIENT.format('r', 's', 'q')} AS o4
  FROM legs, lines WHERE qx IS NOT NULL),
hits AS (SELECT * FROM o WHERE (o1 <> o2 AND o3 <> o4) OR (o1 = 0 AND {_ON.format('p', 'r', 'q')}) OR (o2 = 0 AND {_ON.format('p', 's', 'q')}) OR (o3 = 0 AND {_ON.format('r', 'p', 's')}) OR (o4 = 0 AND {_ON.format('r', 'q', 's')}))"""


def _lines(spark):
    return F.broadcast(spark.createDataFrame(_LINES, "line int, x1 double, y1 double, x2 double, y2 double"))


@query("path_crossings", f"WITH {CROSS} SELECT traj, step, line FROM hits")
def path_crossings(spark, sf_dir):
    """Legs of paths that meet one of three door lines."""
    return T.crossings(steps(spark, sf_dir), _lines(spark)).select("traj", "step", "line")


@query("paths_by_crossings", f"WITH {CROSS} SELECT traj, count(*) AS n, md5(string_agg(CAST(line AS VARCHAR), ',' ORDER BY step, line)) AS lines FROM hits GROUP BY traj")
def paths_by_crossings(spark, sf_dir):
    mid = {round((x1 + x2) / 2, 6): i for i, x1, _, x2, _ in _LINES}
    name = F.lit(None).cast("string")
    p = T.path_by_crossings(steps(spark, sf_dir), _lines(spark))

    def line(v):
        out = name
        for x, i in mid.items():
            out = F.when(F.round(F.get(v, F.lit(0)), 6) == x, str(i)).otherwise(out)
        return out

    return p.select("traj", F.size("path").cast("long").alias("n"), F.md5(F.array_join(F.transform("path", line), ",")).alias("lines"))


@query("crossing_free_paths", f"WITH {CROSS} SELECT DISTINCT traj FROM steps WHERE traj NOT IN (SELECT traj FROM hits)")
def crossing_free_paths(spark, sf_dir):
    s = steps(spark, sf_dir)
    return s.select("traj").distinct().join(T.crossings(s, _lines(spark)), "traj", "left_anti")
