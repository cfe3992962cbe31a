"""Queries on rasters, rooms and clouds."""

from __future__ import annotations

from pyspark.sql import functions as F

from trajlake.operators import meshes as M
from trajlake.operators import raster as R
from trajlake.operators import sampling as S
from trajlake.plans.catalog import query, table
from trajlake.sources.testbed import CELLS, OBJECTS, cells, objects


def _values(pairs) -> str:
    return "(VALUES " + ", ".join(f"({a}, {b})" for a, b in pairs) + ")"


_K4 = _values(R.kernel(4))


@query("binarise", "SELECT CAST(event_id AS INTEGER) // 100 AS row, CAST(event_id AS INTEGER) % 100 AS col, event_id % 3 = 1 AS free FROM events")
def binarise(spark, sf_dir):
    e = F.col("event_id").cast("int")
    return R.binarise(table(spark, sf_dir, "events").select(F.floor(e / 100).cast("int").alias("row"), (e % 100).alias("col"), (e % 3).alias("value")))


@query(
    "dilate",
    f"""WITH {CELLS}, one AS (SELECT DISTINCT row + dr AS row, col + dc AS col FROM cells, {_K4} k(dr, dc) WHERE NOT free),
two AS (SELECT DISTINCT o.row + dr AS row, o.col + dc AS col FROM one o JOIN cells USING (row, col), {_K4} k(dr, dc))
SELECT row, col, free AND (row, col) NOT IN (SELECT (row, col) FROM one) AND (row, col) NOT IN (SELECT (row, col) FROM two) AS free FROM cells""",
)
def dilate(spark, sf_dir):
    """Obstacles spread twice by a kernel of four."""
    return R.dilate(cells(spark), 4, 2)


_RING = _values([(r, c) for r in range(-6, 7) for c in range(-6, 7) if r * r + c * c <= 36])
_DIST = f"""dists AS (SELECT c.row, c.col, min(sqrt((c.row - o.row) ** 2 + (c.col - o.col) ** 2)) AS dist FROM cells c LEFT JOIN (SELECT row, col FROM cells WHERE NOT free) o
  ON abs(c.row - o.row) <= 6 AND abs(c.col - o.col) <= 6 AND (c.row - o.row) ** 2 + (c.col - o.col) ** 2 <= 36 WHERE c.free GROUP BY c.row, c.col)"""


@query("clearance", f"WITH {CELLS}, {_DIST} SELECT row, col, round(dist, 6) AS dist FROM dists")
def clearance(spark, sf_dir):
    return R.clearance(cells(spark), 6).select("row", "col", F.round("dist", 6).alias("dist"))


_PLACES = "places AS (SELECT event_id, CAST(event_id * 7 % 66 AS INTEGER) AS row, CAST(event_id * 11 % 67 AS INTEGER) AS col FROM events)"


def _places(spark, sf_dir):
    e = F.col("event_id")
    return table(spark, sf_dir, "events").select("event_id", (e * 7 % 66).cast("int").alias("row"), (e * 11 % 67).cast("int").alias("col"))


@query("footprint_clear", f"WITH {CELLS}, {_PLACES} SELECT event_id, bool_and(coalesce(free, false)) AS clear FROM places p, {_values(R.FOOTPRINT)} k(dr, dc) LEFT JOIN cells c ON c.row = p.row + dr AND c.col = p.col + dc GROUP BY event_id")
def footprint_clear(spark, sf_dir):
    return R.footprint_free(_places(spark, sf_dir), cells(spark), ["event_id"])


@query(
    "nearest_free",
    f"""WITH {CELLS}, {_PLACES}, c AS (SELECT p.event_id, c.row, c.col, greatest(abs(c.row - p.row), abs(c.col - p.col)) AS d FROM places p JOIN cells c ON c.free WHERE p.row < 64 AND p.col < 64),
r AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY d, row, col) AS n FROM c) SELECT event_id, row, col, d FROM r WHERE n = 1""",
)
def nearest_free(spark, sf_dir):
    return R.nearest_free(_places(spark, sf_dir), cells(spark), "event_id")


_WIDE = """wide AS (SELECT scene, CAST(i // 64 AS INTEGER) AS row, CAST(i % 64 AS INTEGER) AS col, NOT ((i // 64) % (scene + 20) = 4 OR (i % 64) % (scene + 24) = scene) AS free FROM range(4096) t(i), range(3) s(scene)),
spots AS (SELECT event_id, event_id % 3 AS scene, CAST(event_id * 7 % 64 AS INTEGER) AS row, CAST(event_id * 11 % 64 AS INTEGER) AS col FROM events)"""


def _wide(spark):
    """Three scenes of 64 x 64 cells, each with walls of its own."""
    c = cells(spark).select("row", "col").join(F.broadcast(spark.range(3).select(F.col("id").alias("scene"))))
    return c.withColumn("free", ~((F.col("row") % (F.col("scene") + 20) == 4) | (F.col("col") % (F.col("scene") + 24) == F.col("scene"))))


def _spots(spark, sf_dir):
    e = F.col("event_id")
    return table(spark, sf_dir, "events").select("event_id", (e % 3).alias("scene"), (e * 7 % 64).cast("int").alias("row"), (e * 11 % 64).cast("int").alias("col"))


@query(
    "nearest_clear",
    f"""WITH {_WIDE}, bad AS (SELECT DISTINCT c.scene, c.row, c.col FROM wide c JOIN wide o ON c.scene = o.scene AND NOT o.free AND (c.row - o.row) ** 2 + (c.col - o.col) ** 2 <= 25),
good AS (SELECT * FROM wide WHERE free AND (scene, row, col) NOT IN (SELECT (scene, row, col) FROM bad)), kinds AS (SELECT DISTINCT scene, row, col FROM spots),
r AS (SELECT k.scene, k.row AS r0, k.col AS c0, g.row, g.col, sqrt((g.row - k.row) ** 2 + (g.col - k.col) ** 2) AS d, row_number() OVER (PARTITION BY k.scene, k.row, k.col ORDER BY (g.row - k.row) ** 2 + (g.col - k.col) ** 2, g.row, g.col) AS n FROM kinds k JOIN good g USING (scene))
SELECT s.scene, s.event_id, r.row, r.col, round(r.d, 6) AS d FROM spots s JOIN r ON r.scene = s.scene AND r.r0 = s.row AND r.c0 = s.col AND r.n = 1""",
)
def nearest_clear(spark, sf_dir):
    """The nearest cell of the same scene that is more than five cells from all obstacles."""
    return R.nearest_clear(_spots(spark, sf_dir), _wide(spark), "event_id", 5, ("scene",)).withColumn("d", F.round("d", 6))


@query(
    "sector_cells",
    f"""WITH {_WIDE} SELECT event_id, c.scene, c.row, c.col FROM (SELECT *, CASE event_id % 2 WHEN 0 THEN 1.0::DOUBLE ELSE 0 END AS nx, CASE event_id % 2 WHEN 0 THEN 0.0::DOUBLE ELSE 1 END AS ny FROM spots) f JOIN wide c ON f.scene = c.scene
  AND ((c.col - f.col) * 0.25::DOUBLE) ** 2 + ((c.row - f.row) * 0.25::DOUBLE) ** 2 <= 1.0 AND (c.col - f.col) * 0.25::DOUBLE * nx + (c.row - f.row) * 0.25::DOUBLE * ny >= 0.5 * sqrt(((c.col - f.col) * 0.25::DOUBLE) ** 2 + ((c.row - f.row) * 0.25::DOUBLE) ** 2) AND c.free""",
)
def sector_cells(spark, sf_dir):
    """The free cells that a face looks at, scene by scene."""
    e = F.col("event_id")
    f = _spots(spark, sf_dir).withColumns({"nx": F.when(e % 2 == 0, 1.0).otherwise(0.0), "ny": F.when(e % 2 == 0, 0.0).otherwise(1.0)})
    return R.sector_cells(f, _wide(spark).where("free").select("scene", "row", "col"), "event_id", 1.0, 0.5, 0.25, ("scene",))


@query(
    "scene_dilation",
    f"""WITH {_WIDE}, {_K4.join(['k4 AS (SELECT * FROM ', ' k(dr, dc))'])} SELECT scene, row, col, free AND (scene, row, col) NOT IN (SELECT (scene, row + dr, col + dc) FROM wide, k4 WHERE NOT free) AS free FROM wide""",
)
def scene_dilation(spark, sf_dir):
    """Obstacles of several scenes spread at once."""
    return R.dilate(_wide(spark), 4, 1, ("scene",))


@query(
    "sight_lines",
    f"""WITH {CELLS}, p AS (SELECT event_id, CAST(event_id % 64 AS INTEGER) AS r0, CAST(event_id * 3 % 64 AS INTEGER) AS c0, CAST(event_id * 5 % 64 AS INTEGER) AS r1, CAST(event_id * 7 % 64 AS INTEGER) AS c1 FROM events),
n AS (SELECT *, greatest(abs(r1 - r0), abs(c1 - c0), 1) AS n FROM p),
q AS (SELECT event_id, CAST(floor(r0 + (r1 - r0) * i / n + 0.5) AS INTEGER) AS row, CAST(floor(c0 + (c1 - c0) * i / n + 0.5) AS INTEGER) AS col FROM n, range(0, 64) t(i) WHERE i <= n)
SELECT event_id, bool_and(coalesce(free, false)) AS clear FROM q LEFT JOIN cells USING (row, col) GROUP BY event_id""",
)
def sight_lines(spark, sf_dir):
    """Lines of sight between a pair of cells for each event."""
    e = F.col("event_id")
    p = table(spark, sf_dir, "events").select("event_id", (e % 64).cast("int").alias("r0"), (e * 3 % 64).cast("int").alias("c0"), (e * 5 % 64).cast("int").alias("r1"), (e * 7 % 64).cast("int").alias("c1"))
    return R.sight_lines(p, cells(spark), "event_id")


@query(
    "sector_risk",
    f"""WITH {CELLS}, {_DIST}, f AS (SELECT event_id, row AS r0, col AS c0, CASE event_id % 2 WHEN 0 THEN 1.0::DOUBLE ELSE 0 END AS nx, CASE event_id % 2 WHEN 0 THEN 0.0::DOUBLE ELSE 1 END AS ny
  FROM (SELECT event_id, CAST(event_id * 7 % 66 AS INTEGER) AS row, CAST(event_id * 11 % 67 AS INTEGER) AS col FROM events)),
h AS (SELECT event_id, sum(1 / (dist * dist + 1e-6)) AS risk FROM f JOIN dists ON ((col - c0) * 0.25::DOUBLE) ** 2 + ((row - r0) * 0.25::DOUBLE) ** 2 <= 2.25
  AND (col - c0) * 0.25::DOUBLE * nx + (row - r0) * 0.25::DOUBLE * ny >= 0.5 * sqrt(((col - c0) * 0.25::DOUBLE) ** 2 + ((row - r0) * 0.25::DOUBLE) ** 2) GROUP BY event_id)
SELECT event_id, coalesce(round(risk, 4), -1) AS risk FROM f LEFT JOIN h USING (event_id)""",
)
def sector_risk(spark, sf_dir):
    """Risk before a face for each event; -1 stands for the infinite one."""
    e = F.col("event_id")
    f = _places(spark, sf_dir).withColumns({"nx": F.when(e % 2 == 0, 1.0).otherwise(0.0), "ny": F.when(e % 2 == 0, 0.0).otherwise(1.0)})
    r = R.sector_risk(f, R.clearance(cells(spark), 6).withColumn("dist", F.col("dist")), "event_id", 1.5, 0.5, 0.25)
    return r.select("event_id", F.when(F.col("risk") == float("inf"), -1.0).otherwise(F.round("risk", 4)).alias("risk"))


@query(
    "world_to_pixel",
    f"""WITH {OBJECTS}, a AS (SELECT i AS idx, i * 0.25::DOUBLE AS w FROM range(0, 64) t(i)), d AS (SELECT id, idx, row_number() OVER (PARTITION BY id ORDER BY abs(w - min_x), idx) AS n FROM objects, a)
SELECT id, CAST(idx AS INTEGER) AS idx FROM d WHERE n = 1""",
)
def world_to_pixel(spark, sf_dir):
    axis = spark.range(64).select(F.col("id").cast("int").alias("idx"), (F.col("id") * 0.25).alias("w"))
    return R.nearest_on_axis(objects(spark, sf_dir).select("id", "min_x"), axis, "min_x", "id")


_FREE = "walk AS (SELECT row // 16 AS room, row, col FROM cells WHERE free)"
_DRAWS = f"""{CELLS}, {_FREE}, ranked AS (SELECT *, row_number() OVER (PARTITION BY room ORDER BY row, col) - 1 AS rank FROM walk), sizes AS (SELECT room, count(*) AS size FROM walk GROUP BY room),
draws AS (SELECT room, CAST(i AS INTEGER) AS draw_no, CAST(floor(CAST(('0x' || left(md5('1024|' || room || '|' || i), 8))::BIGINT AS DOUBLE) / 4294967296.0::DOUBLE * size) AS INTEGER) AS rank FROM sizes, range(0, 2000) t(i)),
drawn AS (SELECT room, draw_no, row, col FROM draws JOIN ranked USING (room, rank))"""


def _draws(spark):
    walk = cells(spark).where("free").select(F.floor(F.col("row") / 16).cast("int").alias("room"), "row", "col")
    return S.draws_with_replacement(walk, "room", 2000, "1024", ["row", "col"])


@query("walkable_draws", f"WITH {_DRAWS} SELECT room, draw_no, row, col FROM drawn")
def walkable_draws(spark, sf_dir):
    """Draws with replacement of free cells in each room, 2,000 of them."""
    return _draws(spark)


@query("distinct_draws", f"WITH {_DRAWS} SELECT room, row, col, count(*) AS n FROM drawn GROUP BY room, row, col")
def distinct_draws(spark, sf_dir):
    return _draws(spark).groupBy("room", "row", "col").agg(F.count(F.lit(1)).alias("n"))


@query(
    "room_medoids",
    f"""WITH {_DRAWS}, c AS (SELECT a.room, a.draw_no, a.col AS x, a.row AS y, round(sum(sqrt((a.col - b.col) ** 2 + (a.row - b.row) ** 2)), 6) AS cost FROM drawn a JOIN drawn b USING (room) GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY room ORDER BY cost, draw_no) AS n FROM c) SELECT room, draw_no, x::DOUBLE AS x, y::DOUBLE AS y, cost FROM r WHERE n = 1""",
)
def room_medoids(spark, sf_dir):
    p = _draws(spark).select("room", "draw_no", F.col("col").cast("double").alias("x"), F.col("row").cast("double").alias("y"))
    return S.medoid(p, "room", "draw_no")


_RINGS = """t AS (SELECT id, i, CAST(('0x' || left(md5('1025r|' || id || '|' || i), 8))::BIGINT AS DOUBLE) / 4294967296.0::DOUBLE AS u, CAST(('0x' || left(md5('1025a|' || id || '|' || i), 8))::BIGINT AS DOUBLE) / 4294967296.0::DOUBLE AS v, max_x, (min_y + max_y) / 2 AS my FROM objects, range(0, 1000) r(i)),
p AS (SELECT id, i, max_x + sqrt(0.25 + u * 2.0) * cos((v * 2 - 1) * 0.5) AS x, my + sqrt(0.25 + u * 2.0) * sin((v * 2 - 1) * 0.5) AS y FROM t)"""


@query("ring_points", f"WITH {OBJECTS}, {_RINGS} SELECT id, CAST(arg_min(i, i) FILTER (WHERE x < 15.0) AS INTEGER) AS try_no, round(arg_min(x, i) FILTER (WHERE x < 15.0), 6) AS x, round(arg_min(y, i) FILTER (WHERE x < 15.0), 6) AS y FROM p GROUP BY id HAVING count(*) FILTER (WHERE x < 15.0) > 0")
def ring_points(spark, sf_dir):
    """The first place before each object's face, of 1,000 tries, that is inside."""
    o = objects(spark, sf_dir).select("id", F.col("max_x").alias("cx"), ((F.col("min_y") + F.col("max_y")) / 2).alias("cy"), F.lit(1.0).alias("nx"), F.lit(0.0).alias("ny"))
    p = S.first_ring_points(o, "id", 1000, 0.5, 1.5, 0.5, "1025", F.col("x") < 15.0)
    return p.select("id", "try_no", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


_POINTS = """pts AS (SELECT vec_id, label, i, round(embedding[3 * i + 1]::DOUBLE * 64) / 64 AS x, round(embedding[3 * i + 2]::DOUBLE * 64) / 64 AS y, round(embedding[3 * i + 3]::DOUBLE * 64) / 64 AS z FROM embeddings, range(0, 21) t(i))"""


def _points(spark, sf_dir):
    at = lambda e, k: F.round(F.get(e, k.cast("int")).cast("double") * 64) / 64
    p = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(20).cast("long"))).alias("i"))
    return p.select("vec_id", "label", "i", *(at("embedding", F.col("i") * 3 + k).alias(c) for k, c in enumerate("xyz")))


@query("cloud_boxes", f"WITH {_POINTS} SELECT vec_id, min(x) AS min_x, min(y) AS min_y, min(z) AS min_z, max(x) AS max_x, max(y) AS max_y, max(z) AS max_z, (min(x) + max(x)) / 2 AS pos_x, (min(y) + max(y)) / 2 AS pos_y, (min(z) + max(z)) / 2 AS pos_z FROM pts GROUP BY vec_id")
def cloud_boxes(spark, sf_dir):
    return M.boxes(_points(spark, sf_dir), "vec_id")


@query(
    "cloud_distances",
    f"""WITH {_POINTS}, pairs AS (SELECT DISTINCT a.vec_id AS a, a.vec_id + 1 AS b FROM pts a),
d AS (SELECT p.a, p.b, min((s.x - t.x) ** 2 + (s.y - t.y) ** 2 + (s.z - t.z) ** 2) AS d2 FROM pairs p JOIN pts s ON s.vec_id = p.a JOIN pts t ON t.vec_id = p.b GROUP BY p.a, p.b)
SELECT a, b, round(sqrt(d2), 6) AS dist FROM d WHERE d2 <= 0.25 * 0.25""",
)
def cloud_distances(spark, sf_dir):
    """Least distances of clouds with neighbouring numbers, up to a quarter of a metre."""
    p = _points(spark, sf_dir)
    pairs = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("a"), (F.col("vec_id") + 1).alias("b")).distinct()
    return M.cloud_distances(p, pairs, "vec_id", 0.25).select("a", "b", F.round("dist", 6).alias("dist"))


@query("mesh_transform", f"WITH {_POINTS} SELECT vec_id, i, 0.5 * x - 2.0 * y + 0.25 AS x, 2.0 * x + 0.5 * y - 1.0 AS y, z + 3.0 AS z FROM pts")
def mesh_transform(spark, sf_dir):
    m = [[0.5, -2.0, 0.0, 0.25], [2.0, 0.5, 0.0, -1.0], [0.0, 0.0, 1.0, 3.0], [0.0, 0.0, 0.0, 1.0]]
    return M.transform_points(_points(spark, sf_dir), m).select("vec_id", "i", "x", "y", "z")


@query("fan_triangles", "SELECT vec_id, CAST(i AS INTEGER) AS k, round(embedding[1]::DOUBLE, 6) AS a, round(embedding[i + 1]::DOUBLE, 6) AS b, round(embedding[i + 2]::DOUBLE, 6) AS c FROM embeddings, range(1, 7) t(i)")
def fan_triangles(spark, sf_dir):
    """The fan over the first eight numbers of each vector, as if they were vertices."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode(M.fan_triangles(F.slice("embedding", 1, 8))).alias("k", "t"))
    return e.select("vec_id", (F.col("k") + 1).alias("k"), *(F.round(F.get("t", F.lit(j)).cast("double"), 6).alias(n) for j, n in enumerate("abc")))


@query(
    "surface_samples",
    f"""WITH {_POINTS}, tri AS (SELECT a.vec_id AS mesh, CAST(b.i - 1 AS INTEGER) AS tri, a.x AS ax, a.y AS ay, a.z AS az, b.x AS bx, b.y AS b_y, b.z AS bz, c.x AS cx, c.y AS cy, c.z AS cz FROM pts a JOIN pts b ON a.vec_id = b.vec_id AND a.i = 0 AND b.i BETWEEN 1 AND 19 JOIN pts c ON c.vec_id = b.vec_id AND c.i = b.i + 1),
d AS (SELECT *, bx - ax AS ux, b_y - ay AS uy, bz - az AS uz, cx - ax AS vx, cy - ay AS vy, cz - az AS vz FROM tri),
r AS (SELECT *, sqrt((uy * vz - uz * vy) * (uy * vz - uz * vy) + (uz * vx - ux * vz) * (uz * vx - ux * vz) + (ux * vy - uy * vx) * (ux * vy - uy * vx)) / 2 AS area FROM d),
w AS (SELECT *, sum(area) OVER (PARTITION BY mesh ORDER BY tri ROWS UNBOUNDED PRECEDING) AS "end", sum(area) OVER (PARTITION BY mesh) AS total FROM r),
f AS (SELECT *, CAST(ceil(("end" - area) / total * 7000 - 0.5) AS BIGINT) AS first, CAST(ceil("end" / total * 7000 - 0.5) AS BIGINT) - 1 AS last FROM w WHERE total > 0),
s AS (SELECT *, unnest(range(first, last + 1)) AS i FROM f WHERE last >= first),
t AS (SELECT *, sqrt(CAST(('0x' || left(md5('42u|' || mesh || '|' || i), 8))::BIGINT AS DOUBLE) / 4294967296.0::DOUBLE) AS su, CAST(('0x' || left(md5('42v|' || mesh || '|' || i), 8))::BIGINT AS DOUBLE) / 4294967296.0::DOUBLE AS sv FROM s)
SELECT mesh, tri, i, round((1 - su) * ax + su * (1 - sv) * bx + su * sv * cx, 6) + 0 AS x, round((1 - su) * ay + su * (1 - sv) * b_y + su * sv * cy, 6) + 0 AS y, round((1 - su) * az + su * (1 - sv) * bz + su * sv * cz, 6) + 0 AS z FROM t""",
)
def surface_samples(spark, sf_dir):
    """Points on fans of each vector's points."""
    p = _points(spark, sf_dir)
    t = p.groupBy("vec_id").agg(F.array_sort(F.collect_list(F.struct("i", "x", "y", "z"))).alias("v"))
    t = t.select("vec_id", F.posexplode(M.fan_triangles("v")).alias("tri", "t")).select(F.col("vec_id").alias("mesh"), "tri", *(F.get("t", F.lit(j)).alias(n) for j, n in enumerate("abc")))
    return M.surface_samples(t, "mesh", 7000).select("mesh", "tri", "i", *((F.round(c, 6) + 0).alias(c) for c in "xyz"))
