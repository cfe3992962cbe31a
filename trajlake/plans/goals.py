"""Queries on rooms, faces and poses, and on the rules by which goals and paths are chosen."""

from __future__ import annotations

from pyspark.sql import functions as F

from trajlake.functions import geometry as G
from trajlake.operators import goals as O
from trajlake.operators import relations as R
from trajlake.operators import rooms as M
from trajlake.operators import uniqueness as U
from trajlake.plans.catalog import query, table
from trajlake.plans.scene import PAIRS, _MUTUAL, _edges
from trajlake.sources.testbed import OBJECTS, ROOMS, objects, rooms

_MID = "(min_{0} + max_{0}) / 2"
_AREAS = f"""f AS (SELECT *, (max_y - min_y) * (max_z - min_z) AS ax, (max_x - min_x) * (max_z - min_z) AS ay, (max_x - min_x) * (max_y - min_y) AS az,
  {_MID.format('x')} AS mx, {_MID.format('y')} AS my, {_MID.format('z')} AS mz FROM objects)"""


@query(
    "side_faces_yxz",
    f"""WITH {OBJECTS}, {_AREAS}, g AS (SELECT *, ay >= ax OR greatest(ax, ay) < 1e-6 AS across FROM f)
SELECT id, 0 AS face, CASE WHEN across THEN mx ELSE min_x END AS cx, CASE WHEN across THEN min_y ELSE my END AS cy, mz AS cz, CASE WHEN across THEN 0.0::DOUBLE ELSE -1 END AS nx, CASE WHEN across THEN -1.0::DOUBLE ELSE 0 END AS ny FROM g
UNION ALL SELECT id, 1, CASE WHEN across THEN mx ELSE max_x END, CASE WHEN across THEN max_y ELSE my END, mz, CASE WHEN across THEN 0.0::DOUBLE ELSE 1 END, CASE WHEN across THEN 1.0::DOUBLE ELSE 0 END FROM g""",
)
def side_faces_yxz(spark, sf_dir):
    """The opposing upright faces of boxes whose first axis is y."""
    return objects(spark, sf_dir).select("id", F.posexplode(G.side_faces_yxz()).alias("face", "f")).select("id", "face", "f.*")


@query(
    "front_faces",
    f"""WITH {OBJECTS}, {_AREAS}, g AS (SELECT *, CASE WHEN greatest(ax, ay) >= 1e-6 THEN CASE WHEN ax >= ay THEN 'x' ELSE 'y' END WHEN ay >= az AND ay >= ax THEN 'y' WHEN az >= ax THEN 'z' ELSE 'x' END AS a FROM f)
SELECT id, CASE a WHEN 'x' THEN CASE WHEN 8 > min_x THEN min_x ELSE max_x END ELSE mx END AS cx, CASE a WHEN 'y' THEN CASE WHEN 8 > min_y THEN min_y ELSE max_y END ELSE my END AS cy,
  CASE a WHEN 'z' THEN CASE WHEN 1 > min_z THEN min_z ELSE max_z END ELSE mz END AS cz, CASE a WHEN 'x' THEN CASE WHEN 8 > min_x THEN -1.0::DOUBLE ELSE 1 END ELSE 0 END AS nx,
  CASE a WHEN 'y' THEN CASE WHEN 8 > min_y THEN -1.0::DOUBLE ELSE 1 END ELSE 0 END AS ny, CASE a WHEN 'z' THEN CASE WHEN 1 > min_z THEN -1.0::DOUBLE ELSE 1 END ELSE 0 END AS nz FROM g""",
)
def front_faces(spark, sf_dir):
    """One upright face of each object, away from the middle of the scene."""
    return objects(spark, sf_dir).select("id", G.front_face(F.lit(8.0), F.lit(8.0), F.lit(1.0)).alias("f")).select("id", "f.*")


_UNIT = f"""u AS (SELECT id, ({_MID.format('x')} - 8) / n AS wx, ({_MID.format('y')} - 8) / n AS wy, ({_MID.format('z')} - 1.5) / n AS wz
  FROM (SELECT *, sqrt(({_MID.format('x')} - 8) ** 2 + ({_MID.format('y')} - 8) ** 2 + ({_MID.format('z')} - 1.5) ** 2) AS n FROM objects) WHERE n >= 1e-6 AND abs(({_MID.format('x')} - 8) / n) < 1 - 1e-5)"""


@query(
    "rotations",
    f"""WITH {OBJECTS}, {_UNIT} SELECT id, round(wx, 6) + 0 AS m00, round(-wy, 6) + 0 AS m01, round(-wz, 6) + 0 AS m02, round(wy, 6) + 0 AS m10, round(1 - wy * wy / (1 + wx), 6) + 0 AS m11, round(-wy * wz / (1 + wx), 6) + 0 AS m12,
  round(wz, 6) + 0 AS m20, round(-wy * wz / (1 + wx), 6) + 0 AS m21, round(1 - wz * wz / (1 + wx), 6) + 0 AS m22 FROM u
UNION ALL SELECT id, 1, 0, 0, 0, 1, 0, 0, 0, 1 FROM objects o WHERE id NOT IN (SELECT id FROM u) AND {_MID.format('x')} >= 8
UNION ALL SELECT id, -1, 0, 0, 0, -1, 0, 0, 0, 1 FROM objects o WHERE id NOT IN (SELECT id FROM u) AND {_MID.format('x')} < 8""",
)
def rotations(spark, sf_dir):
    """The rotation that turns the first axis towards each object from the middle of the scene."""
    mid = lambda c: (F.col(f"min_{c}") + F.col(f"max_{c}")) / 2
    one = tuple(F.lit(v) for v in (1.0, 0.0, 0.0))
    r = objects(spark, sf_dir).select("id", G.rotation_to(one, tuple(F.lit(v) for v in (8.0, 8.0, 1.5)), (mid("x"), mid("y"), mid("z"))).alias("m"))
    return r.select("id", *((F.round(F.get(F.get("m", F.lit(i)), F.lit(j)), 6) + 0).alias(f"m{i}{j}") for i in range(3) for j in range(3)))


_EULER = "e AS (SELECT event_id, radians(event_id % 90) AS r, radians(event_id % 80) AS p, radians(value % 180) AS y FROM events)"


@query(
    "pose_matrices",
    f"""WITH {_EULER} SELECT event_id, round(cos(y) * cos(p), 6) + 0 AS m00, round(cos(y) * sin(p) * sin(r) - sin(y) * cos(r), 6) + 0 AS m01, round(cos(y) * sin(p) * cos(r) + sin(y) * sin(r), 6) + 0 AS m02,
  round(sin(y) * cos(p), 6) + 0 AS m10, round(-sin(p), 6) + 0 AS m20, round(cos(p) * sin(r), 6) + 0 AS m21, 1.5::DOUBLE AS tx, round(r, 6) AS roll, round(p, 6) AS pitch, round(y, 6) AS yaw FROM e""",
)
def pose_matrices(spark, sf_dir):
    """Angles to quaternion to homogeneous pose and back again."""
    e = table(spark, sf_dir, "events").select("event_id", F.radians(F.col("event_id") % 90).alias("r"), F.radians(F.col("event_id") % 80).alias("p"), F.radians(F.col("value") % 180).alias("y"))
    e = e.withColumn("m", G.pose_matrix(G.euler_quaternion(F.col("r"), F.col("p"), F.col("y")), F.lit(1.5), F.lit(0.0), F.lit(2.0)))
    e = e.withColumn("back", G.matrix_pose(F.col("m"))).withColumn("a", G.quaternion_euler(F.col("back.q")))
    at = lambda i, j: (F.round(F.get(F.get("m", F.lit(i)), F.lit(j)), 6) + 0).alias(f"m{i}{j}")
    return e.select("event_id", *(at(i, j) for i, j in ((0, 0), (0, 1), (0, 2), (1, 0), (2, 0), (2, 1))), F.col("back.x").alias("tx"), *(F.round(f"a.{c}", 6).alias(c) for c in ("roll", "pitch", "yaw")))


@query(
    "world_polygons",
    """SELECT CAST(n_nationkey AS VARCHAR) AS room, md5(string_agg(CAST(CAST(col * 4 + 100 AS INTEGER) AS VARCHAR) || ':' || CAST(CAST(1000 - row * 2 AS INTEGER) AS VARCHAR), ',' ORDER BY pos)) AS polygon
FROM (SELECT n_nationkey, pos, CAST(n_nationkey + (pos % 2) * 3 AS INTEGER) AS row, CAST(n_nationkey * 2 + (pos // 2) * 5 AS INTEGER) AS col FROM nation, range(0, 4) t(pos)) GROUP BY n_nationkey""",
)
def world_polygons(spark, sf_dir):
    """Room corners from pixels by the axes of a raster."""
    k = F.col("n_nationkey")
    r = table(spark, sf_dir, "nation").select(F.lit("s").alias("scene"), k.cast("string").alias("room"), F.explode(F.sequence(F.lit(0), F.lit(3))).alias("pos"), k.alias("k"))
    r = r.select("scene", "room", "pos", (F.col("k") + F.col("pos") % 2 * 3).cast("int").alias("row"), (F.col("k") * 2 + F.floor(F.col("pos") / 2) * 5).cast("int").alias("col"))
    axis = spark.range(100).select(F.lit("s").alias("scene"), F.col("id").cast("int").alias("idx"), F.col("id").cast("double").alias("w"))
    p = M.world_polygons(r, axis.withColumn("w", 10 - F.col("w") / 50), axis.withColumn("w", F.col("w") / 25 + 1))
    text = F.transform("polygon", lambda v: F.concat_ws(":", F.round(v["x"] * 100).cast("int"), F.round(v["y"] * 100).cast("int")))
    return p.select("room", F.md5(F.array_join(text, ",")).alias("polygon"))


_CLOUDS = """pts AS (SELECT vec_id AS id, round(embedding[3 * i + 1]::DOUBLE * 64) / 16 + (vec_id * 5 % 24) AS x, round(embedding[3 * i + 2]::DOUBLE * 64) / 16 + (vec_id * 7 % 24) AS y FROM embeddings, range(0, 21) t(i)),
own AS (SELECT id, count(*) AS n, min(x) AS x1, max(x) AS x2, min(y) AS y1, max(y) AS y2 FROM pts GROUP BY id)"""
_SEG = "sqrt(({0}x - ({1}x1 + t * ({1}x2 - {1}x1))) ** 2 + ({0}y - ({1}y1 + t * ({1}y2 - {1}y1))) ** 2)"


def _near(p: str, e: str) -> str:
    t = f"greatest(least((({p}x - {e}x1) * ({e}x2 - {e}x1) + ({p}y - {e}y1) * ({e}y2 - {e}y1)) / nullif(({e}x2 - {e}x1) ** 2 + ({e}y2 - {e}y1) ** 2, 0), 1), 0)"
    return _SEG.format(p, e).replace(" t ", f" coalesce({t}, 0) ").replace("+ t *", f"+ coalesce({t}, 0) *")


_TURN = "sign(({1}y - {0}y) * ({2}x - {1}x) - ({1}x - {0}x) * ({2}y - {1}y))"


@query(
    "room_by_points",
    f"""WITH {_CLOUDS}, {ROOMS}, inside AS (SELECT id, idx, room, x, y, sum(CASE WHEN (y1 > y) <> (y2 > y) AND x < x1 + (y - y1) * (x2 - x1) / nullif(y2 - y1, 0) THEN 1 ELSE 0 END) % 2 = 1 AS hit, row_number() OVER () AS rn FROM (SELECT *, row_number() OVER () AS pn FROM pts), edges GROUP BY id, idx, room, x, y, pn),
shares AS (SELECT id, idx, room, count(*) AS k FROM inside WHERE hit GROUP BY id, idx, room HAVING count(*) > 1),
best AS (SELECT id, arg_min(room, (-(k / n), idx)) AS room, max(k / n) AS share FROM shares JOIN own USING (id) GROUP BY id HAVING max(k / n) >= 0.1),
rest AS (SELECT * FROM own WHERE id NOT IN (SELECT id FROM best)),
corners AS (SELECT id, CASE WHEN c IN (0, 3) THEN x1 ELSE x2 END AS cx, CASE WHEN c IN (0, 1) THEN y1 ELSE y2 END AS cy, c FROM rest, range(0, 4) t(c)),
sides AS (SELECT a.id, a.cx AS sx1, a.cy AS sy1, b.cx AS sx2, b.cy AS sy2 FROM corners a JOIN corners b ON a.id = b.id AND b.c = (a.c + 1) % 4),
d1 AS (SELECT c.id, e.idx, min({_near('c.c', 'e.')}) AS d FROM corners c, edges e GROUP BY c.id, e.idx),
d2 AS (SELECT s.id, e.idx, min({_near('e.v', 's.s')}) AS d FROM sides s, (SELECT idx, x1 AS vx, y1 AS vy FROM edges) e GROUP BY s.id, e.idx),
meet AS (SELECT DISTINCT s.id, e.idx FROM sides s, (SELECT idx, x1 AS px, y1 AS py, x2 AS qx, y2 AS qy FROM edges) e, (SELECT 1) o
  WHERE sign((qy - py) * (sx1 - qx) - (qx - px) * (sy1 - qy)) <> sign((qy - py) * (sx2 - qx) - (qx - px) * (sy2 - qy)) AND sign((sy2 - sy1) * (px - sx2) - (sx2 - sx1) * (py - sy2)) <> sign((sy2 - sy1) * (qx - sx2) - (sx2 - sx1) * (qy - sy2))
  UNION SELECT r.id, e.idx FROM rest r, edges e WHERE e.x1 BETWEEN r.x1 AND r.x2 AND e.y1 BETWEEN r.y1 AND r.y2
  UNION SELECT id, idx FROM (SELECT r.id, e.idx, sum(CASE WHEN (e.y1 > r.y1) <> (e.y2 > r.y1) AND r.x1 < e.x1 + (r.y1 - e.y1) * (e.x2 - e.x1) / nullif(e.y2 - e.y1, 0) THEN 1 ELSE 0 END) % 2 = 1 AS hit FROM rest r, edges e GROUP BY r.id, e.idx) WHERE hit),
far AS (SELECT d1.id, d1.idx, CASE WHEN m.id IS NOT NULL THEN 0 ELSE least(d1.d, d2.d) END AS d FROM d1 JOIN d2 USING (id, idx) LEFT JOIN meet m ON m.id = d1.id AND m.idx = d1.idx)
SELECT id, room, round(share, 6) AS share FROM best
UNION ALL SELECT f.id, r.room, 0 FROM (SELECT id, arg_min(idx, (round(d, 9), idx)) AS idx FROM far GROUP BY id) f JOIN rooms r USING (idx)""",
)
def room_by_points(spark, sf_dir):
    """The room with the largest share of each cloud's points, or the nearest one."""
    from trajlake.plans.grids import _points

    v = F.col("vec_id")
    p = _points(spark, sf_dir).select(F.lit("s").alias("scene"), v.alias("id"), (F.col("x") * 4 + v * 5 % 24).alias("x"), (F.col("y") * 4 + v * 7 % 24).alias("y"))
    return M.assign_rooms(p, rooms(spark).withColumn("scene", F.lit("s"))).select("id", "room", F.round("share", 6).alias("share"))


_VIEWS = """v AS (SELECT event_id, event_type AS target_room, CASE WHEN event_id % 3 = 0 THEN event_type WHEN event_id % 7 = 0 THEN NULL ELSE 'hall' END AS a_room, CASE WHEN event_id % 2 = 0 THEN event_type ELSE 'bath' END AS b_room,
  value AS a_risk, CAST(user_id AS DOUBLE) AS b_risk FROM events)"""


@query("chosen_views", f"WITH {_VIEWS} SELECT event_id, CASE WHEN a_room IS NOT DISTINCT FROM target_room AND b_room IS NOT DISTINCT FROM target_room THEN CASE WHEN a_risk <= b_risk THEN 'a' ELSE 'b' END WHEN a_room IS NOT DISTINCT FROM target_room THEN 'a' WHEN b_room IS NOT DISTINCT FROM target_room THEN 'b' END AS view FROM v")
def chosen_views(spark, sf_dir):
    """Of two views of a goal, that in its room and with the smaller risk."""
    e, t = F.col("event_id"), F.col("event_type")
    a = F.when(e % 3 == 0, t).when(e % 7 == 0, None).otherwise("hall")
    b = F.when(e % 2 == 0, t).otherwise("bath")
    return table(spark, sf_dir, "events").select("event_id", O.choose_view(a, b, t, F.col("value"), F.col("user_id").cast("double")).alias("view"))


@query(
    "good_ends",
    "SELECT event_id, NOT (sqrt((value % 4 - 2) ** 2 + (event_id % 3 - 1) ** 2) > 1.5 AND sqrt((value % 4 - 1) ** 2 + (event_id % 3) ** 2) > 1.5) AS near, event_type IS NOT DISTINCT FROM CASE WHEN user_id % 2 = 0 THEN 'view' END AS in_room FROM events",
)
def good_ends(spark, sf_dir):
    """Whether paths end near enough, and in the right room."""
    n = lambda v: F.lit(float(v))
    e = table(spark, sf_dir, "events").select("event_id", "event_type", "user_id", (F.col("value") % 4).alias("x"), (F.col("event_id") % 3).cast("double").alias("y"))
    return e.select("event_id", O.ends_well(F.col("x"), F.col("y"), n(2), n(1), n(1), n(0)).alias("near"), O.ends_in_room(F.col("event_type"), F.when(F.col("user_id") % 2 == 0, "view")).alias("in_room"))


@query("start_orders", "SELECT goal, start, row_number() OVER (PARTITION BY goal ORDER BY md5('1025|' || goal || '|' || start), start) - 1 AS \"order\" FROM (SELECT n_nationkey AS goal, s_suppkey AS start FROM nation, supplier)")
def start_orders(spark, sf_dir):
    """Every goal's own order of the starts."""
    one = F.lit("s").alias("scene")
    return O.start_order(table(spark, sf_dir, "nation").select(one, F.col("n_nationkey").alias("goal")), table(spark, sf_dir, "supplier").select(one, F.col("s_suppkey").alias("start"))).select("goal", "start", "order")


@query(
    "door_lines",
    "SELECT k FROM (SELECT p_partkey AS k, CASE WHEN p_partkey % 3 = 0 THEN 'doorsill_' ELSE 'door_' END || p_partkey AS id, p_partkey * 7 % 60 AS dr, p_partkey * 11 % 60 AS dc FROM part) WHERE contains(id, 'doorsill_') AND sqrt(dr * dr + dc * dc) < 50",
)
def door_lines(spark, sf_dir):
    k = F.col("p_partkey")
    d = table(spark, sf_dir, "part").select(k.alias("k"), F.concat(F.when(k % 3 == 0, "doorsill_").otherwise("door_"), k.cast("string")).alias("id"), F.lit(5).alias("r0"), F.lit(9).alias("c0"), (k * 7 % 60 + 5).alias("r1"), (k * 11 % 60 + 9).alias("c1"))
    return O.door_lines(d).select("k")


_KIND = "regexp_extract(split_part({0}, '/', 1), '^(.*?)(_[0-9]+)*$', 1)"


@query(
    "goal_sentences",
    f"""WITH {_MUTUAL.format('NOT ', '~none~')} WHERE n = 1""".replace(
        "SELECT scene, object_1_id, object_1_relation_to_2, object_2_id, object_2_relation_to_1, kind FROM joined WHERE n = 1",
        f"""SELECT row_number() OVER (PARTITION BY scene ORDER BY CASE kind WHEN 'relational' THEN 0 ELSE 1 END, object_2_id, object_1_id) AS place, kind,
  'In the ' || scene || ', find the ' || object_1_id || ' that is ' || object_1_relation_to_2 || ' the ' || object_2_id AS sentence FROM joined WHERE n = 1""",
    ),
)
def goal_sentences(spark, sf_dir):
    """All goals in order, relational ones first, each as a sentence."""
    g = O.in_order(U.mutual_goals(_edges(spark, sf_dir)))
    return g.select("place", "kind", O.sentence(F.col("scene"), F.col("object_1_id"), F.col("object_1_relation_to_2"), F.col("object_2_id")).alias("sentence"))


@query("cross_type_goals", f"WITH {_MUTUAL.format('NOT ', '~none~')} WHERE n = 1".replace("SELECT scene, object_1_id, object_1_relation_to_2, object_2_id, object_2_relation_to_1, kind FROM joined WHERE n = 1", f"SELECT object_1_id, object_2_id FROM joined WHERE n = 1 AND {_KIND.format('object_1_id')} <> {_KIND.format('object_2_id')}"))
def cross_type_goals(spark, sf_dir):
    """Goals whose target and reference are of different types."""
    return U.mutual_goals(_edges(spark, sf_dir)).where(O.different_types(F.col("object_1_id"), F.col("object_2_id"))).select("object_1_id", "object_2_id")


@query("task_batch", "SELECT p_partkey FROM part ORDER BY p_partkey LIMIT 25 OFFSET 50")
def task_batch(spark, sf_dir):
    """The third batch of 25 tasks (the limit is the feature)."""
    return O.batch(table(spark, sf_dir, "part").select("p_partkey"), "p_partkey", 25, 50)


@query("kept_scopes", f"WITH {OBJECTS} SELECT id FROM objects WHERE scope NOT IN ('STANDARD_scope', 'Base')")
def kept_scopes(spark, sf_dir):
    """Objects outside of the scopes that a run leaves out."""
    from trajlake.config import Run

    run = Run("in", "out", excluded_scopes=("STANDARD_scope", "Base"))
    return run.without_excluded(objects(spark, sf_dir), "scope").select("id")


_EDGE_TEXT = """c AS (SELECT *, count(*) OVER (PARTITION BY src, rel) AS n_rel, count(*) OVER (PARTITION BY src, rel, dst_category) AS n_cat FROM edges)"""


@query(
    "category_sentences",
    f"""WITH {PAIRS}, {_EDGE_TEXT} SELECT DISTINCT dst_category || ' ' || rel || ' ' || src_category || ' relational' AS description FROM c WHERE n_rel = 1
UNION SELECT DISTINCT dst_category || ' ' || rel || ' ' || src_category || ' semantic' FROM c WHERE n_cat = 1""",
)
def category_sentences(spark, sf_dir):
    """One-way unique pairs as distinct descriptions by category; both kinds, where both hold."""
    return U.one_way_descriptions(_edges(spark, sf_dir, group=F.col("category")))


@query(
    "type_goals",
    f"""WITH {_MUTUAL.format('NOT ', '~none~')} WHERE n = 1""".replace(
        "SELECT scene, object_1_id, object_1_relation_to_2, object_2_id, object_2_relation_to_1, kind FROM joined WHERE n = 1",
        f"""SELECT DISTINCT least(t1 || ' ' || r1 || ' ' || t2 || ' ' || r2, t2 || ' ' || r2 || ' ' || t1 || ' ' || r1) AS description FROM (SELECT {_KIND.format('object_1_id')} AS t1, {_KIND.format('object_2_id')} AS t2,
  object_1_relation_to_2 AS r1, object_2_relation_to_1 AS r2 FROM joined WHERE n = 1) WHERE t1 NOT IN ('misty_anvil', 'hot_bolt') AND t2 NOT IN ('misty_anvil', 'hot_bolt')""",
    ),
)
def type_goals(spark, sf_dir):
    """Mutually unique pairs as descriptions by exact type, without some types; a pair and its reverse are one."""
    return U.type_descriptions(U.mutual_goals(_edges(spark, sf_dir)), ["misty_anvil", "hot_bolt"])


# Each object as 27 points: the corners and middles of its box.
_LATTICE = """pts AS (SELECT id, min_x + (max_x - min_x) * i / 2 AS x, min_y + (max_y - min_y) * j / 2 AS y, min_z + (max_z - min_z) * k / 2 AS z FROM objects, range(0, 3) a(i), range(0, 3) b(j), range(0, 3) c(k))"""


@query(
    "cloud_relations",
    "WITH "
    + PAIRS.replace("measured AS (", f"""{_LATTICE},
met AS (SELECT p.a, p.b, sqrt(min((s.x - t.x) ** 2 + (s.y - t.y) ** 2 + (s.z - t.z) ** 2)) AS dist FROM paired p JOIN pts s ON s.id = p.a JOIN pts t ON t.id = p.b WHERE p.dist <= 0.5 GROUP BY p.a, p.b),
hulls AS (SELECT m.a, m.b, avg(CASE WHEN s.x BETWEEN o.min_x AND o.max_x AND s.y BETWEEN o.min_y AND o.max_y AND s.z BETWEEN o.min_z AND o.max_z THEN 1.0 ELSE 0.0 END) AS share
  FROM (SELECT a, b FROM met UNION ALL SELECT b, a FROM met) m JOIN pts s ON s.id = m.a JOIN objects o ON o.id = m.b GROUP BY m.a, m.b),
clouds AS (SELECT p.* EXCLUDE (dist), m.dist, h.share AS share_a, g.share AS share_b FROM paired p JOIN met m ON p.a = m.a AND p.b = m.b JOIN hulls h ON h.a = p.a AND h.b = p.b JOIN hulls g ON g.a = p.b AND g.b = p.a),
measured AS (""").replace("ox * oy * oz / (area_a * ha) AS in_a, ox * oy * oz / (area_b * hb) AS in_b", "share_a AS in_a, share_b AS in_b").replace("FROM paired WHERE dist <= 0.5)", "FROM clouds WHERE dist <= 0.5)")
    + " SELECT room, a, b, round(dist, 6) AS dist, rel_a, rel_b FROM pairs WHERE rel_a <> ''",
)
def cloud_relations(spark, sf_dir):
    """Relations decided on clouds and their hulls."""
    o = objects(spark, sf_dir)
    third = F.array(F.lit(0.0), F.lit(0.5), F.lit(1.0))
    p = o
    for x in "xyz":
        p = p.withColumn("t", F.explode(third)).withColumn(x, F.col(f"min_{x}") + (F.col(f"max_{x}") - F.col(f"min_{x}")) * F.col("t"))
    r = R.cloud_relations(o, p.select("id", "x", "y", "z"), digits=6)
    return r.where("rel_a is not null").select("room", "a", "b", "dist", "rel_a", "rel_b")


_TREE = """parts AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 11 = 0 THEN 'Base' ELSE 'room' || p_partkey % 5 END AS scope, split_part(p_name, ' ', 2) AS category, 'i' || p_partkey AS instance,
  CASE WHEN p_partkey % 13 = 0 THEN 'SM_Dummy' ELSE 'mesh' END AS leaf FROM part),
verts AS (SELECT k, scope, category, instance, CAST(i AS DOUBLE) AS x, CAST((k * i) % 7 AS DOUBLE) AS y, CAST(k % 5 AS DOUBLE) AS z FROM parts, range(0, 4) t(i) WHERE scope <> 'Base' AND leaf <> 'SM_Dummy'),
world AS (SELECT k, scope, category, instance, -(2 * y + k % 8) + 1 AS x, 2 * x + 3 AS y, 2 * z + 0.5 AS z FROM verts)"""


@query(
    "instance_boxes",
    f"""WITH {_TREE} SELECT scope, category, instance, min(x) AS min_x, min(y) AS min_y, min(z) AS min_z, max(x) AS max_x, max(y) AS max_y, max(z) AS max_z,
  (min(x) + max(x)) / 2 AS pos_x, (min(y) + max(y)) / 2 AS pos_y, (min(z) + max(z)) / 2 AS pos_z FROM world GROUP BY scope, category, instance""",
)
def instance_boxes(spark, sf_dir):
    """Boxes of the instances of a scene tree: scopes turned a quarter and moved, instances scaled and moved, some scopes and meshes left out."""
    from trajlake.operators import meshes as W

    k = F.col("p_partkey")
    scope = F.when(k % 11 == 0, "Base").otherwise(F.concat(F.lit("room"), (k % 5).cast("string")))
    mat = lambda *rows: F.array(*(F.array(*(F.lit(v).cast("double") if not hasattr(v, "cast") else v.cast("double") for v in r)) for r in rows))
    p = table(spark, sf_dir, "part").select(k.alias("k"), scope.alias("scope"), F.split_part("p_name", F.lit(" "), F.lit(2)).alias("category"), F.concat(F.lit("i"), k.cast("string")).alias("instance"), F.when(k % 13 == 0, "SM_Dummy").otherwise("mesh").alias("leaf"))
    turned = mat((0, -1, 0, 1), (1, 0, 0, 3), (0, 0, 1, 0.5), (0, 0, 0, 1))
    moved = mat((2, 0, 0, 0), (0, 2, 0, F.col("k") % 8), (0, 0, 2, 0), (0, 0, 0, 1))
    path = lambda *c: F.concat(*(x for n in c for x in (F.lit("/"), F.col(n))))
    none = F.lit(None).cast("array<struct<x:double,y:double,z:double>>")
    verts = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.struct(i.cast("double").alias("x"), ((F.col("k") * i) % 7).cast("double").alias("y"), (F.col("k") % 5).cast("double").alias("z")))
    scopes = p.select(F.lit("s").alias("scene"), path("scope").alias("path")).distinct().select("scene", "path", turned.alias("matrix"), none.alias("vertices"))
    instances = p.select(F.lit("s").alias("scene"), path("scope", "category", "instance").alias("path"), moved.alias("matrix"), none.alias("vertices"))
    leaves = p.select(F.lit("s").alias("scene"), path("scope", "category", "instance", "leaf").alias("path"), F.lit(None).cast("array<array<double>>").alias("matrix"), verts.alias("vertices"))
    return W.instance_boxes(W.world_meshes(scopes.unionByName(instances).unionByName(leaves))).drop("scene")
