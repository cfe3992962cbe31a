"""Scene graph queries: relations, indexes, uniqueness."""

from __future__ import annotations

from pyspark.sql import functions as F

from trajlake.functions import geometry as G
from trajlake.operators import relations as R
from trajlake.operators import uniqueness as U
from trajlake.plans.catalog import query
from trajlake.sources.testbed import OBJECTS, ROOMS, objects, rooms

_GAP = "greatest(a.min_{0} - b.max_{0}, b.min_{0} - a.max_{0}, 0)"
PAIRS = OBJECTS + f""",
paired AS (
  SELECT a.scene, a.room, a.id AS a, b.id AS b, a.key AS a_key, b.key AS b_key, a.category AS a_category, b.category AS b_category,
    sqrt({_GAP.format('x')} * {_GAP.format('x')} + {_GAP.format('y')} * {_GAP.format('y')} + {_GAP.format('z')} * {_GAP.format('z')}) AS dist,
    b.min_z - a.max_z AS up, a.min_z - b.max_z AS down, 0.15::DOUBLE * greatest(b.min_z - a.max_z, a.min_z - b.max_z, 0) AS w,
    (a.max_x - a.min_x) * (a.max_y - a.min_y) AS area_a, (b.max_x - b.min_x) * (b.max_y - b.min_y) AS area_b,
    greatest(least(a.max_x, b.max_x) - greatest(a.min_x, b.min_x), 0) AS ox, greatest(least(a.max_y, b.max_y) - greatest(a.min_y, b.min_y), 0) AS oy,
    greatest(least(a.max_z, b.max_z) - greatest(a.min_z, b.min_z), 0) AS oz,
    a.min_x AS ax1, a.max_x AS ax2, a.min_y AS ay1, a.max_y AS ay2, b.min_x AS bx1, b.max_x AS bx2, b.min_y AS by1, b.max_y AS by2,
    a.max_z - a.min_z AS ha, b.max_z - b.min_z AS hb, (a.min_z + a.max_z) / 2 - (b.min_z + b.max_z) / 2 AS centre
  FROM objects a JOIN objects b ON a.room = b.room AND a.key < b.key),
measured AS (
  SELECT *, ox * oy AS inter, ox * oy * oz / (area_a * ha) AS in_a, ox * oy * oz / (area_b * hb) AS in_b,
    (greatest(least(ax2 + w, bx2 + w) - greatest(ax1 - w, bx1 - w), 0) * greatest(least(ay2 + w, by2 + w) - greatest(ay1 - w, by1 - w), 0))
      / least((ax2 - ax1 + 2 * w) * (ay2 - ay1 + 2 * w), (bx2 - bx1 + 2 * w) * (by2 - by1 + 2 * w)) AS wide
  FROM paired WHERE dist <= 0.5),
related AS (
  SELECT *, CASE
    WHEN up > 0.05 AND wide > 0.2 THEN 'below,above'
    WHEN down > 0.05 AND wide > 0.2 THEN 'above,below'
    WHEN inter / (area_a + area_b - inter) < 0.001 THEN 'near,near'
    WHEN dist < 0.06 AND in_a > 0.5 THEN 'in,contain'
    WHEN dist < 0.06 AND in_b > 0.5 THEN 'contain,in'
    WHEN dist < 0.06 AND inter / area_a > 0.3 AND abs(down) <= 0.06 AND area_a / area_b < 1.5 AND centre > 0.01 THEN 'on,below'
    WHEN dist < 0.06 AND inter / area_b > 0.3 AND abs(up) <= 0.06 AND area_b / area_a < 1.5 AND -centre > 0.01 THEN 'below,on' END AS rel
  FROM measured),
pairs AS (SELECT scene, room, a, b, a_category, b_category, dist, split_part(rel, ',', 1) AS rel_a, split_part(rel, ',', 2) AS rel_b FROM related),
edges AS (
  SELECT scene, room, a AS src, b AS dst, rel_b AS rel, dist, a_category AS src_category, b_category AS dst_category FROM pairs WHERE rel_a <> ''
  UNION ALL SELECT scene, room, b, a, rel_a, dist, b_category, a_category FROM pairs WHERE rel_a <> '')"""

UNIQUE = PAIRS + """,
counted AS (
  SELECT *, count(*) OVER (PARTITION BY scene, src, rel) AS n_rel,
    count(*) OVER (PARTITION BY scene, src, rel, split_part(dst_category, '_', 1)) AS n_cat FROM edges),
kinds AS (SELECT *, CASE WHEN n_rel = 1 THEN 'relational' WHEN dst_category IS NOT NULL AND n_cat = 1 THEN 'semantic' END AS kind FROM counted)"""

_MUTUAL = UNIQUE + """,
joined AS (
  SELECT f.scene, f.dst AS object_1_id, f.rel AS object_1_relation_to_2, f.src AS object_2_id, b.rel AS object_2_relation_to_1, f.kind,
    row_number() OVER (PARTITION BY f.scene, least(f.src, f.dst), greatest(f.src, f.dst) ORDER BY md5('1025|' || f.src), f.src, f.dst) AS n
  FROM kinds f JOIN kinds b ON f.scene = b.scene AND f.src = b.dst AND f.dst = b.src
  WHERE f.kind IS NOT NULL AND b.kind IS {0}NULL AND NOT regexp_matches(f.src, '{1}') AND NOT regexp_matches(f.dst, '{1}'))
SELECT scene, object_1_id, object_1_relation_to_2, object_2_id, object_2_relation_to_1, kind FROM joined"""

DENY = ["anvil", "hot_"]


def _edges(spark, sf_dir, **of):
    """The edges that counts by source need (``few_edges``)."""
    return R.few_edges(objects(spark, sf_dir), **of)


@query("scene_relations", f"WITH {PAIRS} SELECT scene, room, a, b, round(dist, 6) AS dist, rel_a, rel_b FROM pairs WHERE rel_a <> ''")
def scene_relations(spark, sf_dir):
    return R.related(objects(spark, sf_dir), digits=6).select("scene", "room", "a", "b", "dist", "rel_a", "rel_b")


@query("close_pairs", f"WITH {PAIRS} SELECT room, a, b, round(dist, 6) AS dist FROM pairs")
def close_pairs(spark, sf_dir):
    p = R.close_pairs(objects(spark, sf_dir).drop("category", "scope"), value=lambda a, b: F.round("dist", 6))
    return p.select(F.col("a_room").alias("room"), F.col("a_id").alias("a"), F.col("b_id").alias("b"), F.col("value").alias("dist"))


@query("relation_edges", f"WITH {PAIRS} SELECT src, dst, rel, src_category, dst_category FROM edges")
def relation_edges(spark, sf_dir):
    return R.all_edges(objects(spark, sf_dir)).select("src", "dst", "rel", "src_category", "dst_category")


@query("nearby_documents", f"WITH {PAIRS} SELECT src, count(*) AS n, min(dst) AS first_dst, string_agg(dst || '=' || rel, ';' ORDER BY dst) AS nearby FROM edges GROUP BY src")
def nearby_documents(spark, sf_dir):
    """The graph as documents: one row per object with its neighbours in order."""
    return R.documents(objects(spark, sf_dir))


@query("unique_edges", f"WITH {UNIQUE} SELECT src, dst, rel, kind FROM kinds WHERE kind IS NOT NULL")
def unique_edges(spark, sf_dir):
    return U.unique_edges(_edges(spark, sf_dir)).where("kind is not null").select("src", "dst", "rel", "kind")


@query("unique_goals", f"WITH {_MUTUAL.format('NOT ', '~none~')} WHERE n = 1")
def unique_goals(spark, sf_dir):
    """Pairs that name each other uniquely in both directions."""
    return U.mutual_goals(_edges(spark, sf_dir))


@query("unique_goals_denylist", f"WITH {_MUTUAL.format('NOT ', 'anvil|hot_')} WHERE n = 1")
def unique_goals_denylist(spark, sf_dir):
    return U.mutual_goals(_edges(spark, sf_dir), DENY, DENY)


@query("one_way_goals", f"WITH {_MUTUAL.format('', '~none~')}")
def one_way_goals(spark, sf_dir):
    """Unique forward but not in reverse."""
    return U.mutual_goals(_edges(spark, sf_dir), both=False)


@query(
    "unique_after_denylist",
    f"""WITH {PAIRS}, few AS (SELECT * FROM edges WHERE NOT regexp_matches(dst, 'anvil')), c AS (
  SELECT *, count(*) OVER (PARTITION BY src, rel) AS n_rel, count(*) OVER (PARTITION BY src, rel, dst_category) AS n_cat FROM few)
SELECT src, dst, rel, CASE WHEN n_rel = 1 THEN 'relational' ELSE 'semantic' END AS kind FROM c WHERE n_rel = 1 OR n_cat = 1""",
)
def unique_after_denylist(spark, sf_dir):
    """The form that leaves denied targets out before it counts."""
    return U.unique_edges(_edges(spark, sf_dir, targets=~U.denied(F.col("id"), ["anvil"]))).where("kind is not null").select("src", "dst", "rel", "kind")


@query("unique_goal_types", f"WITH {_MUTUAL.format('NOT ', '~none~')} WHERE n = 1".replace("SELECT scene, object_1_id, object_1_relation_to_2, object_2_id, object_2_relation_to_1, kind FROM joined WHERE n = 1", "SELECT DISTINCT regexp_replace(object_1_id, '_[0-9]+/m$', '') AS target_type, object_1_relation_to_2 AS rel, regexp_replace(object_2_id, '_[0-9]+/m$', '') AS source_type FROM joined WHERE n = 1"))
def unique_goal_types(spark, sf_dir):
    """Distinct descriptions on the level of types."""
    kind = lambda c: F.regexp_replace(c, "_[0-9]+/m$", "")
    return U.mutual_goals(_edges(spark, sf_dir)).select(kind("object_1_id").alias("target_type"), F.col("object_1_relation_to_2").alias("rel"), kind("object_2_id").alias("source_type")).distinct()


@query(
    "iou_2d",
    f"""WITH {PAIRS} SELECT a, b, round(inter / (area_a + area_b - inter), 6) AS iou, round(inter / area_a, 6) AS ratio_a, round(inter / area_b, 6) AS ratio_b,
  round(area_a / area_b, 6) AS area_ratio_ab FROM measured""",
)
def iou_2d(spark, sf_dir):
    def value(a, b):
        f = G.iou_2d(a, b)
        return F.struct(*(F.round(f[c], 6).alias(c) for c in ("iou", "ratio_a", "ratio_b", "area_ratio_ab")))

    return R.close_pairs(objects(spark, sf_dir).drop("category", "scope"), value=value).select(F.col("a_id").alias("a"), F.col("b_id").alias("b"), "value.*")


@query("room_index", f"WITH {OBJECTS} SELECT room, count(*) AS n, min(id) AS first_id, max(id) AS last_id FROM objects GROUP BY room UNION ALL SELECT 'attic', 0, NULL, NULL")
def room_index(spark, sf_dir):
    """Objects by room; rooms without objects are there too."""
    o = objects(spark, sf_dir)
    known = o.select("room").distinct().union(spark.createDataFrame([("attic",)], "room string"))
    return known.join(o, "room", "left").groupBy("room").agg(F.count("id").alias("n"), F.min("id").alias("first_id"), F.max("id").alias("last_id"))


@query("category_index", f"WITH {OBJECTS} SELECT category, count(*) AS n, md5(string_agg(id, ',' ORDER BY id)) AS ids FROM objects GROUP BY category")
def category_index(spark, sf_dir):
    return objects(spark, sf_dir).groupBy("category").agg(F.count(F.lit(1)).alias("n"), F.md5(F.array_join(F.array_sort(F.collect_list("id")), ",")).alias("ids"))


_CROSS = "sum(CASE WHEN (y1 > py) <> (y2 > py) AND px < x1 + (py - y1) * (x2 - x1) / nullif(y2 - y1, 0) THEN 1 ELSE 0 END) % 2 = 1"


@query(
    "object_rooms",
    f"""WITH {OBJECTS}, {ROOMS}, pts AS (SELECT id, (min_x + max_x) / 2 AS px, (min_y + max_y) / 2 AS py FROM objects),
inside AS (SELECT id, room, idx, {_CROSS} AS hit FROM pts, edges GROUP BY id, room, idx)
SELECT p.id, coalesce(min(idx) FILTER (WHERE hit), -1) AS room_idx FROM pts p JOIN inside USING (id) GROUP BY p.id""",
)
def object_rooms(spark, sf_dir):
    """The first room polygon that holds an object's centre, or -1. Rooms are a small fixed list of polygons."""
    r = F.broadcast(rooms(spark).agg(F.array_sort(F.collect_list(F.struct("idx", "polygon"))).alias("rooms")))
    o = objects(spark, sf_dir).select("id", ((F.col("min_x") + F.col("max_x")) / 2).alias("px"), ((F.col("min_y") + F.col("max_y")) / 2).alias("py"))
    hit = F.filter("rooms", lambda r: G.in_polygon(F.col("px"), F.col("py"), r["polygon"]))
    return o.join(r, how="cross").select("id", F.coalesce(F.get(hit, F.lit(0))["idx"], F.lit(-1)).alias("room_idx"))


@query(
    "side_faces",
    f"""WITH {OBJECTS}, f AS (SELECT *, (max_y - min_y) * (max_z - min_z) AS fx, (max_x - min_x) * (max_z - min_z) AS fy, (min_x + max_x) / 2 AS mx, (min_y + max_y) / 2 AS my, (min_z + max_z) / 2 AS mz FROM objects)
SELECT id, max_x AS cx, my AS cy, mz AS cz, 1.0::DOUBLE AS nx, 0.0::DOUBLE AS ny FROM f WHERE fx >= fy OR greatest(fx, fy) < 1e-6
UNION ALL SELECT id, min_x, my, mz, -1.0::DOUBLE, 0.0::DOUBLE FROM f WHERE fx >= fy OR greatest(fx, fy) < 1e-6
UNION ALL SELECT id, mx, max_y, mz, 0.0::DOUBLE, 1.0::DOUBLE FROM f WHERE NOT (fx >= fy OR greatest(fx, fy) < 1e-6)
UNION ALL SELECT id, mx, min_y, mz, 0.0::DOUBLE, -1.0::DOUBLE FROM f WHERE NOT (fx >= fy OR greatest(fx, fy) < 1e-6)""",
)
def side_faces(spark, sf_dir):
    return objects(spark, sf_dir).select("id", F.explode(G.side_faces()).alias("f")).select("id", "f.*")
