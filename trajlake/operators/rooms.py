"""Rooms: polygons from pixels, and the room of each object by its points."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trajlake.functions import geometry as G

#: Least share of an object's points that must lie in a room.
LEAST_SHARE = 0.1


def world_polygons(regions: DataFrame, axis_rows: DataFrame, axis_cols: DataFrame) -> DataFrame:
    """scene, room, polygon (vertices x, y in order) from pixel vertices (scene, room, pos, row, col) and axis tables (scene, idx, w).

    A pixel's row looks up y and its column x. A vertex outside of the axes is left out.
    """
    y = axis_rows.select("scene", F.col("idx").alias("row"), F.col("w").alias("y"))
    x = axis_cols.select("scene", F.col("idx").alias("col"), F.col("w").alias("x"))
    at = regions.join(y, ["scene", "row"]).join(x, ["scene", "col"])
    g = at.groupBy("scene", "room").agg(F.array_sort(F.collect_list(F.struct("pos", "x", "y"))).alias("p"))
    return g.select("scene", "room", F.transform("p", lambda v: F.struct(v["x"].alias("x"), v["y"].alias("y"))).alias("polygon"))


def assign_rooms(points: DataFrame, rooms: DataFrame, cell: float = 4.0, least: float = LEAST_SHARE) -> DataFrame:
    """scene, id, room, share: the room (scene, idx, room, polygon) that holds the largest share of an object's points (scene, id, x, y); ties to the smaller idx.

    A room with a single point counts none. If no room holds ``least`` of the points, the nearest room takes the object: the distance of the
    object's box to the polygon, 0 if they meet; ties to the smaller idx. Points meet rooms by an equi-join on ground cells, so
    work follows the rooms near a point; only objects without a room are held against all rooms of their scene.
    """
    xs, ys = F.transform("polygon", lambda v: v["x"]), F.transform("polygon", lambda v: v["y"])
    span = lambda v: F.sequence(F.floor(F.array_min(v) / cell), F.floor(F.array_max(v) / cell))
    r = rooms.withColumn("cx", F.explode(span(xs))).withColumn("cy", F.explode(span(ys)))
    p = points.select("scene", "id", "x", "y", F.floor(F.col("x") / cell).alias("cx"), F.floor(F.col("y") / cell).alias("cy"))
    inside = p.join(r, ["scene", "cx", "cy"]).where(G.in_polygon(F.col("x"), F.col("y"), F.col("polygon")))
    hit = inside.groupBy("scene", "id", "idx", "room").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    own = points.groupBy("scene", "id").agg(F.count(F.lit(1)).alias("all"), *(f(c).alias(f"{n}_{c}") for c in "xy" for n, f in (("min", F.min), ("max", F.max))))
    best = hit.join(own, ["scene", "id"]).withColumn("share", F.col("n") / F.col("all"))
    best = best.groupBy("scene", "id").agg(F.min(F.struct((-F.col("share")).alias("s"), "idx", "room")).alias("b")).where(F.col("b.s") <= -least)
    found = best.select("scene", "id", "b.room", (-F.col("b.s")).alias("share"))
    left = own.join(found, ["scene", "id"], "left_anti")
    near = left.join(rooms, "scene").withColumn("d", _box_polygon_distance())
    nearest = near.groupBy("scene", "id").agg(F.min(F.struct("d", "idx", "room")).alias("b")).select("scene", "id", "b.room", F.lit(0.0).alias("share"))
    return found.unionByName(nearest)


def _box_polygon_distance():
    """The distance of a box (min_x .. max_y) to a polygon: 0 where they meet, else the least of corners to edges and vertices to sides."""
    c = F.col
    corners = F.array(*(F.struct(x.alias("x"), y.alias("y")) for x, y in ((c("min_x"), c("min_y")), (c("max_x"), c("min_y")), (c("max_x"), c("max_y")), (c("min_x"), c("max_y")))))
    edges = lambda ring: F.transform(ring, lambda p, i: F.struct(p.alias("p"), F.get(ring, (i + 1) % F.size(ring)).alias("q")))
    reach = lambda ring, points: F.array_min(F.transform(edges(ring), lambda e: F.array_min(F.transform(points, lambda v: G.segment_distance(v["x"], v["y"], e["p"]["x"], e["p"]["y"], e["q"]["x"], e["q"]["y"])))))
    cross = F.exists(edges(c("polygon")), lambda e: F.exists(edges(corners), lambda s: G.segments_intersect((e["p"]["x"], e["p"]["y"], e["q"]["x"], e["q"]["y"]), (s["p"]["x"], s["p"]["y"], s["q"]["x"], s["q"]["y"]))))
    within = G.in_polygon(c("min_x"), c("min_y"), c("polygon"))
    around = F.exists("polygon", lambda v: v["x"].between(c("min_x"), c("max_x")) & v["y"].between(c("min_y"), c("max_y")))
    return F.when(cross | within | around, 0.0).otherwise(F.least(reach(c("polygon"), corners), reach(corners, c("polygon"))))


def room_of_pixel(places: DataFrame, rooms: DataFrame, keys: list[str], x: str = "x", y: str = "y") -> DataFrame:
    """The places with room: that with the smallest idx of their scene whose polygon holds them, else null. Rooms of one scene meet its places by the scene."""
    hit = places.join(rooms, "scene", "left").withColumn("__in", G.in_polygon(F.col(x), F.col(y), F.col("polygon")))
    got = hit.groupBy("scene", *keys).agg(F.min(F.when(F.col("__in"), F.struct("idx", "room"))).alias("b"))
    return places.join(got.select("scene", *keys, F.col("b.room").alias("room")), ["scene", *keys], "left")
