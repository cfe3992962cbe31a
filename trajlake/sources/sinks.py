"""Sinks: episode tables by scene, JSON documents plain and compressed, array blobs, mesh text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_episodes(rows: DataFrame, path: str, by: str = "scene_id") -> None:
    """Parquet, a folder per scene; one scene's rows go to few files. A scene is split by trajectory where there is one, so no task holds a whole scene."""
    keys = [by, *(["traj"] if "traj" in rows.columns else [])]
    rows.repartition(*keys).write.mode("overwrite").partitionBy(by).parquet(path)


def write_json(docs: DataFrame, path: str, gzip: bool = False) -> None:
    """One JSON document a line."""
    docs.write.mode("overwrite").option("compression", "gzip" if gzip else "none").option("ignoreNullFields", False).json(path)


def manifest(episodes: DataFrame) -> DataFrame:
    """The split manifest's documents: start pose, instruction (a text or three styles), reference path, goal, and ids.

    Takes episode_id, traj, scene, text, styles, start_x, start_y, start_yaw, path (array of places), goal_x, goal_y.
    """
    text = F.coalesce(F.to_json("styles"), F.to_json(F.struct("text")))
    return episodes.select(
        F.array("start_x", "start_y", F.lit(0.0)).alias("start_position"),
        F.array(F.cos(F.col("start_yaw") / 2), F.lit(0.0), F.lit(0.0), F.sin(F.col("start_yaw") / 2)).alias("start_rotation"),
        F.struct(text.alias("instruction_text"), F.array_repeat(F.lit(0), 10).alias("instruction_tokens")).alias("instruction"),
        F.col("path").alias("reference_path"),
        F.struct(F.array("goal_x", "goal_y", F.lit(0.0)).alias("position"), F.lit(3.0).alias("radius")).alias("goals"),
        F.struct(F.lit(-1).alias("geodesic_distance")).alias("info"),
        F.col("scene").alias("scan"),
        "episode_id",
        F.col("traj").alias("trajectory_id"),
        F.concat(F.lit("scene/"), "scene").alias("scene_id"),
    )


def obj_lines(vertices: DataFrame, faces: DataFrame, mesh: str = "mesh") -> DataFrame:
    """mesh, text: vertices (mesh, i, x, y, z) and faces (mesh, j, corners from 0) as OBJ text."""
    v = vertices.groupBy(mesh).agg(F.array_sort(F.collect_list(F.struct("i", F.concat_ws(" ", F.lit("v"), "x", "y", "z").alias("t")))).alias("v"))
    corner = lambda c: F.array_join(F.transform(c, lambda k: (k + 1).cast("string")), " ")
    f = faces.groupBy(mesh).agg(F.array_sort(F.collect_list(F.struct("j", F.concat(F.lit("f "), corner("corners")).alias("t")))).alias("f"))
    lines = lambda c: F.array_join(F.transform(c, lambda s: s["t"]), "\n")
    return v.join(f, mesh, "left").select(mesh, F.concat_ws("\n", lines("v"), lines("f")).alias("text"))


def room_document(objects: DataFrame, rooms: DataFrame, wrapped: bool = False) -> DataFrame:
    """room, ids: all rooms, those without objects too; ``wrapped`` puts each id in a list of its own."""
    one: Column = F.array("id") if wrapped else F.col("id")
    g = objects.groupBy("room").agg(F.array_sort(F.collect_list(one)).alias("ids"))
    return rooms.select("room").distinct().join(g, "room", "left").select("room", F.coalesce("ids", F.array().cast(g.schema["ids"].dataType)).alias("ids"))


def append_errors(quarantine: DataFrame, path: str) -> None:
    """Adds quarantined rows to a log of text lines, one each: all columns by name."""
    line = F.concat_ws("; ", *(F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in quarantine.columns))
    quarantine.select(line.alias("value")).write.mode("append").text(path)
