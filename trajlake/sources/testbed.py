"""Domain views over the generic test tables. Coordinates are multiples of powers of two, so both engines get the same doubles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trajlake.plans.catalog import table


def objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes from part: scene, room, id, category, scope, key, min_x .. max_z."""
    k, size = F.col("p_partkey"), F.col("p_size")
    at = lambda m, n, d: ((k * m) % n).cast("double") / d
    key = F.when(k < 10000, F.lpad(k.cast("string"), 4, "0")).otherwise(k.cast("string"))
    return table(spark, sf_dir, "part").select(
        F.lit("scene").alias("scene"),
        F.col("p_type").alias("room"),
        F.concat(F.replace("p_name", F.lit(" "), F.lit("_")), F.lit("_"), key, F.lit("/m")).alias("id"),
        F.split_part("p_name", F.lit(" "), F.lit(2)).alias("category"),
        F.concat("p_type", F.lit("_scope")).alias("scope"),
        k.alias("key"),
        at(37, 512, 32).alias("min_x"),
        at(91, 512, 32).alias("min_y"),
        ((size % 4).cast("double") / 2).alias("min_z"),
        (at(37, 512, 32) + 0.25 + at(7, 16, 16)).alias("max_x"),
        (at(91, 512, 32) + 0.25 + at(11, 16, 16)).alias("max_y"),
        ((size % 4).cast("double") / 2 + 0.25 + at(5, 8, 16)).alias("max_z"),
    )


OBJECTS = """objects AS (
  SELECT 'scene' AS scene, p_type AS room, p_partkey AS key, split_part(p_name, ' ', 2) AS category, p_type || '_scope' AS scope,
    replace(p_name, ' ', '_') || '_' || CASE WHEN p_partkey < 10000 THEN lpad(CAST(p_partkey AS VARCHAR), 4, '0') ELSE CAST(p_partkey AS VARCHAR) END || '/m' AS id,
    CAST((37 * p_partkey) % 512 AS DOUBLE) / 32 AS min_x, CAST((91 * p_partkey) % 512 AS DOUBLE) / 32 AS min_y, CAST(p_size % 4 AS DOUBLE) / 2 AS min_z,
    CAST((37 * p_partkey) % 512 AS DOUBLE) / 32 + 0.25 + CAST((7 * p_partkey) % 16 AS DOUBLE) / 16 AS max_x,
    CAST((91 * p_partkey) % 512 AS DOUBLE) / 32 + 0.25 + CAST((11 * p_partkey) % 16 AS DOUBLE) / 16 AS max_y,
    CAST(p_size % 4 AS DOUBLE) / 2 + 0.25 + CAST((5 * p_partkey) % 8 AS DOUBLE) / 16 AS max_z
  FROM part)"""


def steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trajectories from events: traj, step (from 0), action (0 stop at the last step, 1 forward, 2 left, 3 right), x, y (dead reckoning on a lattice)."""
    w = Window.partitionBy("traj").orderBy("ts", "event_id")
    kind = F.when(F.col("event_type") == "view", 2).when(F.col("event_type") == "error", 3).otherwise(1)
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("traj"), "ts", "event_id", kind.alias("kind"), F.col("event_id").alias("eid"))
    e = e.select("traj", (F.row_number().over(w) - 1).cast("long").alias("step"), "kind", "eid", F.lead("eid").over(w).isNull().alias("last"), "ts", "event_id")
    # A forward step moves by a quarter in a direction that the event's number gives; a turn stays where it is.
    prev_kind, prev_id = F.lag("kind").over(w), F.lag("eid").over(w)
    moved = F.coalesce(prev_kind == 1, F.lit(False))
    dx = F.when(moved, (prev_id % 3 - 1).cast("double") / 4).otherwise(0.0)
    dy = F.when(moved, (F.floor(prev_id / 3) % 3 - 1).cast("double") / 4).otherwise(0.0)
    e = e.select("traj", "step", F.when(F.col("last"), 0).otherwise(F.col("kind")).alias("action"), dx.alias("dx"), dy.alias("dy"))
    run = Window.partitionBy("traj").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    return e.select("traj", "step", "action", F.sum("dx").over(run).alias("x"), F.sum("dy").over(run).alias("y"))


STEPS = """ev AS (
  SELECT user_id AS traj, event_id AS eid, row_number() OVER w - 1 AS step, lead(event_id) OVER w IS NULL AS last,
    CASE event_type WHEN 'view' THEN 2 WHEN 'error' THEN 3 ELSE 1 END AS kind
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
moves AS (
  SELECT traj, step, CASE WHEN last THEN 0 ELSE kind END AS action,
    CASE WHEN lag(kind) OVER w = 1 THEN CAST(lag(eid) OVER w % 3 - 1 AS DOUBLE) / 4 ELSE 0.0::DOUBLE END AS dx,
    CASE WHEN lag(kind) OVER w = 1 THEN CAST((lag(eid) OVER w // 3) % 3 - 1 AS DOUBLE) / 4 ELSE 0.0::DOUBLE END AS dy
  FROM ev WINDOW w AS (PARTITION BY traj ORDER BY step)),
steps AS (
  SELECT traj, step, action, sum(dx) OVER w AS x, sum(dy) OVER w AS y
  FROM moves WINDOW w AS (PARTITION BY traj ORDER BY step ROWS UNBOUNDED PRECEDING))"""


def cells(spark: SparkSession, size: int = 64) -> DataFrame:
    """A raster of size x size cells: row, col, free (by a modular rule, with whole walls left open in places)."""
    n = spark.range(size * size).select((F.col("id") / size).cast("int").alias("row"), (F.col("id") % size).cast("int").alias("col"))
    wall = ((F.col("row") % 9 == 4) & (F.col("col") % 16 != 7)) | ((F.col("row") * 7 + F.col("col") * 13) % 41 == 0)
    return n.withColumn("free", ~wall)


CELLS = """cells AS (
  SELECT CAST(i // 64 AS INTEGER) AS row, CAST(i % 64 AS INTEGER) AS col,
    NOT (((i // 64) % 9 = 4 AND (i % 64) % 16 <> 7) OR ((i // 64) * 7 + (i % 64) * 13) % 41 = 0) AS free
  FROM range(4096) t(i))"""


def rooms(spark: SparkSession) -> DataFrame:
    """Four rectangular rooms: room, idx, polygon (vertices in order), in the world frame of the objects; they overlap by a strip."""
    corners = lambda a, b, c, d: [(a, b), (c, b), (c, d), (a, d)]
    data = [("kitchen", 0, corners(0.03, 0.03, 8.03, 8.03)), ("hall", 1, corners(7.53, 0.03, 15.03, 8.03)), ("bath", 2, corners(0.03, 7.53, 8.03, 15.03)), ("study", 3, [(8.03, 8.03), (15.03, 8.03), (15.03, 15.03), (11.03, 12.03), (8.03, 15.03)])]
    return spark.createDataFrame(data, "room string, idx int, polygon array<struct<x:double,y:double>>")


ROOMS = """rooms AS (
  SELECT * FROM (VALUES
    ('kitchen', 0, [{'x': 0.03, 'y': 0.03}, {'x': 8.03, 'y': 0.03}, {'x': 8.03, 'y': 8.03}, {'x': 0.03, 'y': 8.03}]),
    ('hall', 1, [{'x': 7.53, 'y': 0.03}, {'x': 15.03, 'y': 0.03}, {'x': 15.03, 'y': 8.03}, {'x': 7.53, 'y': 8.03}]),
    ('bath', 2, [{'x': 0.03, 'y': 7.53}, {'x': 8.03, 'y': 7.53}, {'x': 8.03, 'y': 15.03}, {'x': 0.03, 'y': 15.03}]),
    ('study', 3, [{'x': 8.03, 'y': 8.03}, {'x': 15.03, 'y': 8.03}, {'x': 15.03, 'y': 15.03}, {'x': 11.03, 'y': 12.03}, {'x': 8.03, 'y': 15.03}])) v(room, idx, polygon)),
edges AS (
  SELECT room, idx, polygon[i].x::DOUBLE AS x1, polygon[i].y::DOUBLE AS y1, polygon[i % len(polygon) + 1].x::DOUBLE AS x2, polygon[i % len(polygon) + 1].y::DOUBLE AS y2
  FROM rooms, range(1, 6) r(i) WHERE i <= len(polygon))"""
