"""Which goals are pursued, from where they are viewed, and which of their paths count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trajlake.functions.text import object_type, relation_word
from trajlake.operators.sampling import draw

#: Metres that a path may end from its end point, and from its object, before it is dropped.
ENDPOINT_SLACK, GOAL_SLACK = 1.5, 1.5
#: Longest door line, in pixels.
DOOR_PIXELS = 50.0


def in_order(goals: DataFrame) -> DataFrame:
    """The goals with place: all of kind relational before all of kind semantic, each by ids. One window per scene and kind."""
    w = Window.partitionBy("scene", "kind").orderBy("object_2_id", "object_1_id")
    n = F.count(F.lit(1))
    first = goals.where("kind = 'relational'").groupBy("scene").agg(n.alias("__first"))
    ranked = goals.withColumn("__n", F.row_number().over(w)).join(first, "scene", "left")
    place = F.col("__n") + F.when(F.col("kind") == "relational", 0).otherwise(F.coalesce("__first", F.lit(0)))
    return ranked.withColumn("place", place.cast("long")).drop("__n", "__first")


def different_types(target: Column, source: Column) -> Column:
    """Whether two ids name different types: a goal is not told from a thing of its own kind."""
    kind = lambda c: object_type(F.split_part(c, F.lit("/"), F.lit(1)))
    return kind(target) != kind(source)


def choose_view(a_room: Column, b_room: Column, target_room: Column, a_risk: Column, b_risk: Column) -> Column:
    """'a' or 'b': the view in the target's room; of two such that with the smaller risk (ties: a); null where neither is there.

    Null rooms are equal to each other and to nothing else, as for places outside of all rooms.
    """
    a, b = a_room.eqNullSafe(target_room), b_room.eqNullSafe(target_room)
    return F.when(a & b, F.when(a_risk <= b_risk, "a").otherwise("b")).when(a, "a").when(b, "b")


def ends_well(end_x: Column, end_y: Column, want_x: Column, want_y: Column, goal_x: Column, goal_y: Column) -> Column:
    """Whether a path ends within reach of its end point or of its object; it is dropped only where both are too far."""
    far = lambda x, y: F.sqrt((end_x - x) * (end_x - x) + (end_y - y) * (end_y - y))
    return ~((far(want_x, want_y) > ENDPOINT_SLACK) & (far(goal_x, goal_y) > GOAL_SLACK))


def ends_in_room(end_room: Column, target_room: Column) -> Column:
    return end_room.eqNullSafe(target_room)


def start_order(goals: DataFrame, starts: DataFrame, seed: str = "1025") -> DataFrame:
    """goal, start, order: for each goal the starts of its scene in a seeded order of its own (any engine gets the same)."""
    j = goals.select("scene", "goal").join(starts.select("scene", "start"), "scene")
    w = Window.partitionBy("scene", "goal").orderBy(draw(seed, F.col("goal"), F.col("start")), "start")
    return j.select("scene", "goal", "start", (F.row_number().over(w) - 1).cast("long").alias("order"))


def door_lines(doors: DataFrame, longest: float = DOOR_PIXELS) -> DataFrame:
    """The door sills (scene, id, r0, c0, r1, c1: corners of the box in pixels) whose lines are shorter than ``longest``."""
    dr, dc = F.col("r1") - F.col("r0"), F.col("c1") - F.col("c0")
    return doors.where(F.col("id").contains("doorsill_") & (F.sqrt((dr * dr + dc * dc).cast("double")) < longest))


def sentence(location: Column, goal: Column, rel: Column, ref: Column) -> Column:
    """What a goal asks, in our own words."""
    return F.format_string("In the %s, find the %s that is %s the %s", location, goal, relation_word(rel), ref)


def batch(tasks: DataFrame, order: str, size: int, start: int = 0) -> DataFrame:
    """Rows start .. start + size - 1 in order of a unique column, counted from 0: a batch of tasks or a slice of directories."""
    return tasks.orderBy(order).offset(start).limit(size)
