"""Recurrences along trajectories as window expressions. Steps are rows (traj, step, action, x, y); actions 0 stop, 1 forward, 2 left, 3 right."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from trajlake.functions.geometry import wrap

STOP, FORWARD, LEFT, RIGHT = 0, 1, 2, 3


def along(traj: str = "traj", step: str = "step") -> WindowSpec:
    return Window.partitionBy(traj).orderBy(step)


def running(traj: str = "traj", step: str = "step") -> WindowSpec:
    return along(traj, step).rowsBetween(Window.unboundedPreceding, 0)


def signed_turn(action: Column, degrees: float) -> Column:
    return F.when(action == LEFT, math.radians(degrees)).when(action == RIGHT, -math.radians(degrees)).otherwise(0.0)


def headings(steps: DataFrame, degrees: float = 15.0, still: float = 0.01) -> DataFrame:
    """The steps with yaw. A step that has moved more than ``still`` faces its move; one that has not keeps the yaw before, turned by
    the action before. The first step faces the second (yaw 0 if that hasn't moved).

    Runs of still steps are islands that begin at a move: the island's yaw plus the turns since. The only step of a trajectory has yaw 0.
    """
    w, run = along(), running()
    d = steps.withColumns({"dx": F.col("x") - F.lag("x").over(w), "dy": F.col("y") - F.lag("y").over(w), "turn": signed_turn(F.lag("action").over(w), degrees), "nx": F.lead("x").over(w) - F.col("x"), "ny": F.lead("y").over(w) - F.col("y")})
    moved = F.coalesce(F.sqrt(F.col("dx") * F.col("dx") + F.col("dy") * F.col("dy")) > still, F.lit(False))
    first = F.col("dx").isNull()
    d = d.withColumn("moved", moved).withColumn("base", F.when(F.col("moved"), F.atan2("dy", "dx")).when(first, F.coalesce(F.atan2("ny", "nx"), F.lit(0.0))))
    d = d.withColumn("island", F.sum(F.when(F.col("moved") | first, 1).otherwise(0)).over(run))
    own = Window.partitionBy("traj", "island").orderBy("step")
    turned = F.sum(F.when(F.col("base").isNull(), F.col("turn")).otherwise(0.0)).over(own.rowsBetween(Window.unboundedPreceding, 0))
    yaw = F.first("base").over(own) + turned
    return d.withColumn("yaw", F.when(F.col("base").isNotNull(), F.col("base")).otherwise(wrap(yaw))).select(*steps.columns, "yaw")


def trim_leading_turns(steps: DataFrame) -> DataFrame:
    """Drops all steps before the last one that is still at the first place, and adds initial_angle, the direction of the first move.

    A trajectory that never moves is whole, with angle 0.
    """
    whole = Window.partitionBy("traj")
    w = along()
    start = lambda c: F.first(c).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    away = (F.col("x") != start("x")) | (F.col("y") != start("y"))
    s = steps.withColumns({"away": away, "dx": F.col("x") - F.lag("x").over(w), "dy": F.col("y") - F.lag("y").over(w)})
    s = s.withColumn("first_move", F.min(F.when(F.col("away"), F.col("step"))).over(whole))
    angle = F.max(F.when(F.col("step") == F.col("first_move"), F.atan2("dy", "dx"))).over(whole)
    s = s.withColumn("initial_angle", F.coalesce(angle, F.lit(0.0)))
    return s.where(F.col("first_move").isNull() | (F.col("step") >= F.col("first_move") - 1)).select(*steps.columns, "initial_angle")


def progress(steps: DataFrame) -> DataFrame:
    """Evenly spaced from 0 at the first step to 1 at the last; the only step of a trajectory has 0."""
    n = F.count(F.lit(1)).over(Window.partitionBy("traj"))
    return steps.withColumn("progress", F.coalesce((F.row_number().over(along()) - 1) / F.nullif(n - 1, F.lit(0).cast("bigint")), F.lit(0.0)))


def path_lengths(steps: DataFrame) -> DataFrame:
    w = along()
    dx, dy = F.col("x") - F.lag("x").over(w), F.col("y") - F.lag("y").over(w)
    return steps.withColumn("d", F.coalesce(F.sqrt(dx * dx + dy * dy), F.lit(0.0))).groupBy("traj").agg(F.sum("d").alias("length"), F.count(F.lit(1)).alias("n_steps"))


def end_poses(steps: DataFrame) -> DataFrame:
    """First and last place of each trajectory."""
    p = F.struct("x", "y")
    g = steps.groupBy("traj").agg(F.min_by(p, "step").alias("a"), F.max_by(p, "step").alias("b"))
    return g.select("traj", F.col("a.x").alias("start_x"), F.col("a.y").alias("start_y"), F.col("b.x").alias("goal_x"), F.col("b.y").alias("goal_y"))


def ordered_path(steps: DataFrame) -> DataFrame:
    """traj, path: the places in order, as one array."""
    g = steps.groupBy("traj").agg(F.array_sort(F.collect_list(F.struct("step", "x", "y"))).alias("p"))
    return g.select("traj", F.transform("p", lambda s: F.array(s["x"], s["y"], F.lit(0.0))).alias("path"))


def replay(steps: DataFrame, degrees: float = 15.0) -> DataFrame:
    """The frames that a replay captures: the start, and one after each action before the first stop; with the heading in degrees after the turns so far."""
    stop = F.min(F.when(F.col("action") == STOP, F.col("step"))).over(Window.partitionBy("traj"))
    turn = F.when(F.col("action") == LEFT, degrees).when(F.col("action") == RIGHT, -degrees).otherwise(0.0)
    live = steps.withColumn("stop", stop).where(F.col("stop").isNull() | (F.col("step") < F.col("stop")))
    moves = live.select("traj", (F.row_number().over(along())).cast("int").alias("frame"), F.sum(turn).over(running()).alias("heading"))
    return moves.unionByName(steps.select("traj").distinct().select("traj", F.lit(0).alias("frame"), F.lit(0.0).alias("heading")))


def dead_reckoning(steps: DataFrame, forward: float = 0.25, degrees: float = 15.0) -> DataFrame:
    """Places that the actions alone lead to from the origin, facing x; the place is that before the step's action."""
    before = along().rowsBetween(Window.unboundedPreceding, -1)
    s = steps.withColumn("heading", F.coalesce(F.sum(signed_turn(F.col("action"), degrees)).over(before), F.lit(0.0)))
    go = lambda f: F.when(F.col("action") == FORWARD, forward * f("heading")).otherwise(0.0)
    s = s.withColumns({"gx": go(F.cos), "gy": go(F.sin)})
    return s.select("traj", "step", "heading", F.coalesce(F.sum("gx").over(before), F.lit(0.0)).alias("px"), F.coalesce(F.sum("gy").over(before), F.lit(0.0)).alias("py"))


def action_counts(steps: DataFrame) -> DataFrame:
    a = F.col("action")
    return steps.groupBy("traj").agg(*(F.count_if(a == k).alias(n) for k, n in ((STOP, "n_stop"), (FORWARD, "n_forward"), (LEFT, "n_left"), (RIGHT, "n_right"))))


def describe_actions(counts: DataFrame, forward: float = 0.25, degrees: int = 15) -> DataFrame:
    """A sentence per trajectory with the counts in metres and degrees."""
    text = F.format_string(f"Forward: %dx (%.2fm), Left: %dx (%d°), Right: %dx (%d°)", "n_forward", F.col("n_forward") * forward, "n_left", F.col("n_left") * degrees, "n_right", F.col("n_right") * degrees)  # noqa: F541
    return counts.select("traj", F.when(F.col("n_forward") + F.col("n_left") + F.col("n_right") + F.col("n_stop") == 0, "No actions").otherwise(text).alias("description"))


def moving_average(steps: DataFrame, window: int) -> DataFrame:
    """Centred means of x and y over an odd window; the ends, where it doesn't fit, stay as they are."""
    half = window // 2
    frame = along().rowsBetween(-half, half)
    n = F.count(F.lit(1)).over(frame)
    return steps.withColumns({c: F.when(n == 2 * half + 1, F.avg(c).over(frame)).otherwise(F.col(c)) for c in ("x", "y")})


def smooth_corners(steps: DataFrame, window: int) -> DataFrame:
    """Means over a window (cut at the ends) at points that aren't on a straight run along an axis; the first and last point stay."""
    half, w = window // 2, along()
    frame = w.rowsBetween(-half, half)
    straight = lambda c: (F.lag(c).over(w) == F.col(c)) & (F.lead(c).over(w) == F.col(c))
    keep = F.coalesce(straight("x") | straight("y"), F.lit(True)) | F.lag("x").over(w).isNull() | F.lead("x").over(w).isNull()
    return steps.withColumn("keep", keep).withColumns({c: F.when(F.col("keep"), F.col(c)).otherwise(F.avg(c).over(frame)) for c in ("x", "y")}).drop("keep")


def densify(steps: DataFrame, part: float) -> DataFrame:
    """Cuts each leg of a path into ceil(length / part) equal parts; legs shorter than a millionth are left out. The last point ends the path."""
    w = along()
    s = steps.withColumns({"nx": F.lead("x").over(w), "ny": F.lead("y").over(w)})
    leg = F.sqrt((F.col("nx") - F.col("x")) * (F.col("nx") - F.col("x")) + (F.col("ny") - F.col("y")) * (F.col("ny") - F.col("y")))
    s = s.withColumn("leg", leg).withColumn("parts", F.ceil(F.col("leg") / part).cast("int"))
    cut = s.where(F.col("leg") > 1e-6).select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("sub"))
    cut = cut.select("traj", "step", "sub", *((F.col(c) + (F.col(f"n{c}") - F.col(c)) * F.col("sub") / F.col("parts")).alias(c) for c in ("x", "y")))
    return cut.unionByName(s.where("nx is null").select("traj", "step", F.lit(0).alias("sub"), "x", "y"))


def densify_every(steps: DataFrame, every: float) -> DataFrame:
    """A point each ``every`` along every leg, counted from its start; of the given points only the first and the last stay, as ends. Legs of no length give none."""
    w = along()
    s = steps.withColumns({"nx": F.lead("x").over(w), "ny": F.lead("y").over(w), "first": F.lag("x").over(w).isNull()})
    leg = F.sqrt((F.col("nx") - F.col("x")) * (F.col("nx") - F.col("x")) + (F.col("ny") - F.col("y")) * (F.col("ny") - F.col("y")))
    s = s.withColumn("leg", leg)
    n, none = F.floor(F.col("leg") / every).cast("int"), F.array().cast("array<int>")
    inner = F.when((F.col("leg") > 0) & (n >= 1), F.sequence(F.lit(1), n)).otherwise(none)
    start = F.when(F.col("first"), F.array(F.lit(0))).otherwise(none)
    last = F.when(F.col("nx").isNull(), F.array(F.when(F.col("first"), 1).otherwise(0))).otherwise(none)
    s = s.withColumn("sub", F.explode(F.concat(start, inner, last)))
    part = F.col("sub") * every / F.col("leg")
    return s.select("traj", "step", "sub", *(F.when((F.col("sub") > 0) & F.col("nx").isNotNull(), F.col(c) + (F.col(f"n{c}") - F.col(c)) * part).otherwise(F.col(c)).alias(c) for c in ("x", "y")))


def through_door(steps: DataFrame, segments: DataFrame) -> DataFrame:
    """traj, line, path: for each door line of a path's scene that it meets, its start, the middle of the line and its end; other paths as they are, with a null line."""
    ends = steps.groupBy("traj").agg(F.min_by(F.array("x", "y"), "step").alias("a"), F.max_by(F.array("x", "y"), "step").alias("b"), F.array_sort(F.collect_list(F.struct("step", "x", "y"))).alias("p"))
    hit = crossings(steps, segments).select("traj", "line", F.array((F.col("x1") + F.col("x2")) / 2, (F.col("y1") + F.col("y2")) / 2).alias("q")).distinct()
    whole = F.transform("p", lambda v: F.array(v["x"], v["y"]))
    return ends.join(hit, "traj", "left").select("traj", "line", F.when(F.col("q").isNull(), whole).otherwise(F.array("a", "q", "b")).alias("path"))


def line_cells(legs: DataFrame, keys: list[str], spacing: int = 1) -> DataFrame:
    """keys, i, row, col: the cells of lines (r0, c0) to (r1, c1), one for each unit of the longer direction, halves rounded towards the end, every ``spacing``-th of them."""
    n = F.greatest(F.abs(F.col("r1") - F.col("r0")), F.abs(F.col("c1") - F.col("c0")))
    p = legs.withColumn("n", n).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("n"), F.lit(spacing))))
    go = lambda a, b: F.col(a) + F.signum(F.col(b) - F.col(a)).cast("int") * F.coalesce(F.floor((2 * F.col("i") * F.abs(F.col(b) - F.col(a)) + F.col("n")) / F.nullif(2 * F.col("n"), F.lit(0))), F.lit(0)).cast("int")
    return p.select(*keys, "i", go("r0", "r1").alias("row"), go("c0", "c1").alias("col"))


def raster_path(steps: DataFrame, spacing: int = 1) -> DataFrame:
    """traj, step, i, row, col: a path in cells (x: column, y: row, both rounded), each leg by its line's every ``spacing``-th cell; legs after the first leave out their first cell."""
    w = along()
    at = lambda c: F.floor(F.col(c) + 0.5).cast("int")
    s = steps.select("traj", "step", at("y").alias("r0"), at("x").alias("c0"), F.lead(at("y")).over(w).alias("r1"), F.lead(at("x")).over(w).alias("c1"), F.lag("x").over(w).isNull().alias("first"))
    return line_cells(s.where("r1 is not null"), ["traj", "step", "first"], spacing).where(F.col("first") | (F.col("i") > 0)).drop("first")


def crossings(steps: DataFrame, segments: DataFrame) -> DataFrame:
    """traj, step, line: legs of a path that meet a segment (line, x1, y1, x2, y2). Segments are door lines of a scene, a small list per scene."""
    from trajlake.functions.geometry import segments_intersect

    w = along()
    legs = steps.select("traj", "step", "x", "y", F.lead("x").over(w).alias("nx"), F.lead("y").over(w).alias("ny")).where("nx is not null")
    c = F.col
    near = (F.least("x", "nx") <= F.greatest("x1", "x2")) & (F.greatest("x", "nx") >= F.least("x1", "x2"))
    return legs.join(segments, near & segments_intersect((c("x"), c("y"), c("nx"), c("ny")), (c("x1"), c("y1"), c("x2"), c("y2")))).select("traj", "step", "line", "x1", "y1", "x2", "y2")


def path_by_crossings(steps: DataFrame, segments: DataFrame) -> DataFrame:
    """traj, path: the midpoints of all crossed segments, by leg and then segment; empty where none is crossed."""
    hit = crossings(steps, segments).select("traj", F.struct("step", "line", ((F.col("x1") + F.col("x2")) / 2).alias("x"), ((F.col("y1") + F.col("y2")) / 2).alias("y")).alias("q"))
    g = hit.groupBy("traj").agg(F.array_sort(F.collect_list("q")).alias("q"))
    return g.select("traj", F.transform("q", lambda s: F.array(s["x"], s["y"])).alias("path"))
