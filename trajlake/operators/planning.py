"""Kernels over groups: one task per goal, trajectory, cloud pair or room, with the raster shipped once per scene as a broadcast value."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trajlake.kernels import search as K
from trajlake.kernels import shapes as P
from trajlake.storage import materialize

#: Most bytes of one scene's raster that is sent to the workers; a larger one belongs in tiles.
RASTER_BYTES = 64 << 20


def raster_array(cells: DataFrame) -> np.ndarray:
    """One scene's raster as an array. Its size is checked: it goes to the driver."""
    h, w = cells.agg(F.max("row"), F.max("col")).first()
    if h is None:
        return np.zeros((0, 0), bool)
    if (h + 1) * (w + 1) > RASTER_BYTES:
        raise ValueError("the raster is too large to be sent whole; cut the scene into tiles")
    free = np.zeros((h + 1, w + 1), bool)
    for r, c in cells.where("free").select("row", "col").toLocalIterator():
        free[r, c] = True
    return free


def raster_blobs(cells: DataFrame, by: str = "scene") -> DataFrame:
    """by, h, w, bits: each scene's raster as one packed blob (rows of its cells in order), made where the cells are; no raster goes to the driver."""

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        free = np.zeros((int(pdf["row"].max()) + 1, int(pdf["col"].max()) + 1), bool)
        own = pdf[pdf["free"]]
        free[own["row"], own["col"]] = True
        return pd.DataFrame({by: [pdf[by].iloc[0]], "h": [free.shape[0]], "w": [free.shape[1]], "bits": [np.packbits(free).tobytes()]})

    kind = cells.schema[by].dataType.simpleString()
    return cells.select(by, "row", "col", "free").groupBy(by).applyInPandas(pack, f"{by} {kind}, h int, w int, bits binary")


def unpack_raster(h: int, w: int, bits: bytes) -> np.ndarray:
    return np.unpackbits(np.frombuffer(bits, np.uint8), count=h * w).reshape(h, w).astype(bool)


def plan_scenes(starts: DataFrame, blobs: DataFrame, x0: float, y0: float, cell: float, settings: K.PlannerSettings = K.PlannerSettings(), attempts: int = 51, keep: int = 5, by: str = "scene") -> DataFrame:
    """``plan_goals`` for the goals of many scenes: by, goal, start_no, step, x, y, action. A goal is a task's work; it comes with its scene's blob, on the row of its
    first start alone. Scenes without a raster have no paths."""
    from pyspark.sql import Window

    first = F.row_number().over(Window.partitionBy(by, "goal").orderBy("order")) == 1
    rows = starts.withColumn("first", first).join(blobs, by)
    rows = rows.select(by, "goal", "order", "sx", "sy", "gx", "gy", "h", "w", F.when(F.col("first"), F.col("bits")).alias("bits"))

    def plan(pdf: pd.DataFrame) -> pd.DataFrame:
        own = pdf.sort_values("order")
        bits = next(b for b in own["bits"] if b is not None)
        world = K.World(unpack_raster(int(own["h"].iloc[0]), int(own["w"].iloc[0]), bits), x0, y0, cell)
        out, won = [], 0
        for r in own.head(attempts).itertuples():
            if won == keep:
                break
            found = K.plan_poses(world, (r.sx, r.sy, 0), (r.gx, r.gy), settings)
            if found:
                won += 1
                out += [(getattr(r, by), r.goal, r.order, i, x, y, a) for i, ((x, y, _), a) in enumerate(zip(*found, strict=True))]
        return pd.DataFrame(out, columns=[by, "goal", "start_no", "step", "x", "y", "action"])

    kind = starts.schema[by].dataType.simpleString()
    return rows.groupBy(by, "goal").applyInPandas(plan, f"{by} {kind}, goal long, start_no long, step long, x double, y double, action int")


def plan_goals(starts: DataFrame, world: K.World, settings: K.PlannerSettings = K.PlannerSettings(), attempts: int = 51, keep: int = 5) -> DataFrame:
    """goal, start_no, step, x, y, action: for each goal (goal, order, sx, sy, gx, gy) the first ``keep`` paths among its first ``attempts`` starts in order."""

    def plan(pdf: pd.DataFrame) -> pd.DataFrame:
        out, won = [], 0
        for r in pdf.sort_values("order").head(attempts).itertuples():
            if won == keep:
                break
            found = K.plan_poses(world, (r.sx, r.sy, 0), (r.gx, r.gy), settings)
            if found:
                won += 1
                out += [(r.goal, r.order, i, x, y, a) for i, ((x, y, _), a) in enumerate(zip(*found, strict=True))]
        return pd.DataFrame(out, columns=["goal", "start_no", "step", "x", "y", "action"])

    return starts.groupBy("goal").applyInPandas(plan, "goal long, start_no long, step long, x double, y double, action int")


def grid_paths(pairs: DataFrame, free: np.ndarray) -> DataFrame:
    """key, n_cells, cost, reached of grid paths between cells (key, r0, c0, r1, c1). Each pair of cells is searched once, however many keys ask for it; ends that are unknown have no path."""
    ends = ["r0", "c0", "r1", "c1"]
    # Asked pairs may be one small partition, but each row is a search of a millisecond or two.
    asked = pairs.select(*ends).dropna().distinct().repartition(4 * pairs.sparkSession.sparkContext.defaultParallelism)

    def find(batches):
        for pdf in batches:
            rows = []
            for r in pdf.itertuples():
                p = K.grid_path(free, (r.r0, r.c0), (r.r1, r.c1))
                d = np.diff(np.array(p), axis=0) if len(p) > 1 else np.zeros((0, 2))
                rows.append((r.r0, r.c0, r.r1, r.c1, len(p), round(float(np.hypot(d[:, 0], d[:, 1]).sum()), 6), bool(p) and p[-1] == (r.r1, r.c1)))
            yield pd.DataFrame(rows, columns=[*ends, "n_cells", "cost", "reached"])

    found = materialize(asked.mapInPandas(find, "r0 int, c0 int, r1 int, c1 int, n_cells int, cost double, reached boolean"), "paths")
    none = {"n_cells": 0, "cost": 0.0, "reached": False}
    return pairs.join(found, ends, "left").select(F.col("key").cast("long").alias("key"), *(F.coalesce(c, F.lit(v)).alias(c) for c, v in none.items()))


def per_path(steps: DataFrame, f, key: str = "traj") -> DataFrame:
    """traj, step, x, y: a polyline kernel (N x 2 array to M x 2 array) on each trajectory."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("step")
        q = f(pdf[["x", "y"]].to_numpy(float))
        return pd.DataFrame({key: pdf[key].iloc[0], "step": np.arange(len(q)), "x": q[:, 0], "y": q[:, 1]})

    return steps.select(key, "step", "x", "y").groupBy(key).applyInPandas(run, f"{key} long, step long, x double, y double")


def discrete_actions(steps: DataFrame, forward: float = 0.25, degrees: float = 15.0) -> DataFrame:
    """traj, i, action: the actions that follow each path."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        a = K.follow(pdf.sort_values("step")[["x", "y"]].to_numpy(float), forward, degrees)
        return pd.DataFrame({"traj": pdf["traj"].iloc[0], "i": range(len(a)), "action": a})

    return steps.select("traj", "step", "x", "y").groupBy("traj").applyInPandas(run, "traj long, i long, action int")


def hull_shares(pairs: DataFrame, points: DataFrame, key: str) -> DataFrame:
    """a, b, share: the share of a's points inside the hull of b. Ask only for pairs that are near enough to touch: their boxes decide that without a kernel.

    A hull is made once for each b, whatever asks for it; flat ones have no planes. Small tables are dealt to all tasks by a number that isn't coalesced."""
    tasks = 4 * pairs.sparkSession.sparkContext.defaultParallelism
    kind = points.schema[key].dataType.simpleString()
    p = points.groupBy(key).agg(F.collect_list(F.array("x", "y", "z")).alias("p"))

    def hulls(batches):
        for pdf in batches:
            planes = (P.hull_planes(np.stack(y)) for y in pdf["p"])
            yield pd.DataFrame({"b": pdf[key], "planes": [None if h is None else h.tolist() for h in planes]})

    h = p.join(pairs.select(F.col("b").alias(key)).distinct(), key).select(key, "p").repartition(tasks, key).mapInPandas(hulls, f"b {kind}, planes array<array<double>>")
    j = pairs.join(p.select(F.col(key).alias("a"), F.col("p").alias("pa")), "a").join(h, "b")

    def run(batches):
        for pdf in batches:
            yield pd.DataFrame({"a": pdf["a"], "b": pdf["b"], "share": [P.share_within(np.stack(x), None if y is None else np.stack(y)) for x, y in zip(pdf["pa"], pdf["planes"], strict=True)]})

    return j.select("a", "b", "pa", "planes").repartition(tasks, "a", "b").mapInPandas(run, f"a {kind}, b {kind}, share double")


def representative_points(points: DataFrame, group: str, k: int = 5) -> DataFrame:
    """group, x, y: up to ``k`` medoids of each group's distinct points, in order."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        p = np.unique(pdf[["x", "y"]].to_numpy(float), axis=0)
        q = p[P.medoids(p, k)]
        return pd.DataFrame({group: pdf[group].iloc[0], "x": q[:, 0], "y": q[:, 1]})

    return points.select(group, "x", "y").groupBy(group).applyInPandas(run, f"{group} long, x double, y double")


def line_table(pairs: DataFrame, free: np.ndarray | None = None, radius: int = 0) -> DataFrame:
    """key, i, row, col, blocked: the cells of lines (key, r0, c0, r1, c1), and whether the swept line hits an obstacle."""

    def run(batches):
        for pdf in batches:
            rows = []
            for r in pdf.itertuples():
                cells = P.line_cells(r.r0, r.c0, r.r1, r.c1)
                hit = free is not None and P.line_hits(free, cells, radius)
                rows += [(r.key, i, int(a), int(b), hit) for i, (a, b) in enumerate(cells)]
            yield pd.DataFrame(rows, columns=["key", "i", "row", "col", "blocked"])

    return pairs.mapInPandas(run, "key long, i int, row int, col int, blocked boolean")
