"""Occupancy rasters in long form: cells (row, col, free). Neighbourhoods are joins with small offset tables.

``by`` names the columns that tell rasters apart, such as a scene; they are in every key, so all rasters are worked on at once and never mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trajlake.storage import materialize

# The offsets (dy, dx) of the footprint that a path's cells are tested on; it isn't symmetric.
FOOTPRINT = ((0, 0), (2, 0), (0, 1), (-2, 0), (0, -2), (1, 1), (-1, 1), (-1, -1), (1, -1))


def offsets(spark: SparkSession, pairs: tuple[tuple[int, int], ...]) -> DataFrame:
    """A table of a few offsets; its size is that of the kernel."""
    return F.broadcast(spark.createDataFrame(list(pairs), "dr int, dc int"))


def kernel(size: int) -> tuple[tuple[int, int], ...]:
    """Offsets that a square kernel spreads an obstacle by; an even one reaches one further to the lower side of its anchor at size // 2."""
    low, high = -(size - 1 - size // 2), size // 2
    return tuple((r, c) for r in range(low, high + 1) for c in range(low, high + 1))


def binarise(values: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """row, col, free from raw cell values: 1 is free, all else (unknown too) an obstacle."""
    return values.select(*by, "row", "col", (F.col("value") == 1).alias("free"))


def dilate(cells: DataFrame, size: int, times: int = 1, by: tuple[str, ...] = ()) -> DataFrame:
    """The raster with its obstacles spread by a square kernel, so many times. Cells outside count for nothing."""
    k = offsets(cells.sparkSession, kernel(size))
    for _ in range(times):
        hit = cells.where(~F.col("free")).join(k).select(*by, (F.col("row") + F.col("dr")).alias("row"), (F.col("col") + F.col("dc")).alias("col")).distinct()
        cells = cells.join(hit.withColumn("hit", F.lit(True)), [*by, "row", "col"], "left").select(*by, "row", "col", (F.col("free") & F.col("hit").isNull()).alias("free"))
    return cells


def clearance(cells: DataFrame, most: int, by: tuple[str, ...] = ()) -> DataFrame:
    """row, col, dist of free cells to the nearest obstacle, exact up to ``most`` cells; beyond that null. Obstacles reach a fixed number of cells each."""
    ring = tuple((r, c) for r in range(-most, most + 1) for c in range(-most, most + 1) if r * r + c * c <= most * most)
    near = cells.where(~F.col("free")).join(offsets(cells.sparkSession, ring)).select(*by, (F.col("row") + F.col("dr")).alias("row"), (F.col("col") + F.col("dc")).alias("col"), F.sqrt((F.col("dr") * F.col("dr") + F.col("dc") * F.col("dc")).cast("double")).alias("d"))
    return cells.where("free").join(near.groupBy(*by, "row", "col").agg(F.min("d").alias("dist")), [*by, "row", "col"], "left").select(*by, "row", "col", "dist")


def footprint_free(places: DataFrame, cells: DataFrame, keys: list[str], shape: tuple[tuple[int, int], ...] = FOOTPRINT, by: tuple[str, ...] = ()) -> DataFrame:
    """keys, clear: whether all cells of the footprint around a place are inside the raster and free."""
    p = places.join(offsets(places.sparkSession, shape)).select(*by, *keys, (F.col("row") + F.col("dr")).alias("row"), (F.col("col") + F.col("dc")).alias("col"))
    return p.join(cells, [*by, "row", "col"], "left").groupBy(*by, *keys).agg(F.bool_and(F.coalesce("free", F.lit(False))).alias("clear"))


def in_sector(dx: Column, dy: Column, nx: Column, ny: Column, radius: float, half_arc_cos: float) -> Column:
    """Whether an offset lies within a radius and an arc about a direction; the apex itself does."""
    d2 = dx * dx + dy * dy
    return (d2 <= radius * radius) & (dx * nx + dy * ny >= half_arc_cos * F.sqrt(d2))


def sector_cells(faces: DataFrame, cells: DataFrame, key: str, radius: float, half_arc_cos: float, cell: float, by: tuple[str, ...] = ()) -> DataFrame:
    """The cells (with all their columns) in the sector before each face (key, row, col, nx, ny), with the key.

    Cells meet faces by an equi-join on squares as wide as the radius, each face in the nine about it.
    """
    n = int(radius / cell) + 1
    f = faces.select(*by, key, F.col("row").alias("r0"), F.col("col").alias("c0"), "nx", "ny")
    f = f.withColumn("br", F.explode(F.sequence(F.floor(F.col("r0") / n) - 1, F.floor(F.col("r0") / n) + 1))).withColumn("bc", F.explode(F.sequence(F.floor(F.col("c0") / n) - 1, F.floor(F.col("c0") / n) + 1)))
    c = cells.withColumns({"br": F.floor(F.col("row") / n), "bc": F.floor(F.col("col") / n)})
    dx, dy = (F.col("col") - F.col("c0")) * cell, (F.col("row") - F.col("r0")) * cell
    return f.join(c, [*by, "br", "bc"]).where(in_sector(dx, dy, F.col("nx"), F.col("ny"), radius, half_arc_cos)).select(key, *cells.columns)


def sector_risk(faces: DataFrame, dists: DataFrame, key: str, radius: float, half_arc_cos: float, cell: float, by: tuple[str, ...] = ()) -> DataFrame:
    """key, risk: sum of 1 / (d^2 + 1e-6) over the free cells before a face (row, col, nx, ny); infinite where there is none. Faces at one place that look the same way are asked once."""
    place = [*by, "row", "col", "nx", "ny"]
    once = faces.select(*place).distinct().withColumn("face", F.monotonically_increasing_id())
    once = materialize(once, "faces")
    hit = sector_cells(once, dists, "face", radius, half_arc_cos, cell, by)
    risk = hit.groupBy("face").agg(F.sum(1 / (F.col("dist") * F.col("dist") + 1e-6)).alias("risk"))
    risk = materialize(once.join(risk, "face").drop("face"), "risks")
    # A key of several faces has the sum over all of them on each.
    total = F.sum("risk").over(Window.partitionBy(*by, key))
    return faces.select(key, *place).join(risk, place, "left").select(*by, key, F.coalesce(total, F.lit(float("inf"))).alias("risk"))


def _nearest(points: DataFrame, cells: DataFrame, targets: DataFrame, key: str, by: tuple[str, ...], far) -> DataFrame:
    """by, key, row, col, d of the target cell with the least distance ``far(dr, dc)`` (ties: row, then col) of each point (key, row, col) inside the raster;
    nulls where its raster has no target. Points and targets meet in squares as wide as the reach, which is doubled twice until all have one, so
    a round costs what is left. Points of one cell are looked for once."""
    at = [*by, "r0", "c0"]
    placed = points.select(*by, key, F.col("row").alias("r0"), F.col("col").alias("c0"))
    there = placed.select(*at).distinct().join(cells.select(*by, F.col("row").alias("r0"), F.col("col").alias("c0")), at, "left_semi")
    wide = cells.agg(F.greatest(F.max("row") - F.min("row"), F.max("col") - F.min("col"))).first()[0]
    left, out, reach = materialize(there, "near"), None, 4
    while wide is not None:
        square = lambda c: F.floor(F.col(c) / reach)  # noqa: B023, E731
        p = left
        for b, c in (("br", "r0"), ("bc", "c0")):
            p = p.withColumn(b, F.explode(F.sequence(square(c) - 1, square(c) + 1)))
        t = targets.select(*by, "row", "col", square("row").alias("br"), square("col").alias("bc"))
        met = p.join(t, [*by, "br", "bc"]).withColumn("d", far(F.col("row") - F.col("r0"), F.col("col") - F.col("c0"))).where(F.col("d") <= reach)
        found = materialize(met.groupBy(*at).agg(F.min(F.struct("d", "row", "col")).alias("m")).select(*at, "m.row", "m.col", "m.d"), "near")
        out = found if out is None else out.unionByName(found)
        left = materialize(left.join(found.select(*at), at, "left_anti"), "near")
        if reach > 2 * wide or not left.limit(1).count():
            break
        reach *= 4
    none = left.select(*at, *(F.lit(None).cast("int").alias(c) for c in ("row", "col", "d")))
    return placed.join(none if out is None else out.unionByName(none), at).select(*by, key, "row", "col", "d")


def nearest_free(points: DataFrame, cells: DataFrame, key: str, by: tuple[str, ...] = ()) -> DataFrame:
    """key, row, col, d of the free cell with the least Chebyshev distance (ties: row, then col), however far; nulls where a raster has no free cell. Points outside the raster are left out."""
    near = _nearest(points, cells, cells.where("free"), key, by, lambda dr, dc: F.greatest(F.abs(dr), F.abs(dc)))
    return near.groupBy(*by, key).agg(F.min(F.struct("d", "row", "col")).alias("m")).select(*by, key, "m.row", "m.col", "m.d")


def nearest_clear(points: DataFrame, cells: DataFrame, key: str, threshold: float = 5.0, by: tuple[str, ...] = ()) -> DataFrame:
    """key, row, col, d of the nearest (Euclid; ties: row, then col) free cell whose distance to all obstacles is above a threshold; nulls where there is none."""
    clear = clearance(cells, int(threshold), by).where(F.col("dist").isNull() | (F.col("dist") > threshold))
    return _nearest(points, cells, materialize(clear, "clear"), key, by, lambda dr, dc: F.sqrt((dr * dr + dc * dc).cast("double")))


def nearest_on_axis(values: DataFrame, axis: DataFrame, value: str, key: str) -> DataFrame:
    """key, idx: the axis entry (idx, w) with the least distance to a value, the first of equals. An axis has a few thousand entries; it meets the values
    by blocks of their rounded coordinates when it is regular, so this general form is for one scene's axis at a time."""
    one = axis.agg(F.array_sort(F.collect_list(F.struct("idx", "w"))).alias("axis"))
    j = values.join(F.broadcast(one))
    best = F.array_min(F.transform("axis", lambda a: F.struct(F.abs(a["w"] - F.col(value)).alias("d"), a["idx"].alias("idx"))))
    return j.select(key, best["idx"].alias("idx"))


def sight_lines(pairs: DataFrame, cells: DataFrame, key: str, by: tuple[str, ...] = ()) -> DataFrame:
    """key, clear: whether the cells of evenly spaced points on the line (r0, c0) to (r1, c1) are all inside and free."""
    n = F.greatest(F.abs(F.col("r1") - F.col("r0")), F.abs(F.col("c1") - F.col("c0")), F.lit(1))
    p = pairs.withColumn("n", n).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("n"))))
    at = lambda a, b: F.floor(F.col(a) + (F.col(b) - F.col(a)) * F.col("i") / F.col("n") + 0.5).cast("int")
    return p.select(*by, key, at("r0", "r1").alias("row"), at("c0", "c1").alias("col")).join(cells, [*by, "row", "col"], "left").groupBy(*by, key).agg(F.bool_and(F.coalesce("free", F.lit(False))).alias("clear"))
