"""Queries answer for every input row, beyond the sizes at which they once stopped."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from trajlake.kernels.search import grid_path
from trajlake.kernels.shapes import share_inside
from trajlake.operators.planning import raster_array
from trajlake.plans import load_all
from trajlake.plans.catalog import QUERIES
from trajlake.sources.testbed import cells

load_all()


def test_natural_sort_ranks_all_events(spark, tmp_path):
    e = spark.range(0, 5000).select(F.col("id").alias("event_id"), (F.col("id") * 37 % 211).alias("user_id"))
    e.write.parquet(f"{tmp_path}/events.parquet")
    got = {r["event_id"]: r["place"] for r in QUERIES["natural_sort"](spark, str(tmp_path)).collect()}
    want = sorted(range(5000), key=lambda i: (i % 1000, i * 37 % 211, i))
    assert got == {i: n for n, i in enumerate(want, 1)}


def test_rasters_answer_for_all_events(spark, tmp_path):
    """Events whose places repeat must get the answers of the early events at the same places."""
    spark.range(0, 9000).select(F.col("id").alias("event_id")).write.parquet(f"{tmp_path}/events.parquet")
    lines = {r["event_id"]: r["clear"] for r in QUERIES["sight_lines"](spark, str(tmp_path)).collect()}
    assert sorted(lines) == list(range(9000)) and all(lines[i] == lines[i % 64] for i in lines)
    risks = {r["event_id"]: r["risk"] for r in QUERIES["sector_risk"](spark, str(tmp_path)).collect()}
    assert sorted(risks) == list(range(9000)) and all(risks[i] == risks[i % 4422] for i in risks)


def test_grid_paths_of_all_customers(spark, tmp_path):
    spark.range(95, 110).select(F.col("id").alias("c_custkey")).write.parquet(f"{tmp_path}/customer.parquet")
    got = {r["key"]: r for r in QUERIES["grid_paths"](spark, str(tmp_path)).collect()}
    free = raster_array(cells(spark))
    assert sorted(got) == list(range(95, 110))
    for k, r in got.items():
        path = grid_path(free, (k * 3 % 64, k * 5 % 64), (k * 7 % 64, k * 11 % 64))
        assert r["n_cells"] == len(path) and r["reached"] == (bool(path) and path[-1] == (k * 7 % 64, k * 11 % 64))


def test_clouds_of_every_label_meet(spark, tmp_path):
    rng = np.random.default_rng(3)
    clouds = np.round(rng.uniform(0, 1, (12, 21, 3)) * 64) / 64
    rows = [(i, i % 10, [float(v) for v in c.ravel()] + [0.0]) for i, c in enumerate(clouds)]
    spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {(r["a"], r["b"]): r["dist"] for r in QUERIES["cloud_distances"](spark, str(tmp_path)).collect()}
    least = {(i, i + 1): np.sqrt(((clouds[i][:, None] - clouds[i + 1][None]) ** 2).sum(2)).min() for i in range(11)}
    want = {k: round(float(d), 6) for k, d in least.items() if d <= 0.25}
    assert len(want) > 8 and got == want
    shares = {(r["a"], r["b"]): r["share"] for r in QUERIES["hull_shares"](spark, str(tmp_path)).collect()}
    assert shares == {(i, i + 1): share_inside(clouds[i], clouds[i + 1]) for i in range(11)}


def test_limits_are_those_of_the_reference(spark, tmp_path):
    draws = {r["room"]: r["count"] for r in QUERIES["walkable_draws"](spark, str(tmp_path)).groupBy("room").count().collect()}
    assert draws == {room: 2000 for room in range(4)}
    drawn = QUERIES["distinct_draws"](spark, str(tmp_path)).groupBy("room").sum("n").collect()
    assert sorted(tuple(r) for r in drawn) == [(room, 2000) for room in range(4)]
    cloud = [float(v) for v in np.round(np.random.default_rng(4).uniform(0, 1, 64) * 64) / 64]
    spark.createDataFrame([(7, 0, cloud)], "vec_id long, label int, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert QUERIES["surface_samples"](spark, str(tmp_path)).count() == 7000
    spark.range(0, 25).select(F.col("id").alias("n_nationkey")).write.parquet(f"{tmp_path}/nation.parquet")
    paths = QUERIES["planned_paths"](spark, str(tmp_path)).select("goal", "start_no").distinct().groupBy("goal").count().collect()
    # A goal in collision has no path: its cell (row 3, column 4 gx) is an obstacle of the raster.
    free = {k for k in range(25) if (3 * 7 + 4 * (k * 5 % 14 + 1) * 13) % 41}
    assert {r["goal"] for r in paths} == free and len(free) == 23 and max(r["count"] for r in paths) == 4
    hard = [(k, "a bolt", "kitchen", 1) for k in range(2000)]
    spark.createDataFrame(hard, "p_partkey long, p_name string, p_type string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    late = [r for r in QUERIES["ring_points"](spark, str(tmp_path)).collect() if r["try_no"] >= 8]
    assert late and all(r["x"] < 15 and r["try_no"] < 1000 for r in late)
