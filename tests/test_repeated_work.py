"""What many rows ask alike is worked out once, with the same answers."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from trajlake.operators import planning, raster, sampling, trajectory

FREE = np.array([[(r * 7 + c * 13) % 41 != 0 for c in range(12)] for r in range(12)])


@pytest.fixture(scope="module")
def cells(spark):
    return spark.createDataFrame([(r, c, bool(FREE[r, c])) for r in range(12) for c in range(12)], "row int, col int, free boolean").persist()


def test_grid_paths_search_once(spark, monkeypatch, tmp_path):
    asked = spark.range(0, 4000).select(F.col("id").alias("key"), *((F.col("id") % 3 * m % 12).cast("int").alias(c) for m, c in ((1, "r0"), (2, "c0"), (3, "r1"), (5, "c1"))))
    asked = asked.unionByName(spark.createDataFrame([(-1, None, 1, 2, 3)], "key long, r0 int, c0 int, r1 int, c1 int"))
    real, log = planning.K.grid_path, str(tmp_path / "log")

    def logged(free, start, goal):
        with open(log, "a") as f:
            f.write("x\n")
        return real(free, start, goal)

    monkeypatch.setattr(planning, "K", type("K", (), {"grid_path": staticmethod(logged)}))
    got = {r["key"]: tuple(r)[1:] for r in planning.grid_paths(asked, FREE).collect()}
    assert len(got) == 4001 and got[-1] == (0, 0.0, False) and all(got[i] == got[i % 3] for i in range(4000))
    assert got[1][0] == len(real(FREE, (1, 2), (3, 5)))
    assert len(open(log).readlines()) == 3


def test_points_of_a_cell_are_looked_for_once(spark, cells, monkeypatch):
    written = []
    keep = raster.materialize
    monkeypatch.setattr(raster, "materialize", lambda df, what="stage": (lambda t: (written.append((what, t.count())), t)[1])(keep(df, what)))
    points = spark.range(0, 3000).select(F.col("id").alias("key"), (F.col("id") * 7 % 13).cast("int").alias("row"), (F.col("id") * 5 % 14).cast("int").alias("col"))
    got = {r["key"]: (r["row"], r["col"], r["d"]) for r in raster.nearest_clear(points, cells, "key", 2.0).collect()}
    bad = [(r, c) for r in range(12) for c in range(12) if not FREE[r, c]]
    good = [(r, c) for r in range(12) for c in range(12) if all((r - a) ** 2 + (c - b) ** 2 > 4 for a, b in bad)]
    want = {k: min(((a - r) ** 2 + (b - c) ** 2, a, b) for a, b in good) for k in range(3000) for r, c in [(k * 7 % 13, k * 5 % 14)] if r < 12 and c < 12}
    assert {k: (v[0], v[1], round(v[2] ** 2)) for k, v in got.items()} == {k: (a, b, d) for k, (d, a, b) in want.items()}
    assert max(n for what, n in written) <= 144
    assert raster.nearest_free(points, cells, "key").count() == len(want)
    written.clear()
    faces = points.withColumns({"nx": F.when(F.col("key") % 2 == 0, 1.0).otherwise(0.0), "ny": F.when(F.col("key") % 2 == 0, 0.0).otherwise(1.0)})
    dists = raster.clearance(cells, 4)
    risk = {r["key"]: r["risk"] for r in raster.sector_risk(faces, dists, "key", 1.0, 0.5, 0.25).collect()}
    assert len(risk) == 3000 and all(risk[k] == risk[k % 182] for k in risk) and 0 < sum(np.isinf(v) for v in risk.values()) < 3000
    d = {(r["row"], r["col"]): r["dist"] for r in dists.collect()}
    row, col = 7, 5  # of key 1, which looks along the rows
    seen = [v for (r, c), v in d.items() if v is not None and ((r - row) ** 2 + (c - col) ** 2) / 16 <= 1 and (r - row) / 4 >= 0.5 * ((r - row) ** 2 + (c - col) ** 2) ** 0.5 / 4]
    assert seen and risk[1] == pytest.approx(sum(1 / (v * v + 1e-6) for v in seen))
    assert max(n for _, n in written) <= 182


def test_first_ring_points(spark):
    faces = spark.range(0, 300).select(F.col("id").alias("key"), (F.col("id") * 0.01 + 12.2).alias("cx"), F.lit(3.0).alias("cy"), F.lit(1.0).alias("nx"), F.lit(0.0).alias("ny"))
    plain = sampling.ring_points(faces, "key", 300, 0.5, 1.5, 0.5, "1025").where("x < 15").groupBy("key").agg(F.min(F.struct("try_no", "x", "y")).alias("m")).select("key", "m.*")
    first = sampling.first_ring_points(faces, "key", 300, 0.5, 1.5, 0.5, "1025", F.col("x") < 15)
    want = sorted(map(tuple, plain.collect()))
    assert sorted(map(tuple, first.collect())) == want and 200 < len(want) < 300 and max(r[1] for r in want) > 16


def test_densify_every_reads_once(spark):
    rows = [("a", 0, 0.0, 0.0), ("a", 1, 0.25, 0.0), ("a", 2, 0.25, 0.0), ("a", 3, 0.3, 0.0), ("b", 0, 1.0, 2.0)]
    d = trajectory.densify_every(spark.createDataFrame(rows, "traj string, step long, x double, y double"), 0.1)
    got = sorted((r["traj"], r["step"], r["sub"], round(r["x"], 6), r["y"]) for r in d.collect())
    assert got == [("a", 0, 0, 0.0, 0.0), ("a", 0, 1, 0.1, 0.0), ("a", 0, 2, 0.2, 0.0), ("a", 3, 0, 0.3, 0.0), ("b", 0, 0, 1.0, 2.0), ("b", 0, 1, 1.0, 2.0)]
    assert d._jdf.queryExecution().optimizedPlan().toString().count("Window") <= 2
