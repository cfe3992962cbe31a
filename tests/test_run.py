"""Settings, stages, batches, time limits and checkpoints."""

from __future__ import annotations

import json
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from trajlake import ports, run
from trajlake.config import Run
from trajlake.kernels import search, shapes
from trajlake.operators import meshes, raster, rooms, uniqueness
from trajlake.sources import arrays, sinks


def test_settings_from_the_command_line():
    r = run.settings(["--source", "in", "--target", "out", "--excluded-scopes", "Base", "Sky", "--seeds", "goals=7", "--batch", "3", "--planner-degrees", "30", "--relations-close", "0.75"])
    assert (r.source, r.target, r.excluded_scopes, r.batch) == ("in", "out", ("Base", "Sky"), 3)
    assert r.seeds["goals"] == "7" and r.seeds["episodes"] == "42" and r.planner.degrees == 30 and r.relations.close == 0.75 and r.draws == Run("a", "b").draws
    with pytest.raises(SystemExit):
        run.settings(["--source", "in"])


def test_credentials_and_time_limits():
    assert run.credential(["A", "B"], {"A": "", "B": "x"}) == "x"
    with pytest.raises(SystemExit, match="A, B"):
        run.credential(["A", "B"], {})
    assert run.with_timeout(lambda: 3, 5) == 3
    with pytest.raises(run.TimedOut):
        run.with_timeout(lambda: time.sleep(5), 0.1)
    with pytest.raises(KeyError):
        run.with_timeout(lambda: {}["no"], 5)


def test_batches_go_on_until_the_scene_is_done():
    codes, pauses = iter([0, 1, 5, 0, 10]), []
    assert run.until_done(lambda: next(codes), 5, 7, sleep=pauses.append) == run.Outcome.ALL_DONE
    assert pauses == [5, 7, 7, 5]
    assert run.until_done(lambda: 11, sleep=pauses.append) == run.Outcome.SKIP
    assert run.until_done(lambda: 1 // 0, most=3, sleep=lambda s: None) == run.Outcome.MORE


def test_stages_run_once_and_skipped_scenes_stay_out(tmp_path):
    seen: list = []

    def whole(r):
        seen.append("sample")
        return 10

    def scene(name):
        def step(r, s):
            seen.append((name, s))
            return 11 if (name, s) == ("goals", "b") else 10

        return step

    stages = [("sample", False, whole), ("goals", True, scene("goals")), ("render", True, scene("render"))]
    path = str(tmp_path / "state" / "run.json")
    got = run.run_stages(Run("in", "out"), ["a", "b", "c"], stages, run.Checkpoint(path), sleep=lambda s: None)
    assert seen == ["sample", ("goals", "a"), ("goals", "b"), ("goals", "c"), ("render", "a"), ("render", "c")]
    assert got["goals/b"] == "skipped" and got["render/a"] == "done" and "render/b" not in got
    assert json.loads((tmp_path / "state" / "run.json").read_text()) == got
    run.run_stages(Run("in", "out"), ["a", "b", "c", "d"], stages, run.Checkpoint(path), sleep=lambda s: None)
    assert seen[6:] == [("goals", "d"), ("render", "d")]  # what was done stays done


def test_a_checkpoint_is_saved_every_ten_changes_and_at_the_end(tmp_path):
    path = tmp_path / "c.json"
    with run.Checkpoint(str(path)) as c:
        for i in range(10):
            assert not path.exists()
            c.put(f"k{i}", i)
        assert len(json.loads(path.read_text())) == 10
        c.put("last", 1)
        assert "last" not in json.loads(path.read_text())
    assert json.loads(path.read_text())["last"] == 1 and [p.name for p in tmp_path.iterdir()] == ["c.json"]


def test_scene_trees_boxes_and_captures(spark):
    scenes = spark.createDataFrame([("s1",), ("s2",), ("s1",)], "scene string")
    nodes = ports.scene_nodes(scenes, ports.TreeScenes)
    boxes = meshes.instance_boxes(meshes.world_meshes(nodes)).collect()
    assert len(boxes) == 6 and all(r["scope"] == "room_0" and r["max_x"] > r["min_x"] for r in boxes)
    assert meshes.world_meshes(nodes, ("room_0",)).count() == 0
    poses = spark.createDataFrame([(1, "s1", 0.0, 1.0, 0.5), (2, "s2", 0.0, 1.0, 0.5)], "task long, scene string, x double, y double, yaw double")
    got = {r["task"]: r for r in ports.capture(poses, "task", ports.FlatRenderer, 8).collect()}
    assert arrays.png_pixels(bytes(got[1]["rgb"])).shape == (8, 8, 4) and got[1]["error"] is None and got[1]["rgb"] != got[2]["rgb"]

    class Slow:
        def capture(self, scene, pose, size):
            time.sleep(5)

    assert {r["error"][:8] for r in ports.capture(poses, "task", Slow, 8, 0.1).collect()} == {"TimedOut"}


def test_images_arrays_and_error_logs(spark, tmp_path):
    a = np.arange(48, dtype=np.uint8).reshape(4, 4, 3)
    (tmp_path / "a.png").write_bytes(arrays.png_bytes(a))
    (tmp_path / "b.png").write_bytes(b"no image")
    for mode, want in (("RGB", a), ("BGR", a[:, :, ::-1]), ("L", None)):
        rows = {r["path"].rsplit("/", 1)[1]: r for r in arrays.read_images(spark, str(tmp_path), mode).collect()}
        assert rows["b.png"]["pixels"] is None and rows["b.png"]["error"]
        got = np.frombuffer(rows["a.png"]["pixels"], np.uint8).reshape(rows["a.png"]["h"], rows["a.png"]["w"], rows["a.png"]["bands"])
        if want is not None:
            assert (got == want).all()
        else:
            assert got.shape == (4, 4, 1) and np.abs(got[:, :, 0] - (a @ np.array([0.299, 0.587, 0.114]))).max() <= 1
    rows = spark.createDataFrame([("p", [2, 2], [1.0, 2.0, 3.0, 4.0]), ("q", [1], [5.0])], "name string, shape array<long>, data array<double>")
    arrays.write_arrays(rows, str(tmp_path / "out")).collect()
    assert np.load(tmp_path / "out" / "p.npy").tolist() == [[1, 2], [3, 4]] and sorted(p.name for p in (tmp_path / "out").iterdir()) == ["p.npy", "q.npy"]
    bad = spark.createDataFrame([(1, "no file"), (2, None)], "traj long, reason string")
    for _ in range(2):
        sinks.append_errors(bad, str(tmp_path / "log"))
    assert sorted(r["value"] for r in spark.read.text(str(tmp_path / "log")).collect()) == ["traj=1; reason=no file"] * 2 + ["traj=2; reason="] * 2


def test_pipelines_of_paths_and_splines():
    free = np.ones((80, 80), bool)
    p = np.array([[x, 10 + (x % 2)] for x in range(5, 60)], float)
    cells = shapes.tidy(p, free, "cells")
    assert (np.abs(np.diff(cells, axis=0)).max(1) == 2).all() and (cells[0] == p[0]).all()
    for form in ("points", "smooth", "safe"):
        q = shapes.tidy(p, free, form)
        assert len(q) > 2 and np.abs(q - np.rint(q)).max() == 0 and np.abs(q[:, 1] - 10.5).max() <= 2
    with pytest.raises(ValueError):
        shapes.tidy(p, free, "other")
    assert shapes.densify_steps(np.array([[0, 0], [5, 0]], float), 2).tolist() == [[0, 0], [2, 0], [4, 0], [5, 0]]
    line = np.stack([np.linspace(0, 9, 10), np.linspace(0, 18, 10)], 1)
    s = shapes.bspline_smooth(line, 50, slack=1e-9)
    assert np.abs(s[:, 1] - 2 * s[:, 0]).max() < 1e-3 and np.abs(s[[0, -1]] - line[[0, -1]]).max() < 1e-3
    rng = np.random.default_rng(0)
    noisy = np.stack([np.linspace(0, 9, 60), np.sin(np.linspace(0, 6, 60)) + rng.normal(0, 0.05, 60)], 1)
    rough = lambda q: np.square(np.diff(q[:, 1], 3)).sum()
    tight, loose = (shapes.bspline_smooth(noisy, 60, slack=v) for v in (1e-6, 0.5))
    assert rough(loose) < rough(tight) / 5 and np.abs(loose[:, 1] - np.sin(np.linspace(0, 6, 60))).max() < 0.25
    assert shapes.bspline_smooth(np.array([[1.0, 1.0], [1.0, 1.0]])).tolist() == [[1, 1]]


def test_facades_and_goals_in_collision():
    free = np.ones((20, 20), bool)
    free[10, 10] = False
    world = search.World(free, 0.0, 0.0, 0.25)
    assert search.plan_poses(world, (1.0, 1.0, 0), (2.5, 2.5)) is None  # a goal in collision has no path, not even a part of one
    poses, actions = search.plan_pixels(world, (4, 4), (4, 12))
    assert poses.shape[1] == 3 and len(poses) == len(actions) and actions[-1] == search.STOP and np.hypot(*(poses[-1, :2] - [3.0, 1.0])) < 0.125
    path = search.grid_path_xy(free, (0, 0), (19, 19))
    assert path[0].tolist() == [0, 0] and path[-1].tolist() == [19, 19]
    free[:, 5] = False
    assert len(search.grid_path_xy(free, (0, 0), (19, 19))) == 0


def test_goals_of_many_scenes_are_planned_as_those_of_one(spark):
    from trajlake.operators import planning

    rows = {"s": [(r, c, c != 10 or r == 3) for r in range(16) for c in range(20)], "t": [(r, c, True) for r in range(12) for c in range(30)]}
    cells = spark.createDataFrame([(s, *x) for s, own in rows.items() for x in own], "scene string, row int, col int, free boolean")
    starts = spark.createDataFrame([(s, g, o, 0.5 + o * 0.25, 0.75, 3.5 + g * 0.25, 1.5) for s in rows for g in range(2) for o in range(3)], "scene string, goal long, order long, sx double, sy double, gx double, gy double")
    got = planning.plan_scenes(starts, planning.raster_blobs(cells), 0.0, 0.0, 0.25, keep=2)
    for s in rows:
        free = planning.raster_array(cells.where(F.col("scene") == s).drop("scene"))
        want = planning.plan_goals(starts.where(F.col("scene") == s).drop("scene"), search.World(free, 0.0, 0.0, 0.25), keep=2)
        own = sorted(map(tuple, got.where(F.col("scene") == s).drop("scene").collect()))
        assert own == sorted(map(tuple, want.collect())) and len({r[:2] for r in own}) == 4


def test_rasters_without_targets_and_words_with_signs(spark):
    cells = spark.createDataFrame([("s", r, c, r == 0 and c == 9) for r in range(3) for c in range(10)] + [("t", r, c, False) for r in range(3) for c in range(3)], "scene string, row int, col int, free boolean")
    points = spark.createDataFrame([("s", 1, 2, 0), ("t", 2, 1, 1), ("s", 3, 50, 50)], "scene string, k long, row int, col int")
    got = {r["k"]: (r["row"], r["col"], r["d"]) for r in raster.nearest_free(points, cells, "k", ("scene",)).collect()}
    assert got == {1: (0, 9, 9), 2: (None, None, None)}
    ids = spark.createDataFrame([("a+b_1",), ("a(b",), ("ab",)], "id string")
    assert sorted(r["id"] for r in ids.where(uniqueness.denied(F.col("id"), ["a+", "(b"])).collect()) == ["a(b", "a+b_1"]
    assert sorted(r["id"] for r in ids.where(uniqueness.denied_type(F.col("id"), ["ab"])).collect()) == ["ab"]


def test_rooms_by_points_with_ties_and_far_objects(spark):
    square = lambda x, y, n: [(x, y), (x + n, y), (x + n, y + n), (x, y + n)]
    polygons = spark.createDataFrame([("s", 0, "a", square(0.0, 0.0, 4.0)), ("s", 1, "b", square(4.0, 0.0, 4.0)), ("t", 0, "c", square(0.0, 0.0, 1.0))], "scene string, idx int, room string, polygon array<struct<x:double,y:double>>")
    pts = [("s", "half", x, 1.0) for x in (1.0, 2.0, 5.0, 6.0)] + [("s", "more", x, 1.0) for x in (3.0, 5.0, 6.0)] + [("s", "one", 1.0, 1.0)] + [("s", "far", 9.0 + i, 9.0) for i in range(3)] + [("t", "away", -3.0, 5.0)] + [("s", "few", 20.0 + i, 1.0) for i in range(30)] + [("s", "few", 7.0, 1.0), ("s", "few", 7.5, 1.0)]
    got = {r["id"]: (r["room"], round(r["share"], 6)) for r in rooms.assign_rooms(spark.createDataFrame(pts, "scene string, id string, x double, y double"), polygons).collect()}
    assert got == {"half": ("a", 0.5), "more": ("b", round(2 / 3, 6)), "one": ("a", 0.0), "far": ("b", 0.0), "away": ("c", 0.0), "few": ("b", 0.0)}
