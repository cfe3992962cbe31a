"""Documents, arrays, sinks, ports and streams."""

from __future__ import annotations

import json

import numpy as np
from pyspark.sql import functions as F

from trajlake import ports, schemas
from trajlake.operators import meshes, sampling, trajectory
from trajlake.sources import arrays, documents, sinks
from trajlake.streaming import resume


def test_json_documents(spark, tmp_path):
    (tmp_path / "good.json").write_text(json.dumps({"trainval": ["a", "b"], "test": ["c"]}))
    (tmp_path / "bad.json").write_text("{ no")
    docs = documents.read_documents(spark, str(tmp_path), schemas.SPLITS)
    assert {r["path"].rsplit("/", 1)[1]: r["damaged"] for r in docs.collect()} == {"good.json": False, "bad.json": True}
    assert sorted(map(tuple, documents.splits(documents.tolerant(docs, schemas.SPLITS)).collect())) == [("test", "c"), ("trainval", "a"), ("trainval", "b")]
    obj = {"x/1": {"instance_id": "x/1", "category": "lamp", "room": "hall", "min_points": [0, 0, 0], "max_points": [1, 2, 3], "nearby_objects": {"y/2": ["near", 0.25]}}}
    (tmp_path / "o").mkdir()
    (tmp_path / "o" / "object_dict.json").write_text(json.dumps(obj))
    o = documents.read_documents(spark, str(tmp_path / "o"), schemas.OBJECTS).withColumn("scene", F.lit("s"))
    assert documents.objects(o).select("max_z", "category").first() == (3.0, "lamp")
    assert tuple(documents.edges(o).first()) == ("s", "x/1", "y/2", "near", 0.25)


def test_arrays(spark, tmp_path):
    (tmp_path / "path_1_2.npy").write_bytes(arrays.npy_bytes(np.array([[0.0, 1.0], [2.0, 3.0]])))
    (tmp_path / "broken.npy").write_bytes(b"??")
    a = arrays.read_npy(spark, str(tmp_path))
    assert {r["path"].rsplit("/", 1)[1]: r["error"] is None for r in a.collect()} == {"path_1_2.npy": True, "broken.npy": False}
    assert sorted((r["step"], r["x"], r["y"]) for r in arrays.path_points(a).collect()) == [(0, 0.0, 1.0), (1, 2.0, 3.0)]
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "map.npy").write_bytes(arrays.npy_bytes(np.array([[0, 10.0, 11.0], [20.0, 1, 2]])))
    cells = arrays.raster_cells(arrays.read_npy(spark, str(tmp_path / "m"))).drop("path").collect()
    assert sorted(map(tuple, cells)) == [(0, 0, 10.0, 20.0, 1.0), (0, 1, 11.0, 20.0, 2.0)]
    for n in ("rgb_2.png", "RGB_10.PNG", "depth_0.npy", "other.txt"):
        (tmp_path / "m" / n).write_bytes(b"x")
    assert sorted((r["kind"], r["number"]) for r in documents.frames(spark, str(tmp_path / "m")).collect()) == [("depth", 0), ("rgb", 2), ("rgb", 10)]


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("s1", 1, 0), ("s2", 2, 0)], "scene_id string, traj long, step long")
    sinks.write_episodes(rows, str(tmp_path / "e"))
    assert spark.read.parquet(str(tmp_path / "e")).count() == 2 and (tmp_path / "e" / "scene_id=s1").is_dir()
    ep = spark.createDataFrame([("e", "t", "s", "go", None, 0.0, 1.0, 0.0, [[0.0, 1.0, 0.0]], 2.0, 3.0), ("f", "t", "s", None, ("a", "b", "c"), 0.0, 1.0, 0.0, [[0.0, 1.0, 0.0]], 2.0, 3.0)], "episode_id string, traj string, scene string, text string, styles struct<formal: string, natural: string, casual: string>, start_x double, start_y double, start_yaw double, path array<array<double>>, goal_x double, goal_y double")
    sinks.write_json(sinks.manifest(ep), str(tmp_path / "j"), gzip=True)
    back = spark.read.json(str(tmp_path / "j")).orderBy("episode_id").collect()
    assert [json.loads(r["instruction"]["instruction_text"]) for r in back] == [{"text": "go"}, {"formal": "a", "natural": "b", "casual": "c"}]
    v = spark.createDataFrame([("m", i, float(i), 0.0, 0.0) for i in range(3)], "mesh string, i int, x double, y double, z double")
    f = spark.createDataFrame([("m", 0, [0, 1, 2])], "mesh string, j int, corners array<int>")
    assert sinks.obj_lines(v, f).first()["text"].split("\n")[-1] == "f 1 2 3"
    o = spark.createDataFrame([("hall", "a")], "room string, id string")
    r = spark.createDataFrame([("hall",), ("attic",)], "room string")
    assert {x["room"]: x["ids"] for x in sinks.room_document(o, r, wrapped=True).collect()} == {"hall": [["a"]], "attic": []}


def test_ports(spark):
    class Failing:
        def complete(self, prompt: str) -> str:
            if prompt == "bad":
                raise TimeoutError("late")
            return json.dumps({"formal": "f", "natural": "n", "casual": "c"})

    p = spark.createDataFrame([(1, "good"), (2, "bad"), (3, "")], "id long, prompt string")
    got = ports.ask(p, "id", "prompt", Failing, ports.CallLimits(0.0, 2, 0.0))
    rows = {r["id"]: (r["text"] is not None, r["error"]) for r in got.collect()}
    assert rows == {1: (True, None), 2: (False, "TimeoutError: late"), 3: (False, "empty prompt")}
    assert {r["id"]: r["casual"] for r in ports.styles(got, "id").collect()} == {1: "c", 2: None, 3: None}
    a, b = (ports.FlatRenderer().capture("s", (0.0, 0.0, 0.0), 8) for _ in range(2))
    assert np.array_equal(a[0], b[0]) and a[1].shape == (8, 8)


def test_stream_of_outcomes(spark, tmp_path):
    src, seen = tmp_path / "in", {}
    src.mkdir()
    schema = "task long, at long, outcome string"

    def run(name: str, rows: list[tuple]) -> None:
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(src / name))
        stream = spark.readStream.schema(schema).parquet(str(src / "*"))
        resume.run_available(resume.task_states(stream), str(tmp_path / "ck"), lambda df, _: seen.update({r["task"]: (r["status"], r["attempts"]) for r in df.collect()}))

    run("a", [(1, 1, "error"), (1, 2, "missing"), (2, 1, "done")])
    run("b", [(1, 3, "done"), (3, 1, "timeout")])
    assert seen == {1: ("done", 2), 2: ("done", 0), 3: ("open", 999)}


def test_trajectory_edges(spark):
    one = spark.createDataFrame([(1, 0, 0, 0.0, 0.0)], schemas.STEP)
    assert trajectory.headings(one).first()["yaw"] == 0.0 and trajectory.progress(one).first()["progress"] == 0.0
    turns = spark.createDataFrame([(1, i, 2, 0.0, 0.0) for i in range(4)], schemas.STEP)
    assert trajectory.trim_leading_turns(turns).count() == 4
    yaw = [r["yaw"] for r in trajectory.headings(turns).orderBy("step").collect()]
    assert np.allclose(np.degrees(yaw), [0, 15, 30, 45])
    late = spark.createDataFrame([(1, 0, 2, 0.0, 0.0), (1, 1, 1, 0.0, 0.0), (1, 2, 0, 0.0, 1.0)], schemas.STEP)
    got = trajectory.trim_leading_turns(late).orderBy("step").collect()
    assert [r["step"] for r in got] == [1, 2] and np.isclose(got[0]["initial_angle"], np.pi / 2)


def test_sampling_bounds(spark):
    for n in (1, 2, 30, 31, 60):
        got = spark.range(1).select(sampling.uniform_indices(F.lit(n), 30).alias("i")).first()["i"]
        assert got[0] == 0 and got[-1] == n - 1 and len(got) <= 30 and sorted(set(got)) == got
    for goals in (49, 50, 51):
        p = spark.range(goals * 3).select(F.lit(0).alias("s"), (F.col("id") % goals).alias("g"), F.col("id").alias("k"))
        got = sampling.coverage_sample(p, "s", "g", "k", 50, "x")
        assert got.count() == 50 and got.select("g").distinct().count() == min(goals, 50)


def test_surface_samples(spark):
    point = lambda x, y: (float(x), float(y), 0.0)
    s = "struct<x: double, y: double, z: double>"
    t = spark.createDataFrame([(1, 0, point(0, 0), point(3, 0), point(0, 1)), (1, 1, point(5, 5), point(6, 5), point(5, 6)), (2, 0, point(0, 0), point(1, 1), point(2, 2))], f"mesh long, tri int, a {s}, b {s}, c {s}")
    got = meshes.surface_samples(t, "mesh", 100).collect()
    assert len(got) == 100 and sum(r["tri"] == 0 for r in got) == 75
    assert all(r["x"] / 3 + r["y"] <= 1 + 1e-9 for r in got if r["tri"] == 0)
