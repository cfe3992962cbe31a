"""Schemas of the documents that scenes come in and episodes go out as."""

from __future__ import annotations

from pyspark.sql import types as T


SPLITS = "map<string, array<string>>"
ROOM_REGIONS = "map<string, array<array<int>>>"
OBJECTS = "map<string, struct<instance_id: string, category: string, scope: string, room: string, position: array<double>, min_points: array<double>, max_points: array<double>, nearby_objects: map<string, array<string>>>>"
GOALS = "map<string, struct<instruction: array<string>, goal: struct<object_1_id: string, object_1_relation_to_2: string, object_2_id: string, object_2_relation_to_1: string>, room: string, augmented_instructions: struct<formal: string, natural: string, casual: string>>>"
ACTIONS = "struct<actions: array<int>, forward_distance: double, turn_angle: int, description: string, start_pos: array<int>, end_pos: array<int>, path_length: double, initial_angle_rad: double, initial_angle_deg: double>"
FINE = "map<string, struct<sequence_path: string, instruction: string, num_original_frames: int, num_sampled_frames: int>>"

#: The columns of an episode's step table; dots are part of the names.
EPISODE = T.StructType(
    [T.StructField(f"observation.{w}_{p}", T.ArrayType(T.DoubleType())) for w in ("camera", "robot") for p in ("position", "orientation")]
    + [T.StructField(f"observation.{n}", T.DoubleType()) for n in ("camera_yaw", "robot_yaw", "progress")]
    + [T.StructField(n, T.LongType()) for n in ("observation.step", "observation.action", "timestamp", "frame_index", "episode_index", "index", "task_index")]
)
EDGE = T.StructType([*(T.StructField(n, T.StringType()) for n in ("scene", "src", "dst", "rel")), T.StructField("dist", T.DoubleType())])
STEP = T.StructType([T.StructField("traj", T.LongType()), T.StructField("step", T.LongType()), T.StructField("action", T.IntegerType()), *(T.StructField(n, T.DoubleType()) for n in "xy")])
