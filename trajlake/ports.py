"""What a Spark cluster can't do itself: rendering, scene files, language models. Each is a protocol with a deterministic stand-in."""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame


class Renderer(Protocol):
    def capture(self, scene: str, pose: tuple[float, float, float], size: int) -> tuple[np.ndarray, np.ndarray]:
        """An RGBA image and a depth map in metres."""


class SceneReader(Protocol):
    def meshes(self, scene: str) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
        """Instance id, vertices and triangles of each object."""


class LanguageModel(Protocol):
    def complete(self, prompt: str) -> str:
        """The model's answer; may raise."""


class FlatRenderer:
    """Images that depend on scene and pose alone."""

    def capture(self, scene: str, pose: tuple[float, float, float], size: int) -> tuple[np.ndarray, np.ndarray]:
        seed = int.from_bytes(hashlib.md5(f"{scene}|{pose}".encode()).digest()[:8], "big")
        rng = np.random.default_rng(seed)
        return rng.integers(0, 256, (size, size, 4), np.uint8), rng.uniform(0, 10, (size, size))


class EchoModel:
    """Answers with a digest of the prompt."""

    def complete(self, prompt: str) -> str:
        return "answer " + hashlib.md5(prompt.encode()).hexdigest()[:12]


@dataclass(frozen=True)
class CallLimits:
    """Pause between a worker's calls, tries of a call, and the pause before another try."""

    pause_s: float = 1.1
    tries: int = 3
    retry_s: float = 1.0


def ask(prompts: DataFrame, key: str, prompt: str, model: Callable[[], LanguageModel], limits: CallLimits = CallLimits()) -> DataFrame:
    """key, text, error: an answer per prompt. A call that fails gives an error and no text, so it stays pending; a null or empty prompt isn't sent.

    The rate is kept per worker: give it as many partitions as the provider allows callers.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client, last = model(), 0.0
        for pdf in batches:
            rows = []
            for k, p in zip(pdf[key], pdf[prompt], strict=True):
                text = error = None
                if not p:
                    error = "empty prompt"
                for attempt in range(limits.tries if p else 0):
                    time.sleep(max(0.0, last + limits.pause_s - time.monotonic()) + (limits.retry_s * attempt))
                    last = time.monotonic()
                    try:
                        text, error = client.complete(p), None
                        break
                    except Exception as e:  # the port may fail in any way; the row says how
                        error = f"{type(e).__name__}: {e}"[:500]
                rows.append((k, text, error))
            yield pd.DataFrame(rows, columns=[key, "text", "error"])

    kind = prompts.schema[key].dataType.simpleString()
    return prompts.select(key, prompt).mapInPandas(run, f"{key} {kind}, text string, error string")


def styles(answers: DataFrame, key: str) -> DataFrame:
    """key, formal, natural, casual from answers that must be JSON with all three; others are null."""
    from pyspark.sql import functions as F

    s = F.from_json("text", "formal string, natural string, casual string")
    a = answers.select(key, s.alias("s"))
    whole = F.col("s.formal").isNotNull() & F.col("s.natural").isNotNull() & F.col("s.casual").isNotNull()
    return a.select(key, *(F.when(whole, F.col(f"s.{c}")).alias(c) for c in ("formal", "natural", "casual")))


class TreeScenes:
    """Scenes as small trees of boxes that depend on the scene's name alone: one room, one category, three instances."""

    def meshes(self, scene: str) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
        seed = int.from_bytes(hashlib.md5(scene.encode()).digest()[:8], "big")
        rng = np.random.default_rng(seed)
        corners = np.array([(x, y, z) for x in (0.0, 1.0) for y in (0.0, 1.0) for z in (0.0, 1.0)])
        faces = np.array([(0, 1, 3, 2), (4, 6, 7, 5), (0, 4, 5, 1), (2, 3, 7, 6), (0, 2, 6, 4), (1, 5, 7, 3)])
        for i in range(3):
            yield f"/room_0/box/box_{i:04d}/mesh", corners * rng.uniform(0.5, 2, 3) + rng.uniform(0, 8, 3), faces


def scene_nodes(scenes: DataFrame, reader: Callable[[], SceneReader]) -> DataFrame:
    """scene, path, matrix (null), vertices of all meshes that a reader has of each scene: what ``meshes.world_meshes`` takes. A scene is one task's work."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        port = reader()
        for pdf in batches:
            for s in pdf["scene"]:
                rows = [(s, path, None, [{"x": float(x), "y": float(y), "z": float(z)} for x, y, z in v]) for path, v, _ in port.meshes(s)]
                yield pd.DataFrame(rows, columns=["scene", "path", "matrix", "vertices"])

    return scenes.select("scene").distinct().mapInPandas(read, "scene string, path string, matrix array<array<double>>, vertices array<struct<x:double,y:double,z:double>>")


def capture(poses: DataFrame, key: str, renderer: Callable[[], Renderer], size: int = 224, timeout_s: float = 1200.0) -> DataFrame:
    """key, rgb (PNG), depth (NPY, metres), error of each pose (key, scene, x, y, yaw). A capture that fails or takes too long has an error, so its task stays open."""
    from trajlake.run import with_timeout
    from trajlake.sources.arrays import npy_bytes, png_bytes

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        port = renderer()
        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False):
                try:
                    rgb, depth = with_timeout(lambda: port.capture(r.scene, (r.x, r.y, r.yaw), size), timeout_s)  # noqa: B023
                    rows.append((getattr(r, key), png_bytes(rgb), npy_bytes(depth), None))
                except Exception as e:  # the port may fail in any way; the row says how
                    rows.append((getattr(r, key), None, None, f"{type(e).__name__}: {e}"[:500]))
            yield pd.DataFrame(rows, columns=[key, "rgb", "depth", "error"])

    kind = poses.schema[key].dataType.simpleString()
    return poses.select(key, "scene", "x", "y", "yaw").mapInPandas(run, f"{key} {kind}, rgb binary, depth binary, error string")
