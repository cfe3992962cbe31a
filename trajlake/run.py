"""Running the stages of a data set: settings from the command line, stages in order, batches until a scene is done, and a checkpoint that survives any stop."""

from __future__ import annotations

import argparse
import enum
import json
import os
import posixpath
import signal
import threading
import time
import uuid
from collections.abc import Callable, Iterable, Mapping
from dataclasses import fields
from typing import Any

from pyarrow import fs as pafs

from trajlake.config import Run


class Outcome(enum.IntEnum):
    """What a batch says by its exit code. 0 more is left, 10 all done, 11 skip the scene; any other code is a failure to be tried again."""

    MORE = 0
    ALL_DONE = 10
    SKIP = 11


class TimedOut(Exception):
    """A call took longer than it may."""


def with_timeout(call: Callable[[], Any], seconds: float) -> Any:
    """The call's result, or ``TimedOut``. In a process's main thread (a Python worker's too) an alarm interrupts the call; elsewhere it is left to end by itself."""
    if threading.current_thread() is threading.main_thread():

        def ring(*_: Any) -> None:
            raise TimedOut(f"more than {seconds} s")

        before = signal.signal(signal.SIGALRM, ring)
        signal.setitimer(signal.ITIMER_REAL, seconds)
        try:
            return call()
        finally:
            signal.setitimer(signal.ITIMER_REAL, 0)
            signal.signal(signal.SIGALRM, before)
    box: dict[str, Any] = {}

    def work() -> None:
        try:
            box["value"] = call()
        except BaseException as e:  # handed to the caller below
            box["error"] = e

    t = threading.Thread(target=work, daemon=True)
    t.start()
    t.join(seconds)
    if t.is_alive():
        raise TimedOut(f"more than {seconds} s")
    if "error" in box:
        raise box["error"]
    return box["value"]


def credential(names: Iterable[str], environment: Mapping[str, str] = os.environ) -> str:
    """The first of the variables that is set and not empty; ends the program with a message where none is."""
    names = list(names)
    for n in names:
        if environment.get(n):
            return environment[n]
    raise SystemExit(f"set one of {', '.join(names)}")


def until_done(batch: Callable[[], int], pause_s: float = 5.0, error_pause_s: float = 7.0, most: int | None = None, sleep: Callable[[float], None] = time.sleep) -> Outcome:
    """Runs batches until one says that all is done or the scene is to be skipped. A failed batch is tried again after a longer pause, without end unless ``most`` is given."""
    n = 0
    while most is None or n < most:
        n += 1
        try:
            code = int(batch())
        except Exception:  # a batch may fail in any way and is tried again
            code = 1
        if code in (Outcome.ALL_DONE, Outcome.SKIP):
            return Outcome(code)
        sleep(pause_s if code == Outcome.MORE else error_pause_s)
    return Outcome.MORE


class Checkpoint:
    """A JSON document that is replaced whole: saved under a new name and then moved, every ``every`` changes and at the end."""

    def __init__(self, uri: str, every: int = 10) -> None:
        self.store, self.path = pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri)
        self.every, self.changes = every, 0
        self.data: dict[str, Any] = {}
        if self.store.get_file_info(self.path).type == pafs.FileType.File:
            with self.store.open_input_stream(self.path) as f:
                self.data = json.loads(f.read())

    def put(self, key: str, value: Any) -> None:
        self.data[key] = value
        self.changes += 1
        if self.changes >= self.every:
            self.save()

    def save(self) -> None:
        self.store.create_dir(posixpath.dirname(self.path), recursive=True)
        other = f"{self.path}.{uuid.uuid4().hex}"
        with self.store.open_output_stream(other) as f:
            f.write(json.dumps(self.data, sort_keys=True).encode())
        self.store.move(other, self.path)
        self.changes = 0

    def __enter__(self) -> Checkpoint:
        return self

    def __exit__(self, *_: object) -> None:
        if self.changes:
            self.save()


Stage = tuple[str, bool, Callable[..., int]]


def run_stages(run: Run, scenes: list[str], stages: list[Stage], state: Checkpoint, **how: Any) -> dict[str, Any]:
    """Runs stages (name, whether scene by scene, function) in order and returns the state. A stage or a scene's stage that the state calls done or skipped isn't run again.

    A function takes (run) or (run, scene) and returns an exit code; of a stage by scene a batch at a time. A scene that is to be skipped leaves out its later stages.
    """
    skipped = {k.split("/", 1)[1] for k, v in state.data.items() if v == "skipped" and "/" in k}
    with state:
        for name, by_scene, step in stages:
            for scene in scenes if by_scene else [None]:
                key = f"{name}/{scene}" if by_scene else name
                if state.data.get(key) in ("done", "skipped") or scene in skipped:
                    continue
                got = until_done((lambda: step(run, scene)) if by_scene else (lambda: step(run)), **how)  # noqa: B023
                if got == Outcome.SKIP and scene is not None:
                    skipped.add(scene)
                state.put(key, {Outcome.ALL_DONE: "done", Outcome.SKIP: "skipped", Outcome.MORE: "open"}[got])
    return dict(state.data)


def settings(argv: list[str] | None = None) -> Run:
    """A run from the command line: an option for each plain setting, ``--planner-...`` and ``--relations-...`` for those inside."""
    p = argparse.ArgumentParser(prog="trajlake", description="Settings of a run.")
    simple: dict[str, Any] = {}
    nested = {"planner": Run.planner, "relations": Run.relations, "calls": Run.calls}
    for f in fields(Run):
        name = "--" + f.name.replace("_", "-")
        if f.name in ("source", "target"):
            p.add_argument(name, required=True)
        elif f.name == "excluded_scopes":
            p.add_argument(name, nargs="*", default=list(Run.excluded_scopes))
        elif f.name == "seeds":
            p.add_argument(name, nargs="*", default=[], metavar="NAME=SEED")
        elif f.name not in nested:
            simple[f.name] = type(f.default)
            p.add_argument(name, type=type(f.default), default=f.default)
    for group, value in nested.items():
        for f in fields(value):
            p.add_argument(f"--{group}-{f.name.replace('_', '-')}", type=type(getattr(value, f.name)), default=getattr(value, f.name))
    a = vars(p.parse_args(argv))
    inner = {g: type(v)(**{f.name: a[f"{g}_{f.name}"] for f in fields(v)}) for g, v in nested.items()}
    base = Run(a["source"], a["target"])
    seeds = base.seeds | dict(x.split("=", 1) for x in a["seeds"])
    return Run(a["source"], a["target"], excluded_scopes=tuple(a["excluded_scopes"]), seeds=seeds, **{k: a[k] for k in simple}, **inner)
