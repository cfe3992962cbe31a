"""Work in progress as a stream: outcomes arrive in files, and each task's state moves on once per outcome."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

GAVE_UP = 999


def _advance(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    status, attempts = state.get if state.exists else ("open", 0)
    for pdf in frames:
        for outcome in pdf.sort_values("at")["outcome"]:
            if outcome == "done":
                status = "done"
            elif outcome == "timeout":
                attempts = GAVE_UP
            elif outcome in ("error", "missing"):
                attempts = min(attempts + 1, GAVE_UP)
    state.update((status, attempts))
    yield pd.DataFrame({"task": [key[0]], "status": [status], "attempts": [attempts]})


def task_states(outcomes: DataFrame) -> DataFrame:
    """From a stream of (task long, at long, outcome string): each touched task's state after every batch (update mode)."""
    return outcomes.groupBy("task").applyInPandasWithState(_advance, "task long, status string, attempts int", "status string, attempts int", "update", GroupStateTimeout.NoTimeout)


def action_windows(events: DataFrame, width: str = "10 minutes", late: str = "5 minutes") -> DataFrame:
    """Counts of actions in tumbling windows of event time (ts), late rows dropped by the watermark."""
    w = events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count(F.lit(1)).alias("n"))
    return w.select(F.col("window.start").alias("start"), "event_type", "n")


def run_available(stream: DataFrame, checkpoint: str, write: Any, mode: str = "update") -> None:
    """Runs a stream over what is there and stops; ``write(batch, id)`` gets each batch. The checkpoint makes a repeated run start where the last one ended."""
    stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write).trigger(availableNow=True).start().awaitTermination()
