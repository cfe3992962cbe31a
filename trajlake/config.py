"""Settings of a run, with the usual values; each stage takes what it needs."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trajlake.kernels.search import PlannerSettings
from trajlake.operators.relations import Thresholds
from trajlake.ports import CallLimits


@dataclass(frozen=True)
class Run:
    """Folders, seeds and limits."""

    source: str
    target: str
    split: str = "trainval"
    excluded_scopes: tuple[str, ...] = ("Base",)
    seeds: dict[str, str] = field(default_factory=lambda: {"episodes": "42", "frames": "1024", "goals": "1025", "medoids": "0"})
    draws: int = 2000
    medoids: int = 5
    starts_tried: int = 51
    paths_kept: int = 5
    rendered: int = 50
    batch: int = 25
    attempts: int = 5
    timeout_s: int = 1200
    frames: int = 30
    points_per_object: int = 7000
    least_path_cells: float = 80.0
    endpoint_slack: float = 1.5
    planner: PlannerSettings = PlannerSettings()
    relations: Thresholds = Thresholds()
    calls: CallLimits = CallLimits()

    def without_excluded(self, objects: DataFrame, scope: str) -> DataFrame:
        """The objects whose scope isn't left out; a null scope stays."""
        return objects.where(~F.coalesce(F.col(scope).isin(*self.excluded_scopes), F.lit(False))) if self.excluded_scopes else objects
