"""Spark-native analytics for embodied-navigation data: objects, rooms, rasters, trajectories, goals and episodes."""

from trajlake.session import local_session

__all__ = ["local_session"]
