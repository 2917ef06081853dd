"""Trajectory analytics on Spark DataFrames and Structured Streaming."""

from trackflow.config import DEFAULTS, Settings

__all__ = ["DEFAULTS", "Settings"]
