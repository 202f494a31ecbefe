"""Column expressions shared by the operators."""

from larder.functions.durations import duration_minutes, duration_problem, duration_seconds
from larder.functions.keys import group_key

__all__ = ["duration_minutes", "duration_problem", "duration_seconds", "group_key"]
