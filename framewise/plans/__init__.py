"""Registered queries (Spark) with their DuckDB oracles, and fixture views."""

from . import q_detector, q_geometry, q_motion, q_offline, q_sources, q_tracking  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401
