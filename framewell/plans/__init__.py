"""Registered queries over the driver's tables (import registers them)."""

from framewell.plans import (flagship, q_changes, q_collection, q_frames, q_io, q_mutations, q_objects,  # noqa: F401
                             q_series, q_stream, q_topics, q_versions)
from framewell.plans.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
