"""Registered queries over the driver tables (one module per theme)."""

from rankflow.plans import (q_cleaning, q_features, q_ingest, q_recommend,  # noqa: F401
                            q_sequences,
                            q_io, q_learn, q_models, q_profile, q_stats, q_trends)
from rankflow.plans.registry import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
