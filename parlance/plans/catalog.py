"""All registered queries; importing the plan modules fills the registry."""

from __future__ import annotations

from parlance.plans import (  # noqa: F401
    q_evaluate,
    q_features,
    q_logs,
    q_outputs,
    q_preprocess,
    q_profile,
    q_schema,
    q_sinks,
    q_splits,
)
from parlance.plans.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
