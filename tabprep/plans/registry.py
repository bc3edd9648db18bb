"""All registered queries."""

from __future__ import annotations

from tabprep.plans import (  # noqa: F401  (imported for their registrations)
    cleaning_queries,
    feature_queries,
    model_queries,
    profile_queries,
    registry_queries,
    scan_queries,
    search_queries,
    tracking_queries,
    tuning_queries,
)
from tabprep.plans.catalog import ORACLES, QUERIES

from tabprep.plans.model_queries import flagship

__all__ = ["ORACLES", "QUERIES", "flagship"]
