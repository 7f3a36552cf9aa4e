"""Imports every query module so the registry is complete."""
from __future__ import annotations

from evalpress.plans import q_audit, q_cohorts, q_feeds, q_lookups, q_marts, q_modal, q_reports  # noqa: F401
from evalpress.plans.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
