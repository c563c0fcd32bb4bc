"""Registered queries, each with an independent SQL formulation of the same result."""

from tenorgrid.catalog.registry import REGISTRY, Tables
from tenorgrid.catalog import aggregates, decisions, filters, joins, landed, panels, reports, scalars, scans, windows  # noqa: F401

__all__ = ["REGISTRY", "Tables"]
