"""All registered queries, imported in one place."""

from __future__ import annotations

from . import registry_decisions, registry_models, registry_tables  # noqa: F401  (register on import)
from .registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
