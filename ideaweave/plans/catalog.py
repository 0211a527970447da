"""All registered queries (``QUERIES``) and their DuckDB oracle SQL (``ORACLE``)."""

from __future__ import annotations

import importlib

from .registry import ORACLE, QUERIES

_MODULES = ["q_vectorize", "q_ingest", "q_cluster", "q_neighbor", "q_discovery", "q_state", "q_sources", "q_stream", "q_pipeline"]

for _m in _MODULES:
    importlib.import_module(f"{__package__}.{_m}")

__all__ = ["QUERIES", "ORACLE"]
