"""All queries of the core, by name, and the SQL of those that plain SQL can express."""

from __future__ import annotations

from tamis.plans import audits, catalogue, joining, merging, quantities, scalars, selection, urls

_MODULES = (quantities, urls, selection, joining, merging, audits, scalars, catalogue)

QUERIES = {k: v for m in _MODULES for k, v in m.QUERIES.items()}
SQL: dict[str, str] = {k: v for m in _MODULES for k, v in getattr(m, "SQL", {}).items()}
