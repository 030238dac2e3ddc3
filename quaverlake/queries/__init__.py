"""Registered queries over the driver tables and the SQL that holds for them."""

from __future__ import annotations

from quaverlake.queries import joins, scores, series, state, values  # noqa: F401  (they register)
from quaverlake.queries.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
