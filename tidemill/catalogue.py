"""All queries of the engine and the SQL they are checked against."""

from __future__ import annotations

from tidemill.queries import data, planning, store
from tidemill.queries.base import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES", "data", "planning", "store"]

# the operator itself has the plain name
for _kept in (QUERIES, ORACLE_SQL):
    _kept["range_delete"] = _kept.pop("range_delete_query")
