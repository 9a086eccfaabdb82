"""The queries of this subpackage and the SQL that some are checked against."""

from __future__ import annotations

from tidemill.llm import align, bpe, exact, language, media, neardup, packing, quality, search, sharding, substring, suffix, toxicity

_MODULES = (toxicity, language, neardup, sharding, quality, substring, packing, exact, media, bpe, search, align, suffix)

QUERIES: dict = {}
ORACLE_SQL: dict = {}
for _module in _MODULES:
    QUERIES.update(_module.QUERIES)
    ORACLE_SQL.update(_module.ORACLE_SQL)
