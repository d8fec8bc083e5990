"""All queries bound to the given tables, and the SQL they must equal."""

from __future__ import annotations

from starloom.plans import (
    assess_queries,
    catalog_queries,
    cleaning_queries,
    feature_queries,
    matrix_queries,
    rough_queries,
    selection_queries,
    stream_queries,
)

_MODULES = (
    matrix_queries,
    cleaning_queries,
    feature_queries,
    selection_queries,
    rough_queries,
    catalog_queries,
    assess_queries,
    stream_queries,
)

QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}

flagship = matrix_queries.flagship
