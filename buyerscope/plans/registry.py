"""All registered queries and their check SQL."""

from __future__ import annotations

from buyerscope.plans import (
    cleaning_queries,
    feature_queries,
    lifetime_queries,
    model_queries,
    profile_queries,
    training_queries,
)

_MODULES = (feature_queries, cleaning_queries, profile_queries, lifetime_queries, model_queries, training_queries)

QUERIES = {name: fn for m in _MODULES for name, fn in m.QUERIES.items()}
ORACLE = {name: sql for m in _MODULES for name, sql in m.ORACLE.items()}
