"""Registered queries of the corpus operators and their check SQL."""

from __future__ import annotations

import corpus_pipeline
from buyerscope.llm import queries

QUERIES = queries.QUERIES | {"pipeline": corpus_pipeline.run}
ORACLE = dict(queries.ORACLE)
