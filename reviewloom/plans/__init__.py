"""Registered queries: each one an operator of the library on the given tables."""

from .registry import ORACLES, QUERIES  # noqa: F401
from . import (  # noqa: F401
    document_queries, evaluation_queries, merge_queries, project_queries, scalar_queries, score_queries,
    search_queries, source_queries, learning_queries, stream_queries,
)
