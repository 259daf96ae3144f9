"""Registry of the queries of this folder."""

from __future__ import annotations

import corpus_pipeline
from shelfmark.llm import queries_groups, queries_models, queries_native, queries_rows, queries_search

QUERIES = {**queries_native.QUERIES, **queries_groups.QUERIES, **queries_rows.QUERIES,
           **queries_models.QUERIES, **queries_search.QUERIES, "pipeline": corpus_pipeline.run}
ORACLE = {**queries_native.ORACLE, **queries_groups.ORACLE, **queries_search.ORACLE}
