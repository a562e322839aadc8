"""All queries and oracles of the knowledge engine."""

from __future__ import annotations

from plinth.plans import context_queries, evaluation_queries, graph_queries, page_queries, paper_queries, project_queries, review_queries, rule_queries, table_queries, text_queries, value_queries

MODULES = (text_queries, graph_queries, page_queries, paper_queries, context_queries, rule_queries, review_queries, value_queries, project_queries, evaluation_queries, table_queries)
QUERIES: dict = {k: v for m in MODULES for k, v in m.QUERIES.items()}
ORACLES: dict = {k: v for m in MODULES for k, v in m.ORACLES.items()}
