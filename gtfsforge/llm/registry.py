"""All registered queries of this subpackage, and the oracle SQL of those that SQL can express."""

from __future__ import annotations

from . import queries_clusters, queries_conversations, queries_join, queries_language, queries_leaks, queries_lines, queries_mixing, queries_pages, queries_secrets, queries_tokens, queries_vectors

MODULES = (queries_join, queries_language, queries_lines, queries_mixing, queries_pages, queries_secrets, queries_tokens, queries_vectors, queries_conversations, queries_leaks, queries_clusters)
QUERIES = {name: f for m in MODULES for name, f in m.QUERIES.items()}
ORACLE = {name: sql for m in MODULES for name, sql in m.ORACLE.items()}
