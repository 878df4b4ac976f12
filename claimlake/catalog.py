"""All queries on the driver's tables, with the SQL that gives the same rows."""

from __future__ import annotations

from .plans import chunk_queries, corpus_queries, evidence_queries, record_queries, report_queries, text_queries
from .plans.registry import ORACLE_SQL, QUERIES

FLAGSHIP = text_queries.audit_summary_by_lang.__name__
__all__ = ["FLAGSHIP", "ORACLE_SQL", "QUERIES", "chunk_queries", "corpus_queries", "evidence_queries", "record_queries", "report_queries", "text_queries"]
