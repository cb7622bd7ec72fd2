"""Every query of the library by name, with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from attestry.plans import answer_queries, evidence_queries, layout_queries, ledger_queries, projection_queries, register_queries, run_queries, source_queries, verdict_queries

FLAGSHIP = "bitemporal_verdict"

_ALL = verdict_queries.QUERIES | evidence_queries.QUERIES | source_queries.QUERIES | register_queries.QUERIES | answer_queries.QUERIES | projection_queries.QUERIES | layout_queries.QUERIES | ledger_queries.QUERIES | run_queries.QUERIES


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, (f, _) in _ALL.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _ALL.items() if sql}
