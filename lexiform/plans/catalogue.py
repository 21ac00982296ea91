"""Registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lexiform.plans import contract_queries, evaluation_queries, extract_queries, gate_queries, merge_queries, party_queries, report_queries, review_queries, role_queries, route_queries, scope_queries, source_queries, split_queries, state_queries, text_queries

PLANS = (text_queries, contract_queries, role_queries, split_queries, state_queries, scope_queries, merge_queries, extract_queries, party_queries, review_queries, evaluation_queries, source_queries, route_queries, report_queries, gate_queries)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract_queries.contract_fields(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for m in PLANS for k, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for m in PLANS for k, s in m.SQL.items()}
