"""The named queries: for each a Spark plan and, where SQL can say it, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from palimpsest.plans import answers, conversations, messages, tokens

FLAGSHIP = "q_normalize_dedup"
QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = messages.QUERIES | conversations.QUERIES | tokens.QUERIES | answers.QUERIES


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, (f, _) in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in QUERIES.items() if sql}
