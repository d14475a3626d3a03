"""Checks of whole tables that stop a run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.functions.conversation import well_formed


def expect_count(df: DataFrame, expected: int) -> DataFrame:
    """df, if it has so many rows (0: whatever it has)."""
    if expected and (n := df.count()) != expected:
        raise ValueError(f"{n} rows, not {expected}")
    return df


def expect_columns(df: DataFrame, wanted: list[str], more: bool = False) -> DataFrame:
    """df, if its columns are those wanted; more: others may be there too."""
    lacking, over = sorted(set(wanted) - set(df.columns)), sorted(set(df.columns) - set(wanted))
    if lacking or (over and not more):
        raise ValueError(f"columns lacking: {lacking}, not wanted: {[] if more else over}")
    return df


def expect_turns(conversations: DataFrame, messages: str = "messages") -> DataFrame:
    """conversations, if each is system, then user and assistant in turns; the count of others comes from one pass."""
    bad = conversations.agg(F.count_if(~F.coalesce(well_formed(messages), F.lit(False)))).first()[0]
    if bad:
        raise ValueError(f"{bad} conversations have another pattern of roles")
    return conversations
