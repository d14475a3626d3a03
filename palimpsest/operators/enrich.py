"""System prompts by hash lookup, with the checks that make a wrong input fail."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.functions.conversation import message, prepend
from palimpsest.functions.text import sha256


def lookup(definitions: DataFrame, key: str = "id", system: str = "system") -> DataFrame:
    """key, system, ambiguous: the first definition by priority and seq, and whether another one differs."""
    first = F.min_by(F.col(system), F.struct("priority", "seq"))
    return definitions.groupBy(key).agg(first.alias(system), (F.count_distinct(system) > 1).alias("ambiguous"))


def check(df: DataFrame, condition, problem: str) -> DataFrame:
    """df, failing at run time on the first row for which the condition does not hold."""
    names = df.columns
    return df.withColumn("_ok", F.when(F.coalesce(condition, F.lit(False)), True).otherwise(F.raise_error(F.lit(problem)).cast("boolean"))).filter("_ok").select(*names)


def attach_system(conversations: DataFrame, table: DataFrame, thinking: str | None = None, single_turn: bool = False) -> DataFrame:
    """Conversations with their system message in front; each must have its id as hash of the first user text, none yet, and a match.

    The lookup side is joined as it is: Spark broadcasts it if its size is small, and shuffles both sides if not.
    """
    c = conversations
    if thinking is not None:
        c = c.filter(F.col("meta.thinking") == thinking)
    users = lambda: F.filter("messages", lambda m: m.role == "user")
    if single_turn:
        c = c.filter(F.size(users()) == 1)
    c = check(c, sha256(F.get(users(), 0).content) == F.col("id"), "id is not the hash of the first user message")
    c = check(c, ~F.exists("messages", lambda m: m.role == "system"), "a system message is already there")
    joined = c.join(table.select(F.col("id").alias("_id"), F.col("system").alias("_system"), "ambiguous"), F.col("id") == F.col("_id"), "left")
    joined = check(joined, F.col("_system").isNotNull(), "no system message for an id")
    return joined.withColumn("messages", prepend("messages", message("system", F.col("_system")))).drop("_id", "_system")
