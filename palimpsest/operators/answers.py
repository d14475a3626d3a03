"""Answers of a chat model: which can be used, why others cannot, and the conversations they make."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.functions.conversation import append, extend_models, message, same_mode
from palimpsest.functions.text import LEFT_ANY_THINK, TOOL_CALL, basename

#: Labels of an answer's state, from good to bad. Fixed values.
OK, UNCLOSED, CUT, NO_REASONING, TOOL = "ok", "niezamknięte rozumowanie", "ucięte/puste", "brak rozumowania", "wywołanie narzędzia"


def status(answer: Column, reasoning: Column, finish: Column, thinking: Column) -> Column:
    """The first label that applies; `ok` if none of the others does. Nulls are empty, and a missing finish is not `stop`."""
    text, thought = F.coalesce(answer, F.lit("")), F.coalesce(reasoning, F.lit(""))
    return (
        F.when(text.rlike(LEFT_ANY_THINK), UNCLOSED)
        .when(F.coalesce(finish != "stop", F.lit(True)) | (text == ""), CUT)
        .when(thinking & (thought == ""), NO_REASONING)
        .when(text.rlike(TOOL_CALL), TOOL)
        .otherwise(OK)
    )


def accepted(answer: Column, reasoning: Column, finish: Column, thinking: Column) -> Column:
    return status(answer, reasoning, finish, thinking) == OK


def conversations(answers: DataFrame, system: str | None = None) -> DataFrame:
    """id, messages, models, same_mode of each good answer (raw, answer, reasoning, history, models, model, thinking).

    A first turn gets the system text if there is one.  With a history the new turn follows it, and same_mode says whether the
    conversation's mode agrees with the answer's reasoning (rows that differ are to be dropped, and can be counted).
    """
    new = (message("user", F.col("raw")), message("assistant", F.col("answer"), F.col("reasoning")))
    first = F.array(*((message("system", F.lit(system)),) if system else ()), *new)
    later = F.coalesce(F.size("history"), F.lit(0)) > 0
    turns = F.when(later, append("history", *new)).otherwise(first)
    models = F.when(later, extend_models(F.col("models"), F.col("model"), basename("model"))).otherwise(F.array(basename("model")))
    fits = F.when(later, same_mode(F.array(new[1]), F.col("thinking") == "on")).otherwise(True)
    return answers.filter("ok").select("id", turns.alias("messages"), models.alias("models"), fits.alias("same_mode"))
