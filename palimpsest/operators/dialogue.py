"""Conversations carried on turn by turn: a question, then its answer, with several tries at each."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.functions.conversation import FORMATS, append, message, render_history, user_turns, wants_turn, without_reasoning, without_role
from palimpsest.functions.rules import POLISH, Pack, clean
from palimpsest.functions.similar import classify_followup
from palimpsest.functions.text import hash_number, split_answer, token_budget
from palimpsest.operators.generate import ModelBackend, Settings, run_model


@dataclass(frozen=True)
class Limits:
    """Tries at a question and at an answer, the context, tokens kept for a question and the least for an answer, repeats."""

    questions: int = 3
    answers: int = 2
    context: int = 8192
    question_tokens: int = 256
    answer_tokens: int = 512
    repeat_ratio: float = 0.75


def stage_seed(key: Column, turn: Column, stage: str, attempt: int) -> Column:
    """A seed from the conversation, the turn, the stage (q or a) and the attempt."""
    return hash_number(F.concat_ws(":", key.cast("string"), turn.cast("string"), F.lit(stage), F.lit(str(attempt))))


def _tries(jobs: DataFrame, most: int, stage: str, call: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """jobs with value, why (null if the value is good), failed and tries, from the first good try or the last one.

    call adds the first three. Every try is checkpointed before it is used, so no model is asked twice for the same try.
    """
    left, done = jobs, []
    for k in range(most):
        got = call(left.withColumn("seed", stage_seed(F.col("id"), F.col("turn"), stage, k))).withColumn("tries", F.lit(k + 1)).checkpoint()
        over = F.col("why").isNull() | F.col("failed") | F.lit(k + 1 == most)
        done.append(got.filter(over))
        left = got.filter(~over).select(jobs.columns)
    return reduce(DataFrame.unionByName, done)


def converse(conversations: DataFrame, asker: ModelBackend, answerer: ModelBackend, model: str, limits: Limits = Limits(), settings: Settings = Settings(), form: str = "v13", pack: Pack = POLISH) -> DataFrame:
    """id, messages, models, turns, tries, ok, finish, stage, reason of each conversation (id, messages, target_turns, models).

    As long as a conversation has fewer user turns than its target: is there room in the context, a question (cleaned, then the
    rules of follow-ups), an answer.  What fails all its tries stops the conversation there, with stage and reason; a model error
    stops it with finish `error`.  All conversations go on side by side, one turn a round; the rounds are as many as the longest wants.
    """
    state = conversations.select("id", "messages", "models", "target_turns", user_turns("messages").alias("turns"), F.array().cast("array<int>").alias("tries"), *(F.lit(None).cast(t).alias(c) for c, t in (("ok", "boolean"), ("finish", "string"), ("stage", "string"), ("reason", "string"))))
    state = state.withColumn("ok", F.when(~wants_turn("messages", F.col("target_turns")), True)).checkpoint()
    rounds = state.agg(F.max(F.when(F.col("ok").isNull(), F.col("target_turns") - F.col("turns")))).first()[0] or 0
    end = lambda ok, finish, stage, reason: {"ok": F.lit(ok), "finish": F.lit(finish), "stage": F.lit(stage), "reason": reason}
    names = state.columns

    def ask(df: DataFrame) -> DataFrame:
        got = run_model(df, asker, settings).withColumn("_c", clean(F.col("raw"), pack))
        why = classify_followup(F.col("_c.raw"), F.col("finish"), F.col("_c.first"), F.get("messages", 0).content, without_reasoning("messages"), pack, limits.repeat_ratio)
        return _judged(got, F.col("_c.raw"), why, df.columns)

    def answer(df: DataFrame) -> DataFrame:
        got = run_model(df, answerer, settings)
        parts = split_answer("raw", F.lit(False))
        return _judged(got, parts.answer, F.when(F.coalesce(F.col("finish") != "stop", F.lit(True)), "ucięte").otherwise(parts.reason), df.columns)

    for _ in range(rounds):
        live = state.filter("ok is null and turns < target_turns").withColumn("turn", F.col("turns") + 1).withColumn("prompt", render_history("messages", form)).withColumnRenamed("tries", "before")
        room = F.lit(limits.context) - F.floor(F.length("prompt") / 2) >= limits.answer_tokens + limits.question_tokens
        full = live.filter(~room).withColumns(end(False, "stop", "pytanie", F.lit("za długa historia")))
        asked = _tries(live.filter(room).drop("finish", "seed", "tries"), limits.questions, "q", ask)
        bad = F.concat(F.lit("błąd: "), F.coalesce("error", F.lit("")))
        lost = asked.filter("failed").withColumns(end(False, "error", "pytanie", bad)).unionByName(asked.filter("not failed and why is not null").withColumns(end(False, "stop", "pytanie", F.col("why"))), allowMissingColumns=True)
        good = asked.filter("why is null").withColumns({"question": F.col("value"), "own_tries": F.col("tries"), "prompt": F.concat("prompt", "value", F.lit(FORMATS[form].assistant.split("{}")[0]))})
        good = good.withColumn("max_tokens", token_budget("prompt", limits.context))
        told = _tries(good.drop("value", "why", "failed", "error", "finish", "tries", "seed"), limits.answers, "a", answer)
        more = {"messages": append("messages", message("user", F.col("question")), message("assistant", F.col("value"))), "models": F.concat("models", F.array(F.lit(model.rstrip("/").rsplit("/", 1)[-1]))), "turns": F.col("turns") + 1}
        on = told.filter("why is null").withColumns(more).withColumn("finish", F.lit(None).cast("string"))
        stuck = told.filter("failed").withColumns(end(False, "error", "odpowiedź", bad)).unionByName(told.filter("not failed and why is not null").withColumns(end(False, "stop", "odpowiedź", F.col("why"))), allowMissingColumns=True)
        count = {"tries": F.concat("before", F.array("own_tries"))}
        parts = [state.filter("ok is not null or turns >= target_turns"), full.withColumn("tries", F.col("before")), lost.withColumn("tries", F.col("before")), on.withColumns(count), stuck.withColumns(count)]
        state = reduce(DataFrame.unionByName, [p.select(*names) for p in parts]).checkpoint()
    stop = {"ok": F.coalesce("ok", F.lit(True)), "finish": F.coalesce("finish", F.lit("stop")), "stage": F.coalesce("stage", F.lit("koniec"))}
    return state.withColumns(stop).drop("target_turns")


def _judged(got: DataFrame, value: Column, why: Column, columns: list[str]) -> DataFrame:
    failed = F.coalesce(F.col("finish") == "error", F.lit(False))
    return got.select(*(c for c in columns if c in got.columns), "error", failed.alias("failed"), value.alias("value"), F.when(failed, "błąd").otherwise(why).alias("why"))


def finished(rows: DataFrame, keep_system: bool = True, least_turns: int = 2) -> DataFrame:
    """Conversations without error and with so many user turns at least; without the system message if that is not wanted."""
    kept = rows.filter((F.coalesce(F.col("finish"), F.lit("")) != "error") & (F.coalesce("turns", F.lit(0)) >= least_turns))
    return kept if keep_system else kept.withColumn("messages", without_role("messages"))
