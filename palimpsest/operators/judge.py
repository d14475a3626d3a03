"""Verdicts from a judge's scores."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.functions.conversation import render_for_judge
from palimpsest.functions.stats import exclusive_quantiles, rounded
from palimpsest.functions.text import col

# The judge's checks on a message, in order, and whether each is wanted.
CHECKS = {"bez_kontekstu": True, "prosba": True, "wpisalby_czlowiek": True, "instrukcja_pisania": False, "glos_czatbota": False, "po_polsku": True, "zawiera_odpowiedz": False}


def probability(answer: Column) -> Column:
    """P(true) of an answer: probabilities['true'], else noul."""
    return F.coalesce(F.try_element_at(answer.probabilities, F.lit("true")), answer.noul)


def failed_checks(scores: Column | str, threshold: float = 0.7, checks: dict[str, bool] = CHECKS) -> Column:
    """Names of the checks whose rounded probability of the wanted answer is below the threshold, in order."""
    s = col(scores)
    each = [(name, rounded(F.element_at(s, F.lit(name)))) for name in checks]
    return F.array_compact(F.array(*(F.when((x if checks[name] else 1 - x) < threshold, name) for name, x in each)))


def verdict(failed: Column | str) -> Column:
    return F.when(F.size(col(failed)) == 0, "ok").otherwise("fail")


def failed_counts(df: DataFrame, failed: str = "failed") -> DataFrame:
    return df.select(F.explode(failed).alias("check")).groupBy("check").agg(F.count("*").alias("n"))


def flag(score: Column, problem: Column) -> Column:
    """A problem's score above one half, or a merit's below."""
    return F.when(problem, score > 0.5).otherwise(score < 0.5)


def request(messages: Column, questions: Column, texts: dict[str, str], intro: str = "", reasoning_intro: str = "", form: str = "Rozmowa", with_reasoning: bool = True) -> Column:
    """struct(state, questions): what a judge is asked about a conversation, and the instructions of each question by name."""
    lead = F.concat(F.lit(intro), F.when(F.array_contains(questions, "rozumowanie_sensowne"), reasoning_intro).otherwise(""))
    state = F.concat(lead, F.lit(f'{form}:\n"""\n'), render_for_judge(messages, with_reasoning), F.lit('\n"""'))
    table = F.create_map(*(F.lit(x) for kv in texts.items() for x in kv))
    asked = F.map_from_arrays(questions, F.transform(questions, lambda q: F.struct(F.lit("noul").alias("type"), F.try_element_at(table, q).alias("instructions"))))
    return F.struct(state.alias("state"), asked.alias("questions"))


#: Questions whose yes is a merit. Fixed values.
MERITS = ("dobry_przyklad_sft", "rozumowanie_sensowne")


def summary(df: DataFrame, scores: str = "scores", merits: tuple[str, ...] = MERITS) -> DataFrame:
    """question, n, mean, p10, p50, p90 (exclusive quantiles) and flagged of each question of a map of scores."""
    long = df.select(F.explode(scores).alias("question", "score")).filter("score is not null")
    flagged = F.count_if(flag(F.col("score"), ~F.col("question").isin(*merits)))
    own = long.groupBy("question").agg(F.count("*").alias("n"), F.avg("score").alias("mean"), flagged.alias("flagged"))
    return own.join(exclusive_quantiles(long, "score", {"p10": Fraction(1, 10), "p50": Fraction(1, 2), "p90": Fraction(9, 10)}, ("question",)), "question")
