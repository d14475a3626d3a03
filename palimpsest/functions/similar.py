"""Similarity of two texts as the ratio of matching blocks; no built-in has it, so it is a vectorised UDF."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType

from palimpsest.functions.rules import POLISH, Pack, classify
from palimpsest.functions.text import normalize, shingles


@F.pandas_udf(DoubleType())
def _ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b, strict=True)])


def ratio(new: Column, old: Column, least: float = 0.0) -> Column:
    """The ratio; pairs whose lengths rule out `least` get 0 without being compared."""
    short, both = F.least(F.length(new), F.length(old)), F.length(new) + F.length(old)
    hopeless = (both > 0) & (2.0 * short / both < least)
    return F.when(hopeless, 0.0).otherwise(_ratio(F.when(~hopeless, new), F.when(~hopeless, old)))


def repeats_question(raw: Column, earlier: Column, least: float = 0.75) -> Column:
    """Whether a message is that similar to one of the earlier texts (an array)."""
    return F.coalesce(_any_similar(normalize(raw), F.transform(earlier, normalize), F.lit(least)), F.lit(False))


@F.pandas_udf(BooleanType())
def _any_similar(new: pd.Series, old: pd.Series, least: pd.Series) -> pd.Series:
    def one(x, olds, t):
        if x is None or olds is None:
            return None
        return any(y is not None and (2 * min(len(x), len(y)) >= t * (len(x) + len(y))) and SequenceMatcher(None, x, y).ratio() >= t for y in olds)

    return pd.Series([one(*r) for r in zip(new, old, least, strict=True)], dtype=object)


def classify_followup(raw: Column, finish: Column, first: Column, system: Column, history: Column, pack: Pack = POLISH, least: float = 0.75) -> Column:
    """The rules of a first message without that on continuations, then repeated questions, then echoes of the last answer."""
    users = F.transform(F.filter(history, lambda m: m.role == "user"), lambda m: m.content)
    last = F.element_at(F.filter(history, lambda m: m.role == "assistant"), -1).content
    base = classify(raw, finish, first, system, pack, skip=("kontynuacja rozmowy",))
    return F.coalesce(base, F.when(repeats_question(raw, users, least), "powtórzenie pytania").when(F.arrays_overlap(shingles(raw), shingles(last)), "echo odpowiedzi"))


@F.pandas_udf(StringType())
def think_mode(seed: pd.Series, share: pd.Series) -> pd.Series:
    """on or off by a generator seeded from the row's seed: the same for the same seed and share."""
    from random import Random

    return pd.Series(["on" if Random(int(s) ^ 0x5EED).random() < p else "off" for s, p in zip(seed, share, strict=True)])
