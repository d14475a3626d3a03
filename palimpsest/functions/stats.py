"""Statistics that differ from Spark's own: exclusive quantiles, and distributions over top-k log-probabilities."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.functions.text import col


def exclusive_quantiles(df: DataFrame, value: str, cuts: dict[str, Fraction], by: tuple[str, ...] = ()) -> DataFrame:
    """Quantiles with the exclusive method (they may lie beyond the extremes), one row for each group.

    Only the counts of distinct values are ranked, so a group of any size is a few sums: values are combined
    before the shuffle, and the rows that a cut needs are picked by cumulative count.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("_n"))
    own = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    run = own.orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.withColumn("_hi", F.sum("_n").over(run)).withColumn("_all", F.sum("_n").over(own)).withColumn("_lo", F.col("_hi") - F.col("_n"))
    out = []
    for name, q in cuts.items():
        i, m = q.numerator, q.denominator
        j = F.greatest(F.lit(1), F.least(F.floor(F.lit(i) * (F.col("_all") + 1) / m), F.col("_all") - 1))
        delta = F.lit(i) * (F.col("_all") + 1) - j * m
        at = lambda k: F.max(F.when((F.col("_lo") < k) & (k <= F.col("_hi")), F.col(value).cast("double")))
        out.append(F.when(F.max("_all") == 1, F.max(F.col(value).cast("double"))).otherwise((at(j) * F.max(m - delta) + at(j + 1) * F.max(delta)) / m).alias(name))
    return ranked.groupBy(*by).agg(*out)


def rounded(x: Column | str, places: int = 4) -> Column:
    """Half-even rounding on the decimal value that the number shows; exact for values on that grid."""
    return F.bround(col(x).cast("decimal(38,18)"), places).cast("double")


def mass(logp: Column | str) -> Column:
    return F.aggregate(col(logp), F.lit(0.0), lambda a, x: a + F.exp(x.cast("double")))


def bucket_entropy(logp: Column | str) -> Column:
    """Entropy of the top-k and one bucket for all the rest (its mass clipped to 0 and 1): a lower bound."""
    head = F.aggregate(col(logp), F.lit(0.0), lambda a, x: a - F.exp(x.cast("double")) * x.cast("double"))
    tail = F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1.0 - mass(logp)))
    return head - F.when(tail > 0, tail * F.log(tail)).otherwise(0.0)


def top_k(scores: Column | str, k: int) -> Column:
    """The k largest with their places: array of struct(logp, id), falling; equal scores by the lower place."""
    pairs = F.transform(col(scores), lambda x, i: F.struct((-x).alias("neg"), i.alias("id")))
    return F.transform(F.slice(F.sort_array(pairs), 1, k), lambda p: F.struct((-p.neg).alias("logp"), p.id.alias("id")))


def log_softmax(scores: Column | str) -> Column:
    most = F.array_max(col(scores)).cast("double")
    total = F.aggregate(col(scores), F.lit(0.0), lambda a, x: a + F.exp(x.cast("double") - F.array_max(col(scores)).cast("double")))
    shift = most + F.log(total)
    return F.get(F.transform(F.array(shift), lambda s: F.transform(col(scores), lambda x: x.cast("double") - s)), 0)


def pattern_mask(tokens: Column | str, pattern: list[int]) -> Column:
    """For each position whether it lies in an occurrence of the pattern."""
    t, n = col(tokens), len(pattern)
    want = F.array(*map(F.lit, pattern))
    starts = F.when(F.size(t) >= n, F.filter(F.sequence(F.lit(0), F.size(t) - n), lambda i: F.slice(t, i + 1, n) == want)).otherwise(F.array().cast("array<int>"))
    return F.get(F.transform(F.array(starts), lambda s: F.transform(t, lambda x, i: F.exists(s, lambda a: (i >= a) & (i < a + n)))), 0)
