"""Counts and summaries; ties in a top list go by the name."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.functions.stats import exclusive_quantiles


def counts(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("n"))


def most_common(df: DataFrame, by: str, n: int = 12) -> DataFrame:
    return counts(df.filter(F.col(by).isNotNull()), by).orderBy(F.desc("n"), by).limit(n)


def over(df: DataFrame, value: str, limits: tuple[int, ...] = (2048, 4096, 8192)) -> DataFrame:
    return df.agg(*(F.count_if(F.col(value) > x).alias(f"over_{x}") for x in limits))


def boxed(df: DataFrame, order: list[str]) -> DataFrame:
    """line: a small table as text in a box, in order; numbers to the right, names and other values to the left.

    Widths are one aggregate; the lines are made in the JVM.  For reports: all rows are sorted in one task.
    """
    kinds = dict(df.dtypes)
    shown = df.select(*order, *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"_{c}") for c in df.columns))
    wide = df.agg(*(F.greatest(F.lit(len(c)), F.coalesce(F.max(F.length(F.col(c).cast("string"))), F.lit(0))).alias(f"w_{c}") for c in df.columns))
    number = lambda c: kinds[c] in ("int", "bigint", "double", "float", "smallint", "tinyint") or kinds[c].startswith("decimal")

    def bar(left: str, between: str, right: str):
        cells = [F.repeat(F.lit("─"), F.col(f"w_{c}") + 2) for c in df.columns]
        return F.concat(F.lit(left), F.concat_ws(between, *cells), F.lit(right))

    def row(cell):
        padded = [(F.lpad if number(c) else F.rpad)(cell(c), F.col(f"w_{c}"), F.lit(" ")) for c in df.columns]
        return F.concat(F.lit("│ "), F.concat_ws(" │ ", *padded), F.lit(" │"))

    head = wide.select(F.posexplode(F.array(bar("┌", "┬", "┐"), row(lambda c: F.lit(c)), bar("├", "┼", "┤"))).alias("pos", "line")).select(F.lit(0).alias("part"), F.col("pos").alias("n"), "line")
    body = shown.withColumn("n", F.row_number().over(Window.orderBy(*order))).join(F.broadcast(wide)).select(F.lit(1).alias("part"), "n", row(lambda c: F.col(f"_{c}")).alias("line"))  # one row of widths
    foot = wide.select(F.lit(2).alias("part"), F.lit(0).alias("n"), bar("└", "┴", "┘").alias("line"))
    return head.unionByName(body).unionByName(foot).orderBy("part", "n").select("line")


def length_summary(df: DataFrame, values: list[str]) -> DataFrame:
    """component, total, mean, median, p95, p99, most of each column of numbers (exclusive quantiles)."""
    long = df.select(F.explode(F.array(*(F.struct(F.lit(v).alias("component"), F.col(v).cast("long").alias("n")) for v in values))).alias("x")).select("x.*").filter("n is not null")
    sums = long.groupBy("component").agg(F.sum("n").alias("total"), F.avg("n").alias("mean"), F.max("n").alias("most"))
    return sums.join(exclusive_quantiles(long, "n", {"median": Fraction(1, 2), "p95": Fraction(19, 20), "p99": Fraction(99, 100)}, ("component",)), "component")


def latencies(df: DataFrame, values: tuple[str, ...] = ("ttft", "latency"), by: tuple[str, ...] = ()) -> DataFrame:
    """value, p50 and p95 of each column (exclusive quantiles), for each group; nulls do not count."""
    long = df.select(*by, F.explode(F.array(*(F.struct(F.lit(v).alias("value"), F.col(v).cast("double").alias("n")) for v in values))).alias("x")).select(*by, "x.*")
    return exclusive_quantiles(long, "n", {"p50": Fraction(1, 2), "p95": Fraction(19, 20)}, (*by, "value"))


def progress(df: DataFrame, instance: str = "url", seconds: str = "latency", total: int = 0) -> DataFrame:
    """For each instance its requests, its seconds, and its share of what is left until `total` requests."""
    own = df.groupBy(instance).agg(F.count("*").alias("requests"), F.sum(seconds).alias("seconds"))
    all_ = own.agg(F.sum("requests").alias("_all"))
    left = F.greatest(F.lit(total) - F.col("_all"), F.lit(0))
    return own.join(F.broadcast(all_)).withColumn("eta_seconds", left / F.col("_all") * F.col("seconds")).drop("_all")  # one row of totals


def script_share(df: DataFrame, letters: str = "ąćęłńóśźżĄĆĘŁŃÓŚŹŻ", text: str = "text", by: tuple[str, ...] = ("model", "variant")) -> DataFrame:
    """share: for each group the mean over paragraphs of the part of characters that are letters of a language's own."""
    parts = df.select(*by, F.explode(F.split(text, r"\n\s*\n", -1)).alias("p")).filter("p <> ''")
    own = F.length("p") - F.length(F.translate("p", letters, ""))
    return parts.groupBy(*by).agg(F.avg(own / F.length("p")).alias("share"), F.count("*").alias("paragraphs"))


def percent(part: str, whole: str):
    return F.format_string("%d (%.1f%%)", F.col(part), 100.0 * F.col(part) / F.col(whole))
