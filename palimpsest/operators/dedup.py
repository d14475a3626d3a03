"""Exact and normalized deduplication with input priority, and what each input contributed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.functions.text import basename, normalize, sha256


def first_by(df: DataFrame, key: Column, order: list[Column | str]) -> DataFrame:
    """The first row of each key in the order; copies are combined in the map tasks, so hot keys do not gather."""
    best = F.min_by(F.struct(*(F.col(c) for c in df.columns)), F.struct(*order))
    return df.groupBy(key.alias("_key")).agg(best.alias("_row")).select("_row.*")


def dedup_normalized(df: DataFrame, text: str = "raw", key: str = "id") -> DataFrame:
    """One row for each normalized text: the lowest key."""
    return first_by(df, normalize(text), [key])


def accept_summary(rows: DataFrame, ok: Column, suspect: Column, text: str = "raw") -> DataFrame:
    """total, ok, suspects (among the ok), kept (one ok row for each normalized text), duplicates (the other ok rows).

    One pass: texts are judged once, and only hashes of the normalized ones are shuffled.
    """
    judged = rows.select(ok.alias("ok"), F.col(text).alias("_text"), suspect.alias("_suspect"))
    each = judged.select("ok", F.when(F.col("ok"), sha256(normalize("_text"))).alias("_key"), (F.col("ok") & F.col("_suspect")).alias("_suspect"))
    own = each.groupBy("ok", "_key").agg(F.count("*").alias("n"), F.count_if("_suspect").alias("s"))
    sums = {"total": F.sum("n"), "ok": F.sum(F.when(F.col("ok"), F.col("n"))), "suspects": F.sum("s"), "kept": F.count_if("ok")}
    out = own.agg(*(F.coalesce(x, F.lit(0)).alias(c) for c, x in sums.items()))
    return out.withColumn("duplicates", F.col("ok") - F.col("kept"))


def dedup_exact(df: DataFrame, text: str, order: list[Column | str]) -> DataFrame:
    return first_by(df, F.col(text), order)


def union_prioritized(inputs: dict[str, DataFrame] | list[tuple[str, DataFrame]]) -> DataFrame:
    """All rows of the inputs, with source and priority (the place in the given order); missing columns are null.

    Names may repeat: inputs of one name are still inputs of their own.
    """
    own = [df.withColumns({"source": F.lit(name), "priority": F.lit(i)}) for i, (name, df) in enumerate(inputs.items() if isinstance(inputs, dict) else inputs)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), own)


def merge_questions(rows: DataFrame, text: str = "raw", seq: str = "id") -> DataFrame:
    """Accepted rows, one for each text (first input, then first row): id becomes the text's SHA-256, the old id source_id."""
    accepted = F.coalesce(F.col("verdict"), F.when(F.coalesce("ok", F.lit(False)), "ok").otherwise("")) == "ok" if "verdict" in rows.columns else F.coalesce("ok", F.lit(False))
    kept = first_by(rows.filter(accepted), F.col(text), ["priority", seq])
    return kept.withColumns({"source_id": F.col("id").cast("string"), "id": sha256(text)})


def merge_conversations(rows: DataFrame, seq: str = "seq") -> DataFrame:
    """Conversations, one for each first user text (first input, then first row); id is that text's SHA-256.

    source_id goes, and a model's path in meta is cut to its last part.
    """
    user = F.get(F.filter("messages", lambda m: m.role == "user"), 0).content
    given = rows.drop("source_id").withColumn("id", sha256(user))
    if "model" in rows.select("meta.*").columns:
        given = given.withColumn("meta", F.col("meta").withField("model", basename("meta.model")))
    return first_by(given, F.col("id"), ["priority", seq])


def contribution(rows: DataFrame, kept: DataFrame, source: str = "source") -> DataFrame:
    """For each source its rows, those kept, and those that were duplicates."""
    n = rows.groupBy(source).agg(F.count("*").alias("rows"))
    k = kept.groupBy(source).agg(F.count("*").alias("kept"))
    return n.join(k, source, "left").select(source, "rows", F.coalesce("kept", F.lit(0)).alias("kept"), (F.col("rows") - F.coalesce("kept", F.lit(0))).alias("duplicates"))
