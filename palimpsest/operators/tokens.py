"""Token shards: balanced chunks, batches by budget, and distribution statistics that add up over chunks."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.functions.stats import bucket_entropy, mass, pattern_mask
from palimpsest.functions.text import col

# Fixed value: the tokens of an empty think block.
THINK_OFF = [31981, 1531, 11141, 31977, 31981, 31965, 1531, 11141, 31977, 17]
MANIFEST_FORMAT = "poziomka-sft-v2"


def chunk_bounds(records: DataFrame, chunks: int, tokens: str = "tokens", order: str = "id") -> DataFrame:
    """order, tokens, chunk: a record's chunk, so that chunks hold about equal tokens and keep the order.

    A record goes to the first chunk whose target (an equal share of all tokens) its start does not reach.
    Starts come from sums of range partitions: only these sums go to one task.
    """
    parts = records.select(order, F.col(tokens).cast("long").alias("tokens")).repartitionByRange(order).sortWithinPartitions(order).withColumn("_part", F.spark_partition_id())
    sums = parts.groupBy("_part").agg(F.sum("tokens").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"), F.sum("_n").over(Window.partitionBy()).alias("_all"))
    own = Window.partitionBy("_part").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    placed = parts.withColumn("_in", F.coalesce(F.sum("tokens").over(own), F.lit(0))).join(F.broadcast(starts), "_part")
    # chunk k begins at the first record whose start is not below k / chunks of all tokens
    chunk = F.expr(f"least({chunks - 1}, (_base + _in) * {chunks} div greatest(_all, 1))")
    return placed.select(order, "tokens", chunk.cast("int").alias("chunk"))


def greedy_batches(records: DataFrame, budget: int, group: str, order: str, tokens: str = "tokens") -> DataFrame:
    """batch: number of the batch in its group; records follow in order until the next would pass the budget.

    A record counts its tokens but the last. The fold depends on order, so each group (a chunk) is one task's work.
    """

    def fold(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(order)
        out, used, batch, empty = [], 0, 0, True
        for n in frame["tokens"] - 1:
            if not empty and used + n > budget:
                batch, used = batch + 1, 0
            used, empty = used + n, False
            out.append(batch)
        return frame.assign(batch=out)

    given = records.select(group, order, F.col(tokens).cast("long").alias("tokens"))
    types = dict(given.dtypes)
    return given.groupBy(group).applyInPandas(fold, f"{group} {types[group]}, {order} {types[order]}, tokens long, batch long")


def kd_mask(targets: Column | str, masks: Column | str) -> Column:
    """Positions that count for distillation: those with a mask, outside the empty think block."""
    return F.zip_with(col(masks), pattern_mask(targets, THINK_OFF), lambda m, t: (m > 0) & ~t)


def topk_stats(positions: DataFrame, logp: str = "logp", target_logp: str = "target_logp", hit: str = "top1_hit", by: tuple[str, ...] = ()) -> DataFrame:
    """Additive sums over positions: they may be made for any chunks and added."""
    m, h = mass(logp), bucket_entropy(logp)
    top = F.exp(F.get(F.col(logp), 0).cast("double"))
    return positions.groupBy(*by).agg(
        F.count("*").alias("positions"), F.sum(-F.col(target_logp)).alias("nll_sum"), F.sum(F.col(hit).cast("int")).alias("top1_sum"),
        F.sum(m).alias("mass_sum"), F.min(m).alias("mass_min"), F.sum(h).alias("entropy_sum"), F.sum(top).alias("confidence_sum"),
    )


def finalize_topk(chunks: DataFrame, shards: DataFrame) -> DataFrame:
    """Totals and ratios of all chunks; fails unless they cover the shards with one model, k and cache."""
    t = chunks.agg(*(F.sum(c).alias(c) for c in ("records", "positions", "nll_sum", "top1_sum", "mass_sum", "entropy_sum", "confidence_sum")), F.min("mass_min").alias("mass_min"), *(F.count_distinct(c).alias(f"n_{c}") for c in ("k", "model", "cache")))
    s = shards.agg(F.sum("records").alias("want_records"), (F.sum("tokens") - F.sum("records")).alias("want_positions"))
    both = t.join(F.broadcast(s))  # one row each
    ok = (F.col("records") == F.col("want_records")) & (F.col("positions") == F.col("want_positions")) & (F.col("n_k") == 1) & (F.col("n_model") == 1) & (F.col("n_cache") == 1)
    both = both.withColumn("complete", F.when(F.coalesce(ok, F.lit(False)), True).otherwise(F.raise_error(F.lit("chunks do not make up the shards")).cast("boolean")))
    n = F.col("positions")
    return both.select("records", "positions", (F.col("nll_sum") / n).alias("nll"), (F.col("top1_sum") / n).alias("top1_rate"), (F.col("mass_sum") / n).alias("mass"), "mass_min", (F.col("entropy_sum") / n).alias("entropy"), (F.col("confidence_sum") / n).alias("confidence"), "complete")


def shard_totals(shards: DataFrame) -> DataFrame:
    """For each split the sums of shards, records, tokens and positions."""
    return shards.groupBy("split").agg(F.count("*").alias("shards"), F.sum("records").alias("records"), F.sum("tokens").alias("tokens"), (F.sum("tokens") - F.sum("records")).alias("positions"))


def after_first(tokens: Column | str, marker: int) -> Column:
    """The token after the marker's first occurrence, or null."""
    at = F.array_position(col(tokens), marker)
    return F.when(at > 0, F.get(col(tokens), at.cast("int")))


def iterations(bins: int, batch: int, eval_batches: int = 0) -> int:
    """Steps of one epoch over packed bins; fails if evaluation needs more bins than there are."""
    if eval_batches * batch > bins:
        raise ValueError("evaluation needs more bins than there are")
    return -(-bins // batch)


def concatenated(records: DataFrame, group: str, order: str, tokens: str = "tokens") -> DataFrame:
    """group, tokens, positions, records: the records of each group (a batch, bounded by its budget) end to end, positions from 0 in each."""
    parts = F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), F.col(tokens).alias("t"))))
    own = records.groupBy(group).agg(parts.alias("p"))
    places = F.flatten(F.transform("p", lambda x: F.when(F.size(x.t) > 0, F.sequence(F.lit(0), F.size(x.t) - 1)).otherwise(F.array().cast("array<int>"))))
    return own.select(group, F.flatten(F.transform("p", lambda x: x.t)).alias("tokens"), places.alias("positions"), F.size("p").alias("records"))


def checked_iterations(totals: DataFrame, expected: int, bins: int, batch: int, eval_batches: int = 0) -> int:
    """iterations, after the totals' records (one row) have been found to be as many as expected (0: not checked)."""
    have = totals.agg(F.sum("records")).first()[0] or 0
    if expected and have != expected:
        raise ValueError(f"{have} records, not {expected}")
    return iterations(bins, batch, eval_batches)
