"""Seeded order, samples, splits and copies. Orders follow a hash, so they hold whatever the partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.functions.text import hash_number, sha256


def seeded(seed: int, key: str) -> Column:
    return sha256(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def shuffled(df: DataFrame, seed: int, key: str = "id") -> DataFrame:
    return df.orderBy(seeded(seed, key), key)


def sample_exactly(df: DataFrame, n: int, seed: int, key: str = "id") -> DataFrame:
    """n rows without replacement; fails if there are fewer. Each task sends its n first rows at most."""
    if df.limit(n).count() < n:
        raise ValueError(f"fewer than {n} rows")
    return df.orderBy(seeded(seed, key), key).limit(n)


def half_even(x: float) -> int:
    return round(x)


def select_turns(df: DataFrame, n: int, seed: int, long_share: float, long_turns: int = 5, short_turns: int = 2, key: str = "id") -> DataFrame:
    """A sample whose first round(n * long_share) rows are to get long_turns, the others short_turns."""
    rank = F.row_number().over(Window.orderBy(seeded(seed, key), key))
    return sample_exactly(df, n, seed, key).withColumn("target_turns", F.when(rank <= half_even(n * long_share), long_turns).otherwise(short_turns))


def upsample(df: DataFrame, copies: int, condition: Column, key: str = "id") -> DataFrame:
    """Rows for which the condition holds so many times; the copies' keys end with #1, #2, ..."""
    n = F.when(F.coalesce(condition, F.lit(False)), F.lit(copies)).otherwise(F.lit(1))
    out = df.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1)))
    own = F.col(key).cast("string")
    return out.withColumn(key, F.when(F.col("_copy") == 0, own).otherwise(F.concat(own, F.lit("#"), F.col("_copy").cast("string")))).drop("_copy")


def split(key: str = "id", valid: float = 0.01) -> Column:
    """train or valid, by the hash of the key without its copy number."""
    parent = F.regexp_replace(F.col(key).cast("string"), F.lit(r"#\d+$"), F.lit(""))
    return F.when(hash_number(parent) < int(valid * (1 << 32)), "valid").otherwise("train")


def round_robin(df: DataFrame, shards: int, order: list[str]) -> DataFrame:
    """shard: the row's place in the order, modulo the number of shards.

    Places come from counts of blocks of a range-partitioned order: only the counts go to one task.
    """
    parts = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id()).withColumn("_in", F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33))
    parts = parts.persist()
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.groupBy("_part").agg(F.count("*").alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    return parts.join(F.broadcast(starts), "_part").withColumn("shard", F.pmod(F.col("_base") + F.col("_in"), F.lit(shards)).cast("int")).drop("_part", "_in", "_base")


def first_shards(shards: DataFrame, k: int) -> DataFrame:
    """The k first training shards by prefix, and all validation shards."""
    train = shards.filter("split = 'train'").orderBy("prefix").limit(k)
    return train.unionByName(shards.filter("split <> 'train'"))
