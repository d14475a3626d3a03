"""Which of several attempts at one job counts: named policies, each an order in one aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

POLICIES = ("last_good_else_first_error", "last_ok_else_first", "first_good_else_last_error", "first_ok_else_last_reject_else_first_error")


def _order(policy: str, ok: Column, error: Column, seq: Column) -> Column:
    """The attempt with the largest value counts."""
    if policy == "last_good_else_first_error":
        return F.struct(F.when(error, 0).otherwise(1), F.when(error, -seq).otherwise(seq))
    if policy == "last_ok_else_first":
        return F.struct(F.when(ok, 1).otherwise(0), F.when(ok, seq).otherwise(-seq))
    if policy == "first_good_else_last_error":
        return F.struct(F.when(error, 0).otherwise(1), F.when(error, seq).otherwise(-seq))
    if policy == "first_ok_else_last_reject_else_first_error":
        return F.struct(F.when(ok, 2).when(error, 0).otherwise(1), F.when(ok | error, -seq).otherwise(seq))
    raise ValueError(f"unknown policy {policy}")


def resolve_attempts(df: DataFrame, key: str, seq: str, policy: str, ok: Column | None = None, error: Column | None = None) -> DataFrame:
    """One row for each key, by the policy; attempts of a key are combined before the shuffle."""
    ok = F.coalesce(F.col("ok") if ok is None else ok, F.lit(False))
    error = F.coalesce((F.col("finish") == "error") if error is None else error, F.lit(False))
    best = F.max_by(F.struct(*(F.col(c) for c in df.columns)), _order(policy, ok, error, F.col(seq).cast("long")))
    return df.groupBy(F.col(key).alias("_key")).agg(best.alias("_row")).select("_row.*")


def resume(jobs: DataFrame, done: DataFrame, key: str = "id", finish: str = "finish") -> DataFrame:
    """Jobs without a finished attempt; errors do not count as finished."""
    return jobs.join(done.filter(F.coalesce(F.col(finish) != "error", F.lit(True))).select(key), key, "left_anti")


def resume_counting(jobs: DataFrame, tries: DataFrame, most_rejects: int, key: str = "id", only_rejected: bool = False) -> DataFrame:
    """Jobs that are not accepted and have at most so many rejected tries, with `attempt`, the number of these."""
    own = tries.groupBy(key).agg(F.max(F.coalesce("ok", F.lit(False))).alias("_ok"), F.count_if(~F.coalesce("ok", F.lit(False)) & F.coalesce(F.col("finish") != "error", F.lit(True))).alias("_n"))
    out = jobs.join(own, key, "left").withColumn("attempt", F.coalesce("_n", F.lit(0)))
    out = out.filter(~F.coalesce("_ok", F.lit(False)) & (F.col("attempt") <= most_rejects))
    return (out.filter("attempt > 0") if only_rejected else out).drop("_ok", "_n")
