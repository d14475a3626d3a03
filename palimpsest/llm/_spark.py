"""Spark helpers of this subpackage: row keys, written intermediate tables, fixed-size membership filters."""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bits of a membership filter: FILTER_RATIO for each value up to FILTER_MOST (32 MiB), then fewer.  What passes it is
#: always joined or counted exactly, so a fuller filter only lets more rows pass to that.
FILTER_RATIO, FILTER_LEAST, FILTER_MOST = 16, 1 << 20, 1 << 28
_BUCKET_BITS = 1 << 15


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Only a session whose executors are its driver may lack it; it gets a folder in its warehouse.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d is None:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = f"{spark.conf.get('spark.sql.warehouse.dir')}/checkpoints"
    return d.rstrip("/")


def written(df: DataFrame) -> DataFrame:
    """df as a Parquet table in the shared folder: cuts the lineage, and lost executors cost no recomputation."""
    path = f"{shared_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def keyed(docs: DataFrame, *cols: str) -> DataFrame:
    """doc_id, text and the named columns, with a 128-bit row key k1, k2 of doc_id and text, never null.

    Rows that agree in doc_id and text get one key; what is found for a key then holds for each of them.
    """
    return docs.select("doc_id", "text", *cols, F.xxhash64("doc_id").alias("k1"), F.xxhash64("text", "doc_id").alias("k2"))


def membership(hashes: DataFrame, col: str) -> bytes:
    """A bitmap with a bit for each value of the column (by its low bits) of a written table, sized by their number.

    It is aggregated on the executors; the driver gets FILTER_MOST / 8 bytes at most, whatever the input.
    """
    bits = FILTER_LEAST
    n = hashes.count()
    while bits < FILTER_MOST and bits < FILTER_RATIO * n:
        bits *= 2
    low = hashes.select((F.col(col).bitwiseAND(F.lit(bits - 1)) + 1).alias("b"))  # Spark counts from 1
    blocks = low.groupBy(F.expr("bitmap_bucket_number(b)").alias("n")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(b))").alias("bits"))
    out = np.zeros(bits // 8, np.uint8)
    for k, own in blocks.toLocalIterator():
        own = np.frombuffer(bytes(own), np.uint8)
        at = (k - 1) * _BUCKET_BITS // 8
        out[at : at + len(own)] |= own
    return out.tobytes()


def may_hold(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes (uint64) the bitmap may hold; for place and bit it follows Spark's bitmap functions."""
    low = hashes & np.uint64(8 * len(bitmap) - 1)
    return (bitmap[(low >> np.uint64(3)).astype(np.int64)] >> (low & np.uint64(7)).astype(np.uint8)) & np.uint8(1) == 1


#: Rows of a small table (a few kilobytes each) that go to every executor at most.
SEND_ROWS = 10_000


def small(df: DataFrame) -> DataFrame:
    """df (a written table) marked to be broadcast, if it is small by count; a larger one is left to a shuffled join."""
    return F.broadcast(df) if df.limit(SEND_ROWS + 1).count() <= SEND_ROWS else df


def sha(col: Column) -> Column:
    return F.sha2(col.cast("binary"), 256)


def whole_rows(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """docs joined (semi or anti) with k1, k2 of keys; all columns of docs, whatever their names.

    A bitmap of the keys rules out the rows that have no match where they are read; only the others are shuffled and joined.
    """
    own = written(keys.select(F.col("k1").alias("_a"), F.col("k2").alias("_b")).distinct())
    shared = docs.sparkSession.sparkContext.broadcast(membership(own, "_b"))

    @F.pandas_udf("boolean")
    def maybe(k: pd.Series) -> pd.Series:
        return pd.Series(may_hold(np.frombuffer(shared.value, np.uint8), k.to_numpy().view(np.uint64)))

    rows = docs.select(F.struct("*").alias("_row"), F.xxhash64("doc_id").alias("_k1"), F.xxhash64("text", "doc_id").alias("_k2")).withColumn("_maybe", maybe("_k2"))
    near = rows.filter("_maybe").join(own, (F.col("_k1") == F.col("_a")) & (F.col("_k2") == F.col("_b")), how).select("_row.*")
    return near if how == "left_semi" else near.unionByName(rows.filter("not _maybe").select("_row.*"))
