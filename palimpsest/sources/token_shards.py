"""Token shards: a manifest and, for each shard, binary columns of tokens, masks and offsets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.operators.tokens import MANIFEST_FORMAT


def manifest(spark: SparkSession, path: str, kind: str = MANIFEST_FORMAT) -> DataFrame:
    """The manifest's shards that hold records; another format fails."""
    df = spark.read.option("multiLine", True).json(path)
    found = df.select("format").first()[0]
    if found != kind:
        raise ValueError(f"format {found}, not {kind}")
    return df.select(F.explode("shards").alias("s")).select("s.*").filter("records > 0")


def records(spark: SparkSession, root: str, suffixes: tuple[str, str, str] = (".tokens.bin", ".masks.bin", ".offsets.bin")) -> DataFrame:
    """prefix (the path below root), record, tokens, masks of all shards under root; a task decodes one shard's three files.

    Tokens are unsigned 16-bit, masks unsigned 8-bit, offsets unsigned 64-bit, all little-endian.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    top = spark._jvm.org.apache.hadoop.fs.Path(root)
    base = top.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(top).toUri().getPath().rstrip("/") + "/"
    place = F.regexp_replace("path", F.lit(r"^[a-z0-9]+:(//[^/]*)?"), F.lit(""))
    name = F.when(F.startswith(place, F.lit(base)), F.substring(place, len(base) + 1, 1 << 20)).otherwise(place)
    own = files.select(name.alias("name"), "content")
    kind = prefix = F.lit(None).cast("string")
    for k, x in zip(("tokens", "masks", "offsets"), suffixes, strict=True):
        ends = F.endswith("name", F.lit(x))
        kind, prefix = F.when(ends, k).otherwise(kind), F.when(ends, F.substring(F.col("name"), F.lit(1), F.length("name") - len(x))).otherwise(prefix)
    own = own.select(prefix.alias("prefix"), kind.alias("kind"), "content").filter("kind is not null")
    shards = own.groupBy("prefix").agg(*(F.max(F.when(F.col("kind") == k, F.col("content"))).alias(k) for k in ("tokens", "masks", "offsets")))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for prefix, t, m, o in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                tokens, masks, offsets = np.frombuffer(t, "<u2").astype(np.int32), np.frombuffer(m, np.uint8).astype(np.int16), np.frombuffer(o, "<u8").astype(np.int64)
                for at in range(0, len(offsets) - 1, 1000):
                    cut = offsets[at : at + 1001]
                    lists = lambda v: pa.ListArray.from_arrays(pa.array((cut - cut[0]).astype(np.int32)), pa.array(v[cut[0] : cut[-1]]))  # noqa: E731, B023
                    n = len(cut) - 1
                    yield pa.RecordBatch.from_arrays([pa.array([prefix] * n), pa.array(np.arange(at, at + n)), lists(tokens), lists(masks)], names=["prefix", "record", "tokens", "masks"])

    return shards.mapInArrow(decode, "prefix string, record long, tokens array<int>, masks array<short>")


def write_topk(positions: DataFrame, path: str, k: int, chunk: str = "chunk") -> None:
    """Top-k rows (record, position, top: array of struct(logp, id)) as two arrays of exactly k, a folder for each chunk.

    Chunks own their rows: writing one again replaces only its folder.
    """
    fail = F.raise_error(F.lit(f"a position has other than {k} entries")).cast("array<struct<logp:double,id:int>>")
    top = F.when(F.size("top") == k, F.col("top").cast("array<struct<logp:double,id:int>>")).otherwise(fail)
    rows = positions.select(chunk, "record", "position", F.transform(top, lambda t: t.id.cast("int")).alias("ids"), F.transform(top, lambda t: t.logp.cast("float")).alias("logps"))
    rows.repartition(chunk, F.floor(F.col("record") / 4096)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(chunk).parquet(path)


def mark_done(metrics: DataFrame, path: str, chunk: str = "chunk") -> None:
    """Adds the metrics of finished chunks, a row each, to the table of markers."""
    metrics.write.mode("append").partitionBy(chunk).parquet(path)


def not_done(chunks: DataFrame, path: str, chunk: str = "chunk") -> DataFrame:
    """The chunks without a marker; all of them if there is no table of markers yet."""
    spark = chunks.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return chunks
    return chunks.join(spark.read.parquet(path).select(F.col(chunk).cast(dict(chunks.dtypes)[chunk]).alias(chunk)).distinct(), chunk, "left_anti")


def write_manifest(shards: DataFrame, path: str, kind: str = MANIFEST_FORMAT) -> None:
    """One JSON object: the format, totals of records and tokens, and the shards (prefix, split, records, tokens) by prefix."""
    one = shards.agg(F.sum("records").alias("records"), F.sum("tokens").alias("tokens"), F.sort_array(F.collect_list(F.struct("prefix", "split", "records", "tokens"))).alias("shards"))
    one.select(F.lit(kind).alias("format"), F.struct("records", "tokens").alias("totals"), "shards").coalesce(1).write.mode("overwrite").json(path)


def sub_cache(spark: SparkSession, root: str, shards: DataFrame) -> DataFrame:
    """The records of the given shards only, read where they are; nothing is copied."""
    return records(spark, root).join(shards.select("prefix"), "prefix", "left_semi")
