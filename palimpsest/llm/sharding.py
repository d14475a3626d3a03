"""Shards whose mixture of sources is that of the whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from palimpsest.llm._spark import load, written

#: Blocks into which the hash orders each source, and the fractional ranks the table. Fixed: a window sorts
#: one block, so a hot source is spread over BLOCKS tasks.
BLOCKS = 4096


def stratified_interleave(docs: DataFrame, shards: int = 16, seed: int = 17, stratum: str = "source") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of each row: law `rows`, every shard the table's mixture.

    Rows are ranked within each source in the order of a seeded hash of doc_id; the fractional rank
    (2 * rank - 1) / (2 * rows of the source) orders the whole table, which is cut into shards whose counts
    differ by one at most.  Neither rank needs one task for a source or for the table: both count blocks of
    the order first (a few rows each) and number rows inside a block only.

    Ties in the hash (repeated doc_id) are broken by size and text_crc32; rows equal in these are
    interchangeable.  A null source is a source of its own; a null doc_id hashes as the empty string; a null
    text has size 1 and crc 0.  Other columns are ignored; an empty table gives an empty result.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.when(F.col(stratum).isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col(stratum).cast("string"))).alias("stratum"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary")).alias("rnd"),
    ).withColumn("block", F.conv(F.substring("rnd", 1, 3), 16, 10).cast("int"))
    blocks = base.groupBy("stratum", "block").count()
    before = Window.partitionBy("stratum").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("stratum", "block", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"), F.sum("count").over(Window.partitionBy("stratum")).alias("n"))
    own = Window.partitionBy("stratum", "block").orderBy("rnd", "doc_id", "size", "text_crc32")
    ranked = base.withColumn("rank", F.row_number().over(own)).join(starts, ["stratum", "block"])
    ranked = ranked.withColumn("frac", (2 * (F.col("rank") + F.col("base")) - 1) / (2 * F.col("n"))).drop("rank", "base", "n", "block")
    ranked = written(ranked.withColumn("block", F.floor(F.col("frac") * BLOCKS).cast("int")))

    every = ranked.groupBy("block").count()  # BLOCKS rows at most
    up_to = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = every.select("block", F.coalesce(F.sum("count").over(up_to), F.lit(0)).alias("base"), F.sum("count").over(Window.partitionBy()).alias("n"))
    own = Window.partitionBy("block").orderBy("frac", "stratum", "rnd", "doc_id", "size", "text_crc32")
    placed = ranked.withColumn("rank", F.row_number().over(own)).join(F.broadcast(starts), "block").withColumn("pos", F.col("base") + F.col("rank") - 1)
    shard = F.expr(f"pos * {shards} div n")
    slot = F.expr(f"pos - (pos * {shards} div n * n + {shards - 1}) div {shards}")
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), shard.cast("int").alias("shard"), slot.alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op8_stratified_interleave(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stratified_interleave(load(spark, sf_dir, "documents"))


#: CRC-32 in SQL: the reflected polynomial's table, then a fold over the bytes.
ORACLE = """
WITH RECURSIVE bits AS (
  SELECT range AS i, range::BIGINT AS v, 0 AS k FROM range(256)
  UNION ALL
  SELECT i, CASE WHEN v & 1 = 1 THEN xor(3988292384, v >> 1) ELSE v >> 1 END, k + 1 FROM bits WHERE k < 8
), crc AS (SELECT list(v ORDER BY i) AS t FROM bits WHERE k = 8),
base AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, md5('17:' || coalesce(doc_id::VARCHAR, '')) AS rnd,
         CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END AS stratum
  FROM documents
), sized AS (
  SELECT doc_id, rnd, stratum, length(h) // 2 + 1 AS size,
         xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(h) // 2 + 1), lambda i: ('0x' || substr(h, 2 * i::INT - 1, 2))::BIGINT)),
             lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]))) AS crc
  FROM base, crc
), fractional AS (
  SELECT *, (2 * row_number() OVER (PARTITION BY stratum ORDER BY rnd, doc_id, size, crc) - 1)::DOUBLE / (2 * count(*) OVER (PARTITION BY stratum))::DOUBLE AS frac FROM sized
), placed AS (
  SELECT *, row_number() OVER (ORDER BY frac, stratum, rnd, doc_id, size, crc) - 1 AS pos, count(*) OVER () AS n FROM fractional
)
SELECT doc_id, size::BIGINT AS size, crc::BIGINT AS text_crc32, 'rows' AS law, (pos * 16 // n)::INT AS shard,
       (pos - (pos * 16 // n * n + 15) // 16)::BIGINT AS slot, NULL::INT AS grown_shard
FROM placed
"""
