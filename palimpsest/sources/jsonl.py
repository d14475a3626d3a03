"""JSON Lines sources and sinks with explicit order, priority and failure modes."""

from __future__ import annotations

import json
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from palimpsest.operators.dedup import union_prioritized


def read(spark: SparkSession, path: str | list[str], schema: StructType | str, limit: int = 0, strict: bool = True) -> DataFrame:
    """Rows with `seq`, their order: by file path, then by place in the file.

    Spark may read files in another order than their names'; seq says which row came first.  A broken line
    fails the read if strict, else it is a row of nulls.  A limit takes the first rows of that order.
    """
    df = spark.read.schema(schema).option("mode", "FAILFAST" if strict else "PERMISSIVE").json(path)
    names = df.columns
    df = df.select("*", F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")).alias("seq"))
    return df.orderBy("seq").limit(limit).select(*names, "seq") if limit else df


def read_prioritized(spark: SparkSession, paths: list[str], schema: StructType | str) -> DataFrame:
    """Several inputs; earlier ones have priority. source is the name of the folder of each."""
    return union_prioritized([(PurePosixPath(p).parent.name or p, read(spark, p, schema)) for p in paths])


def accepted(df: DataFrame) -> DataFrame:
    """Rows with verdict ok; where there is no verdict, rows that are ok."""
    own = F.when(F.coalesce("ok", F.lit(False)), "ok").otherwise("") if "ok" in df.columns else F.lit("")
    return df.filter((F.coalesce("verdict", own) if "verdict" in df.columns else own) == "ok")


def write(df: DataFrame, path: str, mode: str = "overwrite", keep_nulls: bool = True) -> None:
    """mode: overwrite, append, or errorifexists (which refuses an existing output). Committed as a whole."""
    out = df.drop("seq") if "seq" in df.columns else df
    out.write.mode(mode).option("ignoreNullFields", str(not keep_nulls).lower()).json(path)


def write_config(spark: SparkSession, path: str, values: dict) -> None:
    """A small JSON file beside a table, through Spark, so that any store will do."""
    spark.createDataFrame([(json.dumps(values, ensure_ascii=False, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_config(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).first()[0])


def pinned(spark: SparkSession, path: str, values: dict) -> dict:
    """The run's parameters: written once; a later run with others fails."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    if fs_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(fs_path):
        old = read_config(spark, path)
        if old != values:
            raise ValueError(f"the run was begun with {old}")
        return old
    write_config(spark, path, values)
    return values
