"""The resumable producer as a stream: new job files in, answered rows out, progress by windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from palimpsest.operators.generate import ModelBackend, Settings, run_model


def job_stream(spark: SparkSession, path: str, schema: StructType | str, files: int = 16) -> DataFrame:
    """Each file of jobs is read once; the checkpoint remembers which."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).json(path)


def start(jobs: DataFrame, backend: ModelBackend, out: str, checkpoint: str, settings: Settings = Settings(), once: bool = True) -> StreamingQuery:
    """Answers to Parquet, exactly once: a restart goes on after the last committed batch."""
    writer = run_model(jobs, backend, settings).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if once else writer).start()


def speed(rows: DataFrame, ts: str = "ts", window: str = "300 seconds", slide: str = "60 seconds", late: str | None = None) -> DataFrame:
    """start, n and rows a second of each window; on a stream with a watermark if `late` is given."""
    given = rows.withWatermark(ts, late) if late else rows
    seconds = F.unix_timestamp(F.col("w.end").cast("timestamp")) - F.unix_timestamp(F.col("w.start").cast("timestamp"))
    return given.groupBy(F.window(ts, window, slide).alias("w")).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "n", (F.col("n") / seconds).alias("per_second"))
