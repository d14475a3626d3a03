"""Token counts by a compiled finite-state tokenizer."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm._bpe import transducer
from palimpsest.llm._spark import load

VOCABULARY = "byte_bpe_50k.json"
SCHEMA = "n_tokens long"


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def token_counts(docs: DataFrame, path: str, limit: int = 512, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns, n_bytes, n_tokens and over_limit (n_tokens > limit) of each row.

    Counts equal those of the tokenizers library for the byte-level BPE file at path (which every executor
    must have), without added tokens; special strings in a text count as the special token.  The texts of a
    batch are cut into lanes, whose state maps are composed by a prefix scan (see _bpe).  Rows are
    independent: no shuffle, memory bounded by a batch and its longest text.

    A null text counts as an empty one: no bytes, no tokens.  Repeated rows give repeated results; other columns
    are left alone; an empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = transducer(path)
        for batch in batches:
            texts = [x or "" for x in batch.column(batch.num_columns - 1).to_pylist()]
            n = pa.array(t.counts(texts), pa.int64())
            size = pa.array([len(x.encode()) for x in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], size, n], names=[*(f"_{k}" for k in range(len(keep))), "n_bytes", "n_tokens"])

    given = docs.select(*(F.col(c).alias(f"_{k}") for k, c in enumerate(keep)), F.col(text).alias("_text"))
    schema = ", ".join([*(f"_{k} {dict(docs.dtypes)[c]}" for k, c in enumerate(keep)), "n_bytes long", "n_tokens long"])
    out = given.mapInArrow(run, schema)
    return out.select(*(F.col(f"_{k}").alias(c) for k, c in enumerate(keep)), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def op9_transducer_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(load(spark, sf_dir, "documents"), vocabulary_path(VOCABULARY))
