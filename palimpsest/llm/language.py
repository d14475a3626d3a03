"""Language identification: each text as a mixture of languages."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm._spark import load
from palimpsest.llm._vec import LOWER, byte_values, chunks, gram_hash, prefix_hash

#: Buckets of hashed byte n-grams, their lengths, and labelled rows the model is fitted on for each language.
BUCKETS, GRAMS, FIT_ROWS = 1 << 15, (2, 3, 4), 1500
#: EM steps and additive smoothing.
STEPS, SMOOTHING = 12, 0.1
NO_LETTER = "und"


def gram_buckets(text: bytes) -> np.ndarray:
    """Buckets of the byte n-grams of a text with ASCII letters lower-cased and all other ASCII a blank, one more at each end."""
    own = np.frombuffer(b" " + text.translate(_FOLD) + b" ", np.uint8)
    c = prefix_hash(byte_values(own))
    return np.concatenate([gram_hash(c, k) for k in GRAMS]).astype(np.uint32) % np.uint32(BUCKETS)


_FOLD = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in LOWER)


class Model:
    """log P(bucket | language), languages in order of name."""

    def __init__(self, names: list[str], counts: np.ndarray):
        p = counts + SMOOTHING
        self.names, self.log = names, np.log(p / p.sum(1, keepdims=True)).astype(np.float64).T.copy()

    def mixture(self, buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The languages of a text (numbers) and their proportions.

        EM over all languages first; then the language with the least proportion is left out as long as the
        penalised likelihood (log-likelihood less half of log n for each language) does not fall.
        """
        which, n = np.unique(buckets, return_counts=True)
        log = self.log[which]
        likelihood = np.exp(log - log.max(1, keepdims=True))
        n = n.astype(float)
        total = n.sum()
        own = np.arange(len(self.names))

        def fit(p: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, float]:
            for _ in range(STEPS):
                share = share * (p.T @ (n / np.maximum(p @ share, 1e-300))) / total
                share = share / share.sum()
            return share, float(n @ np.log(np.maximum(p @ share, 1e-300)))

        share, best = fit(likelihood, np.full(len(own), 1 / len(own)))
        penalty = np.log(max(total, 2)) / 2
        while len(own) > 1:
            keep = np.delete(np.arange(len(own)), share.argmin())
            rest = share[keep] if share[keep].sum() > 0 else np.ones(len(keep))
            less, value = fit(likelihood[:, own[keep]], rest / rest.sum())
            if value + penalty < best:
                break
            own, share, best = own[keep], less, value
        return own, share


def fit_model(docs: DataFrame, rows: int = FIT_ROWS) -> Model | None:
    """From about `rows` labelled rows of each language, drawn by the hash of doc_id (a language with few is used whole).

    Each language's sample is taken from a Bernoulli draw by that hash, so no sort of all rows is needed; the
    draw's rate follows from the language's count.  Counts add up in the JVM, bucket by bucket; the driver gets the model: the buckets
    of each language that occur, which grow with the number of languages, not of rows.
    """
    labelled = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = labelled.groupBy("lang").count().select(F.col("lang").alias("_lang"), (rows / F.col("count")).alias("rate"))
    draw = F.pmod(F.xxhash64(F.lit("fit"), "doc_id"), F.lit(1 << 30)) / (1 << 30)
    sample = labelled.select("lang", "text", draw.alias("draw")).join(F.broadcast(sizes), F.col("lang") == F.col("_lang")).filter("draw < rate").select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(0).cast(pa.string()).to_pylist()
            for first, texts in chunks(batch.column(1)):
                found: dict[str, list[np.ndarray]] = {}
                for lang, text in zip(langs[first : first + len(texts)], texts, strict=True):
                    found.setdefault(lang, []).append(gram_buckets(text))
                for lang, grams in found.items():
                    bucket, n = np.unique(np.concatenate(grams), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(bucket)), pa.array(bucket.astype(np.int32)), pa.array(n.astype(np.int64))], names=["lang", "bucket", "n"])

    got = sample.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    if not len(got):
        return None
    names = sorted(got["lang"].unique())
    counts = np.zeros((len(names), BUCKETS))
    counts[got["lang"].map({x: i for i, x in enumerate(names)}).to_numpy(), got["bucket"].to_numpy()] = got["n"]
    return Model(names, counts)


def training(col: str = "doc_id"):
    """Whether a row may be learned from: crc32 of doc_id as text, modulo 3, is not 1."""
    return F.coalesce(F.crc32(F.col(col).cast("string").cast("binary")) % 3 != 1, F.lit(False))


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred (the language with the largest share), score (its share), languages and shares of each text.

    A text that is null or has no letter, or any text if there is no model: `und`, score 0, no languages.  Ties
    in share go to the first name.  Rows are independent (no shuffle); repeated rows give repeated results,
    other columns are ignored, an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            name, score, names, shares = [], [], [], []
            letter = batch.column(2).to_pylist()
            for first, texts in chunks(batch.column(1)):
                for k, text in enumerate(texts, first):
                    buckets = gram_buckets(text) if model and letter[k] else ()
                    if not len(buckets):
                        for column, value in ((name, NO_LETTER), (score, 0.0), (names, []), (shares, [])):
                            column.append(value)
                        continue
                    own, share = model.mixture(buckets)
                    best = share.argmax()
                    name.append(model.names[own[best]])
                    score.append(float(min(1, share[best])))
                    names.append([model.names[i] for i in own])
                    shares.append(share.tolist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(name, pa.string()), pa.array(score, pa.float64()), pa.array(names, pa.list_(pa.string())), pa.array(shares, pa.list_(pa.float64()))], names=["doc_id", "lang_pred", "score", "languages", "shares"])

    given = docs.select("doc_id", "text", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letter"))
    return given.mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, lang_pred string, score double, languages array<string>, shares array<double>")


def held_out(doc_id: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


def op5_mixture_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    found = identify(docs, fit_model(docs.filter(training())))
    out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    return found.select("doc_id", out.alias("held_out"), "lang_pred", "score", "languages", "shares")
