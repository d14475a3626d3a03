"""Packing of documents into training sequences by lexical retrieval."""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm._bpe import Transducer, transducer
from palimpsest.llm._spark import load, may_hold, membership, written
from palimpsest.llm.token_counts import VOCABULARY, vocabulary_path

LENGTH, END_ID = 1024, 0
#: Documents in one shard of the index (the last shard of a task has fewer); a shard ends early at SHARD_TOKENS.
SHARD_DOCS, SHARD_TOKENS = 512, 1 << 20
K1, B = 1.2, 0.75
#: Random signs of a term, steps of one in the sums of documents' sketches, and principal directions of all different texts that make a route.
SKETCH, STEPS, DIRECTIONS = 256, 256, 8
#: A term in one of so many documents of a shard or more has its weights in a dense row.
DENSE = 8


class Corpus:
    """Statistics of a collection: idf of each term and mean length, from document frequencies and totals."""

    def __init__(self, df: np.ndarray, n: int, tokens: int):
        """df: of every term, by its number."""
        self.idf = np.log1p((n - df + 0.5) / (df + 0.5))
        self.mean = max(tokens / max(n, 1), 1)

    @classmethod
    def of(cls, docs: list[np.ndarray], width: int = 0) -> Corpus:
        return cls(np.bincount(occurrences(docs)[1], minlength=width), len(docs), sum(map(len, docs)))

    def weights(self, term: np.ndarray, tf: np.ndarray, length: np.ndarray) -> np.ndarray:
        """BM25 weight of a term that occurs tf times in a document of that length."""
        return self.idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / self.mean))


def occurrences(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document, term and frequency of each term of each document, in this order, and the documents' lengths."""
    length = np.fromiter(map(len, docs), np.int64, len(docs))
    flat = np.concatenate(docs) if docs else np.zeros(0, np.uint32)
    kind, low = (np.uint32, 16) if len(docs) <= 1 << 16 and flat.max(initial=0) < 1 << 16 else (np.uint64, 32)
    key = (np.repeat(np.arange(len(docs), dtype=kind), length) << kind(low)) | flat.astype(kind)
    key.sort()
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
    tf, key = np.diff(first, append=len(key)), key[first].astype(np.int64)
    return key >> low, key & ((1 << low) - 1), tf, length


class Bm25:
    """Inverted index of one shard: for each term its documents and their BM25 weights in the whole collection."""

    def __init__(self, docs: list[np.ndarray], corpus: Corpus):
        self.n = len(docs)
        doc, term, tf, length = occurrences(docs)
        o = np.argsort(term.astype(np.uint16) if len(corpus.idf) <= 1 << 16 else term, kind="stable")
        self.doc = doc[o]
        self.weight = corpus.weights(term[o], tf[o], length[self.doc])
        first = np.flatnonzero(np.diff(term[o], prepend=-1))
        df = np.diff(np.append(first, len(term)))
        # postings of a document's terms: by document, the numbers of its terms' postings
        self.first, self.df = first, df
        self.terms = np.empty(len(term), np.int64)
        self.terms[o] = np.repeat(np.arange(len(first)), df)
        self.cut = np.searchsorted(doc, np.arange(self.n + 1))
        often = np.flatnonzero(df * DENSE >= self.n)
        self.row = np.full(len(first), -1)
        self.row[often] = np.arange(len(often))
        at = self.row[self.terms[o]]
        self.dense = np.zeros((len(often), self.n))
        self.dense[at[at >= 0], self.doc[at >= 0]] = self.weight[at >= 0]

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of every document of the shard for the seed's distinct terms."""
        t = self.terms[self.cut[seed] : self.cut[seed + 1]]
        row = self.row[t]
        out = self.dense[row[row >= 0]].sum(axis=0)
        t = t[row < 0]
        if len(t):
            n = self.df[t]
            ends = np.cumsum(n)
            place = np.arange(ends[-1]) + np.repeat(self.first[t] - (ends - n), n)
            out += np.bincount(self.doc[place], self.weight[place], self.n)
        return out


def pack_shard(docs: list[np.ndarray], length: int, corpus: Corpus) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of one shard, in order of sequence and offset.

    Each unused document in turn is a seed; its unused neighbours follow by falling score (ties: the earlier
    document) until the window is full.  A document that does not fit whole is cut, and its rest opens the
    next window.  So only the last sequence of a shard has room left.
    """
    index, unused = Bm25(docs, corpus), np.ones(len(docs), bool)
    out: list[tuple[int, int, int, int, int]] = []
    sequence, filled = 0, 0

    def put(d: int) -> bool:
        """Whether the document ended a window."""
        nonlocal sequence, filled
        unused[d] = False
        at, before = 0, sequence
        while at < len(docs[d]):
            n = min(len(docs[d]) - at, length - filled)
            out.append((d, at, n, sequence, filled))
            at, filled = at + n, filled + n
            if filled == length:
                sequence, filled = sequence + 1, 0
        return sequence > before

    seed = 0
    while unused.any():
        if not filled:  # no document is open: the first unused one is the next seed
            seed = int(np.flatnonzero(unused)[0])
            put(seed)
            continue
        score = np.where(unused, index.scores(seed), -np.inf)
        for _ in range(np.count_nonzero(unused)):
            d = int(score.argmax())
            score[d] = -np.inf
            if put(d):
                seed = d
                break
    return out


@functools.cache
def signs(n: int) -> np.ndarray:
    """SKETCH signs of each of n terms, the same everywhere; they depend on no document."""
    return np.random.default_rng(0).integers(0, 2, (n, SKETCH), np.int8) * np.int8(2) - np.int8(1)


def projected(corpus: Corpus, rows: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray, length: np.ndarray) -> np.ndarray:
    """BM25 weights of each of the occurrences' documents, at unit length, times the terms' rows."""
    w = corpus.weights(term, tf, length[doc]).astype(np.float32)
    cut = np.searchsorted(doc, np.arange(len(length) + 1))
    out = np.array([w[a:b] @ rows[term[a:b]].astype(np.float32) for a, b in zip(cut[:-1], cut[1:], strict=True)]).reshape(len(length), rows.shape[1])
    return out / np.maximum(np.sqrt(np.bincount(doc, w * w, len(length))), 1e-9)[:, None]


class Router:
    """Orders documents so that those whose terms point the same way follow each other."""

    def __init__(self, corpus: Corpus, sums: np.ndarray):
        """sums: over all texts, products of the sketches (1, then SKETCH numbers in STEPS) with each other."""
        self.corpus = corpus
        mean = sums[0, 1:] / max(sums[0, 0], 1)
        _, found = np.linalg.eigh(sums[1:, 1:] / max(sums[0, 0], 1) - np.outer(mean, mean))
        found = found[:, : -DIRECTIONS - 1 : -1]
        found = found * np.where(found[np.abs(found).argmax(axis=0), np.arange(DIRECTIONS)] < 0, -1, 1)
        self.axes = signs(len(corpus.idf)).astype(np.float32) @ found.astype(np.float32)
        self.origin = mean @ found / STEPS

    def routes(self, doc: np.ndarray, term: np.ndarray, tf: np.ndarray, length: np.ndarray) -> np.ndarray:
        """The directions with their signs, from the one a document lies farthest along (ties: the earlier), as one number, of each of the occurrences' documents."""
        along = projected(self.corpus, self.axes, doc, term, tf, length) - self.origin
        best = np.argsort(-np.abs(along), axis=1, kind="stable")
        digits = 2 * best + (np.take_along_axis(along, best, axis=1) < 0)
        out = np.zeros(len(length), np.int64)
        for k in range(DIRECTIONS):
            out = out * 2 * DIRECTIONS + digits[:, k]
        return out


def n_ids(t: Transducer) -> int:
    """Number of ids, those of special tokens included."""
    return max([int(t.width) - 1, END_ID, *t.special.values()]) + 1


def encoded_texts(t: Transducer, texts: list[str | None]) -> Iterator[list[np.ndarray]]:
    """Ids and END_ID of the texts, about a million characters at a time; a longer text comes alone."""
    at, size = 0, 0
    for i, x in enumerate([*texts, None]):
        if i > at and (i == len(texts) or size + len(x or "") > SHARD_TOKENS):
            yield [np.append(ids, np.uint32(END_ID)) for ids in t.encode([y or "" for y in texts[at:i]])]
            at, size = i, 0
        size += len(x or "")


def id_kind(path: str) -> str:
    """How ids are written."""
    return "<u2" if n_ids(transducer(path)) <= 1 << 16 else "<u4"


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, _ids, _row and _hash (of the ids) of every text, and a row for each task with its sums _df alone; written."""
    kind = id_kind(path)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, row = transducer(path), TaskContext.get().partitionId() << 33
        names, key_type = ["doc_id", "_ids", "_row", "_df"], None
        df = np.zeros(n_ids(t) + 2, np.int64)
        for batch in batches:
            at, key_type = 0, batch.column(0).type
            for some in encoded_texts(t, batch.column(1).to_pylist()):
                _, term, _, size = occurrences(some)
                df[:-2] += np.bincount(term, minlength=len(df) - 2)
                df[-2:] += len(some), size.sum()
                ids = pa.array([x.astype(kind).tobytes() for x in some], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(some)), ids, pa.array(np.arange(row, row + len(some))), pa.nulls(len(some), pa.binary())], names=names)
                at, row = at + len(some), row + len(some)
        if key_type is not None:
            yield pa.RecordBatch.from_arrays([pa.nulls(1, key_type), pa.nulls(1, pa.binary()), pa.nulls(1, pa.int64()), pa.array([df.tobytes()], pa.binary())], names=names)

    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, _ids binary, _row long, _df binary"
    return written(docs.select("doc_id", "text").mapInArrow(encode, schema).withColumn("_hash", F.xxhash64("_ids")))


def decoded(ids: list[bytes], kind: str) -> Iterator[list[np.ndarray]]:
    """Written ids, about SHARD_TOKENS at a time; those of a longer text come alone."""
    at, size = 0, 0
    for i, x in enumerate([*ids, b""]):
        n = len(x) // np.dtype(kind).itemsize
        if i > at and (i == len(ids) or size + n > SHARD_TOKENS):
            yield [np.frombuffer(y, kind) for y in ids[at:i]]
            at, size = i, 0
        size += n


def repeats(table: DataFrame) -> DataFrame:
    """_ids of each text that occurs more than once in a table of `encoded`, and _n: one less than its rows, negative; written.

    A bitmap of such hashes lets other rows pass by; equal ids are counted in the map tasks before they are shuffled.
    """
    rows = table.filter("_df is null")
    often = written(rows.groupBy("_hash").count().filter("count > 1").select("_hash"))
    shared = table.sparkSession.sparkContext.broadcast(membership(often, "_hash"))

    @F.pandas_udf("boolean")
    def maybe(h: pd.Series) -> pd.Series:
        return pd.Series(may_hold(np.frombuffer(shared.value, np.uint8), h.to_numpy().view(np.uint64)))

    counted = rows.select("_hash", "_ids").filter(maybe("_hash")).groupBy("_hash", "_ids").agg(F.count("*").alias("n"))
    return written(counted.filter("n > 1").select("_ids", (1 - F.col("n")).alias("_n")))


def summed(partial: DataFrame) -> np.ndarray:
    """Sum of the arrays (long, of one length, the first place not 0 in sum) of a binary column; a row for each place reaches the driver."""

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(0, np.int64)
        for batch in batches:
            for x in batch.column(0).to_pylist():
                more = np.frombuffer(x, np.int64)
                out = more + out if len(out) else more
        at = np.flatnonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(at - len(out)), pa.array(out[at])], names=["at", "n"])

    rows = np.array(partial.mapInArrow(total, "at long, n long").groupBy("at").agg(F.sum("n")).collect(), np.int64).reshape(-1, 2)
    out = np.zeros(int(-rows[:, 0].min(initial=0)), np.int64)
    out[rows[:, 0]] = rows[:, 1]
    return out


def statistics(partial: DataFrame) -> Corpus:
    """Document frequencies, number and mean length of all documents, from the tasks' sums _df."""
    df = summed(partial.select("_df"))
    return Corpus(df[:-2], int(df[-2]), int(df[-1])) if len(df) else Corpus(np.zeros(1, np.int64), 0, 0)


def routing(docs: DataFrame, path: str) -> Router:
    """The router of all different texts of docs (a column text, or a table of `encoded`).

    Sums are taken of all rows; what a repeated text adds beyond its first row is taken off again.
    """
    kind, n = id_kind(path), n_ids(transducer(path))
    table = docs if "_ids" in docs.columns else encoded(docs.select(F.lit(0).alias("doc_id"), "text"), path)
    again = repeats(table)

    def surplus(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(n + 2, np.int64)
        for batch in batches:
            at = 0
            for some in decoded(batch.column(0).to_pylist(), kind):
                times = batch.column(1).to_numpy()[at : at + len(some)]
                doc, term, _, size = occurrences(some)
                df[:-2] += np.bincount(term, times[doc], n).astype(np.int64)
                df[-2:] += times.sum(), times @ size
                at += len(some)
        if df.any():
            yield pa.RecordBatch.from_arrays([pa.array([df.tobytes()], pa.binary())], names=["_df"])

    corpus = statistics(table.filter("_df is not null").select("_df").unionAll(written(again.mapInArrow(surplus, "_df binary"))))
    shared = docs.sparkSession.sparkContext.broadcast(corpus)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # whole numbers below 2**53: sums are exact, whatever their order
        out = np.zeros((SKETCH + 1, SKETCH + 1))
        for batch in batches:
            at = 0
            for some in decoded(batch.column(0).to_pylist(), kind):
                sketch = np.ones((len(some), SKETCH + 1))
                sketch[:, 1:] = np.rint(STEPS * projected(shared.value, signs(n), *occurrences(some)))
                out += (sketch * batch.column(1).to_numpy()[at : at + len(some), None]).T @ sketch
                at += len(some)
        if out.any():
            yield pa.RecordBatch.from_arrays([pa.array([out.astype(np.int64).tobytes()], pa.binary())], names=["sums"])

    every = table.filter("_df is null").select("_ids", F.lit(1).cast("long").alias("_n")).unionAll(again)
    sums = summed(written(every.mapInArrow(products, "sums binary")))
    return Router(corpus, sums.reshape(SKETCH + 1, SKETCH + 1) if len(sums) else np.zeros((SKETCH + 1, SKETCH + 1)))


def retrieval_pack(docs: DataFrame, path: str, length: int = LENGTH, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """Pieces of documents in sequences of `length` tokens, related documents next to each other.

    Result, a row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and the ids
    themselves (array of int).  Every document's ids (the file's, then END_ID) lie in pieces, each id in one.

    The index is sharded by content.  Document frequencies, number and mean length are those of all documents.
    Each document is placed along the DIRECTIONS in which all different texts vary most (principal directions of
    their weights, at random signs of the terms), and all are sorted by the directions that suit them best: a
    shard is shard_docs documents that follow each other there, wherever they stood in the input, and returns the
    neighbours of its seeds.  A seed's neighbours in other shards are not found.  The sort is by range and ends
    with a hash and the row's number, so a third of the rows in one source or group of copies is dealt over as
    many tasks as it needs; ids are written once and shuffled once.  Only the last sequence of a shard is not
    full; it is to be padded.

    A null or empty text is one END_ID.  Repeated rows are packed as often as they occur; ties in score go to
    the earlier row of the shard.  Other columns are ignored; an empty table gives no pieces.
    """
    spark, id_type, kind = docs.sparkSession, dict(docs.dtypes)["doc_id"], id_kind(path)
    table = encoded(docs, path)
    router = spark.sparkContext.broadcast(routing(table, path))
    corpus = spark.sparkContext.broadcast(statistics(table.filter("_df is not null")))

    @F.pandas_udf("long")
    def route(ids: pd.Series) -> pd.Series:
        return pd.Series(np.concatenate([np.zeros(0, np.int64), *(router.value.routes(*occurrences(some)) for some in decoded(ids.tolist(), kind))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 33
        keys: list = []
        docs: list[np.ndarray] = []
        tokens = 0

        def shard() -> pa.RecordBatch:
            nonlocal base, keys, docs, tokens
            pieces = pack_shard(docs, length, corpus.value)
            d, start, n, sequence, offset = (np.array(x, np.int64) for x in zip(*pieces, strict=True))
            ids = [docs[i][a : a + m] for i, a, m, _, _ in pieces]
            crc = np.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], np.int64)
            total = np.fromiter(map(len, docs), np.int64, len(docs))[d]
            flat = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), pa.array(np.concatenate(ids).astype(np.int32)))
            who = pa.array(keys, key_type).take(pa.array(d))
            out = pa.RecordBatch.from_arrays([who, *(pa.array(x) for x in (start, n, crc, total, base + sequence, offset)), flat], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"])
            base += int(sequence.max()) + 1
            keys, docs, tokens = [], [], 0
            return out

        for batch in batches:
            key_type = batch.column(0).type
            for key, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                keys.append(key)
                docs.append(np.frombuffer(ids, kind).astype(np.uint32))
                tokens += len(docs[-1])
                if len(docs) == shard_docs or tokens >= SHARD_TOKENS:
                    yield shard()
        if docs:
            yield shard()

    order = ["_route", "_hash", "_row"]
    routed = table.filter("_df is null").withColumn("_route", route("_ids"))
    schema = f"doc_id {id_type}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids array<int>"
    return routed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "_ids").mapInArrow(run, schema)


def op6_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval_pack(load(spark, sf_dir, "documents"), vocabulary_path(VOCABULARY)).drop("ids")
