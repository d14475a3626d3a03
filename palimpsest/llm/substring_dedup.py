"""Removal of word passages that occur more than once: seed and extend."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm._spark import keyed, load, may_hold, membership, written
from palimpsest.llm._vec import WHITE, Words, chunks, merged, mix, winnow

#: Words of a passage, and of a seed; a passage holds one winnowing window of seeds.
PASSAGE, SEED = 35, 18
_SALT = np.uint64(0xD6E8FEB86659FD93)


def _seeds(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all seeds, the first words of all passages, and each passage's seed."""
    h, _ = w.grams(SEED)
    chosen = winnow(h, PASSAGE - SEED + 1)
    at = np.flatnonzero(w.inside(PASSAGE))
    return h, at, chosen[at] if len(at) else at


def seed_hashes(docs: DataFrame) -> DataFrame:
    """s: the hash of each winnowed seed of each text, once for each place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in chunks(batch.column(0)):
                h, _, chosen = _seeds(Words(texts, WHITE))
                yield pa.RecordBatch.from_arrays([pa.array(h[np.unique(chosen)].view(np.int64))], names=["s"])

    return docs.select("text").mapInArrow(run, "s long")


def passages(docs: DataFrame, seeds: bytes, known: bytes | None = None, places: bool = False) -> DataFrame:
    """h, c (96 bits of hash) of each passage around a seed that may repeat; with its text's key and its first word if asked.

    The seed is extended to both sides as far as a passage that chose it can reach.  `known` holds passages.
    """
    context = docs.sparkSession.sparkContext
    shared, passed = context.broadcast(seeds), context.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.frombuffer(shared.value, np.uint8)
        also = None if passed.value is None else np.frombuffer(passed.value, np.uint8)
        for batch in batches:
            for first, texts in chunks(batch.column(2)):
                w = Words(texts, WHITE)
                h, at, chosen = _seeds(w)
                at = at[may_hold(held, h[chosen])]
                whole = w.grams(PASSAGE)[0][at]
                check = (mix(h[at] + mix(h[at + PASSAGE - SEED] ^ _SALT)) >> np.uint64(32)).astype(np.uint32).view(np.int32)
                if also is not None:
                    keep = may_hold(also, whole)
                    at, whole, check = at[keep], whole[keep], check[keep]
                columns = [pa.array(whole.view(np.int64)), pa.array(check)]
                if places:
                    own = np.repeat(np.arange(len(texts)), w.count)[at]
                    rows = pa.array(first + own)
                    columns += [batch.column(0).take(rows), batch.column(1).take(rows), pa.array((at - w.first[own]).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names=["h", "c", "k1", "k2", "pos"][: len(columns)])

    return docs.select("k1", "k2", "text").mapInArrow(run, "h long, c int" + ", k1 long, k2 long, pos int" * places)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """For each row: doc_id, n_words, n_removed, kept_sha256, kept_text (what is left, joined by blanks).

    A word goes if a run of PASSAGE words that covers it starts at any other place too, in the same text or
    another.  Texts are compared by winnowed seeds first: seeds that occur twice set bits of a filter of fixed
    size; around these, passages are hashed whole and counted; those that occur twice go back to their
    places, where they unite to maximal repeats.  Counting combines in the map tasks, so a passage in a third
    of all texts is a few rows; nothing gathers a passage's places.

    A null text has no words.  Rows that agree in doc_id and text are each other's copies like any others.
    Other columns are ignored; an empty table gives an empty result.
    """
    given = keyed(docs)
    twice = written(seed_hashes(given).groupBy("s").count().filter("count > 1").select("s"))
    seeds = membership(twice, "s")
    repeated = written(passages(given, seeds).groupBy("h", "c").count().filter("count > 1").select("h", "c"))
    places = passages(given, seeds, membership(repeated, "h"), places=True)
    found = places.join(repeated, ["h", "c"]).groupBy("k1", "k2").agg(F.array_distinct(F.collect_list("pos")).alias("at"))
    rows = given.join(found, ["k1", "k2"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = batch.column(2)
            for first, texts in chunks(batch.column(1)):
                w = Words(texts, WHITE)
                gone, out = [], []
                for k in range(len(texts)):
                    a, b = w.first[k], w.first[k + 1]
                    at = np.array(places[first + k].as_py() or [], np.int64)
                    left = np.ones(b - a, bool)
                    for x, y in zip(*merged(at, at + PASSAGE), strict=True):
                        left[x:y] = False
                    gone.append(b - a - int(left.sum()))
                    i = a + np.flatnonzero(left)
                    out.append(b" ".join([w.data[x:y] for x, y in zip(w.start[i].tolist(), w.end[i].tolist(), strict=True)]))
                own = batch.column(0).slice(first, len(texts))
                yield pa.RecordBatch.from_arrays([own, pa.array(w.count, pa.int64()), pa.array(gone, pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in out]), pa.array([x.decode() for x in out], pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])

    return rows.select("doc_id", "text", "at").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, n_words long, n_removed long, kept_sha256 string, kept_text string")


def op7_seed_extend_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(load(spark, sf_dir, "documents")).drop("kept_text")


ORACLE = r"""
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), spans AS (
  SELECT doc_id, p, md5(array_to_string(w[p : p + 34], ' ')) AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS p FROM w WHERE len(w) >= 35)
), twice AS (
  SELECT doc_id, p FROM spans QUALIFY count(*) OVER (PARTITION BY s) > 1
), gone AS (
  SELECT doc_id, list(DISTINCT q) AS q FROM (SELECT doc_id, unnest(range(p, p + 35)) AS q FROM twice) GROUP BY doc_id
), words AS (
  SELECT doc_id, i, x FROM (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS x FROM w)
), kept AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS t FROM words ANTI JOIN (SELECT doc_id, unnest(q) AS i FROM gone) USING (doc_id, i) GROUP BY doc_id
)
SELECT w.doc_id, len(w)::BIGINT AS n_words, coalesce(len(q), 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
