"""Benchmark decontamination by winnowed fingerprints."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm._spark import keyed, load, may_hold, membership, sha, whole_rows, written
from palimpsest.llm._vec import ALNUM, Words, chunks, winnow

#: A span of SPAN words holds SPAN - GRAM + 1 grams, which is one winnowing window; SIDE words at most lie beside its anchor.
SPAN, GRAM = 10, 5
SIDE = SPAN - GRAM
_ANCHOR = "f: long, pos: int, len: int, off: int, words: array<long>"
_TYPE = pa.struct([("f", pa.int64()), ("pos", pa.int32()), ("len", pa.int32()), ("off", pa.int32()), ("words", pa.list_(pa.int64()))])


def _anchors(w: Words, lengths: list[int], keep=None) -> Iterator[tuple[int, dict]]:
    """Text number and anchor of each winnowed gram of a span, and of each run of one of the shorter lengths.

    An anchor has its hash f, first word pos, number of words len, and for grams the hashes of the words around, of which the gram
    begins at off.  keep says which hashes are wanted.
    """
    owner = np.repeat(np.arange(len(w.count)), w.count)
    grams, _ = w.grams(GRAM)
    chosen = winnow(grams, SIDE + 1)
    at = np.flatnonzero(w.inside(SPAN))
    at = np.unique(chosen[at[at < len(chosen)]])
    words = w.hash.view(np.int64)
    for n, f, at in [(SPAN, grams, at), *((n, h, np.flatnonzero(ok)) for n in lengths for h, ok in (w.grams(n),))]:
        at = at if keep is None else at[keep(f[at])]
        own = owner[at]
        first, last = w.first[own], w.first[own + 1]
        for d, h, x, a, b in zip(own.tolist(), f[at].view(np.int64).tolist(), at.tolist(), first.tolist(), last.tolist(), strict=True):
            lo = max(a, x - SIDE)
            around = words[lo : min(b, x + GRAM + SIDE)].tolist() if n == SPAN else []
            yield d, {"f": h, "pos": x - a, "len": n, "off": x - lo, "words": around}


def benchmark_anchors(items: DataFrame) -> DataFrame:
    """f, len, off, words, item_ids: the anchors of items of SPAN words or more, and the shorter items as a whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in chunks(batch.column(1)):
                w = Words(texts, ALNUM, lower=True)
                short = sorted(set(w.count[(w.count > 0) & (w.count < SPAN)].tolist()))
                found = [(d, x) for d, x in _anchors(w, short) if x["len"] == SPAN or w.count[d] == x["len"]]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array([first + d for d, _ in found], pa.int64())), pa.array([x for _, x in found], _TYPE)], names=["item_id", "a"])

    found = items.select("item_id", "text").mapInArrow(run, f"item_id {dict(items.dtypes)['item_id']}, a struct<{_ANCHOR}>")
    return found.groupBy("a.f", "a.len", "a.off", "a.words").agg(F.collect_set("item_id").alias("item_ids"))


def document_anchors(docs: DataFrame, bitmap: bytes, lengths: list[int]) -> DataFrame:
    """doc_id, k1, k2, n_words and the anchors whose hash the bitmap may hold."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            n_words, found = [], []
            for _, texts in chunks(batch.column(3)):
                w = Words(texts, ALNUM, lower=True)
                n_words.append(w.count)
                rows: list[list[dict]] = [[] for _ in texts]
                for d, x in _anchors(w, lengths, lambda f: may_hold(held, f)):
                    rows[d].append(x)
                found += rows
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(np.concatenate(n_words) if n_words else [], pa.int64()), pa.array(found, pa.list_(_TYPE))], names=["doc_id", "k1", "k2", "n_words", "anchors"])

    return docs.select("doc_id", "k1", "k2", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, k1 long, k2 long, n_words long, anchors array<struct<{_ANCHOR}>>")


def extended(step: int) -> Column:
    """How many words beside the anchors agree one after the other, to the left (-1) or to the right (1)."""
    total, go = F.lit(0), F.lit(True)
    for k in range(SIDE):
        away = -1 - k if step < 0 else GRAM + k
        go = go & F.coalesce(F.get("words", F.col("off") + away) == F.get("b_words", F.col("b_off") + away), F.lit(False))
        total = total + go.cast("int")
    return total


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """For each document row: doc_id, k1, k2, n_words, n_hit, n_items, items_sha256, contaminated, item_ids.

    Words are runs of ASCII letters (lower-cased), digits and non-ASCII characters.  Both sides keep the least
    5-word hash of every 6 consecutive ones (winnowing), so a shared span of 10 words always shares an
    anchor; items under 10 words are looked up whole.  A document's anchors first pass a bitmap made of the benchmark's; then the
    anchors of both sides are joined and extended word by word to both sides, by 5 words at most: a run of 10 words or more is a
    hit, and what lies further is the next anchor's.  Nothing but these anchors is shuffled; only the bitmap and the
    lengths of short items (nine at most) are sent around.

    Null or empty texts have no words; items without words never occur.  Documents that repeat get repeated
    rows; items that repeat or have equal texts count by item_id; null ids are kept (a null item_id sorts out of
    items_sha256).  Other columns are ignored, empty tables give no hits or no rows.
    """
    bench = written(benchmark_anchors(items))
    lengths = sorted(r[0] for r in bench.select("len").distinct().collect() if r[0] < SPAN)
    facts = written(document_anchors(keyed(docs), membership(bench, "f"), lengths))
    anchors = facts.select("k1", "k2", F.explode("anchors").alias("s")).select("k1", "k2", "s.*")
    both = anchors.join(bench.select("f", "len", F.col("off").alias("b_off"), F.col("words").alias("b_words"), "item_ids"), ["f", "len"])
    both = both.withColumn("left", extended(-1)).withColumn("right", extended(1)).filter(f"len < {SPAN} or left + right >= {SIDE}")
    start, end = F.when(F.col("len") < SPAN, F.col("pos")).otherwise(F.col("pos") - F.col("left")), F.when(F.col("len") < SPAN, F.col("pos") + F.col("len")).otherwise(F.col("pos") + GRAM + F.col("right"))
    runs = F.sort_array(F.collect_set(F.struct(start.alias("pos"), end.alias("end"))))
    hits = both.groupBy("k1", "k2").agg(runs.alias("at"))
    ids = both.select("k1", "k2", F.explode("item_ids").alias("i")).distinct().groupBy("k1", "k2").agg(F.sort_array(F.collect_list(F.col("i").cast("string"))).alias("item_ids"))
    n_hit = F.aggregate(
        "at",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("top")),
        lambda a, x: F.struct((a.n + F.greatest(F.lit(0), x.end - F.greatest(x.pos, a.top))).alias("n"), F.greatest(a.top, x.end).alias("top")),
        lambda a: a.n,
    )
    own = hits.select("k1", "k2", n_hit.alias("n_hit")).join(ids, ["k1", "k2"], "left")
    out = facts.drop("anchors").join(own, ["k1", "k2"], "left")
    ids = F.coalesce("item_ids", F.array().cast("array<string>"))
    hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return out.select("doc_id", "k1", "k2", "n_words", hit.alias("n_hit"), F.size(ids).cast("long").alias("n_items"), sha(F.array_join(ids, ",")).alias("items_sha256"), (hit > 0).alias("contaminated"), ids.alias("item_ids"))


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of docs, with all their columns, that hold no window of an item.

    Nulls, repeated rows and empty tables: as in decontaminate; columns may have any names.
    """
    bad = decontaminate(docs, items).filter("contaminated")
    return whole_rows(docs, bad, "left_anti")


def op2_winnow_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark")).drop("k1", "k2", "item_ids")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents
), b AS (
  SELECT item_id, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark
), items AS (
  SELECT item_id, least(len(w), 10) AS n, unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda i: array_to_string(w[i : i + 9], ' '))) AS span FROM b WHERE len(w) > 0
), lengths AS (SELECT DISTINCT n FROM items),
spans AS (
  SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS p, w FROM d, lengths WHERE len(w) >= n
), hits AS (
  SELECT s.doc_id, s.p, s.n, i.item_id FROM (SELECT doc_id, p, n, array_to_string(w[p : p + n - 1], ' ') AS span FROM spans) s JOIN items i ON s.n = i.n AND s.span = i.span
), words AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM hits) GROUP BY doc_id
), found AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hits GROUP BY doc_id
)
SELECT d.doc_id, coalesce(len(w), 0)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)
"""
