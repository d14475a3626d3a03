"""Removal of repeated byte strings by merging the suffix orders of text segments."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm._spark import keyed, load, may_hold, membership, written
from palimpsest.llm._vec import byte_values, chunks, gram_hash, merged, mix, prefix_hash, span_hash, winnow

#: Bytes of a string, of an anchor, and of a symbol of the merged orders (a divisor of LENGTH; two pairs of bytes).
LENGTH, ANCHOR, SYMBOL = 100, 24, 4
#: Segments that are merged at once at least, and bytes of them that a map task holds before it hands on.
MERGE, HOLD_BYTES = 4096, 24 << 20
NEXT = LENGTH - ANCHOR + 1
#: An anchor with more places than HOT is split by what surrounds it; of such anchors there are HOT_MOST at most
#: (HOT rises with the input for that). A piece holds strings that start within PIECE bytes of each other.
HOT, HOT_MOST, PIECE = 5000, 1_000_000, 5


class Anchored:
    """Strings of LENGTH bytes of the texts in one chunk: where they start, and the anchor that each holds."""

    def __init__(self, texts: list[bytes]):
        self.data = b"\x00".join(texts) + b"\x00"
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.first = np.concatenate([[0], np.cumsum(lengths + 1)])
        self.c = prefix_hash(byte_values(np.frombuffer(self.data, np.uint8)))
        self.hash = gram_hash(self.c, ANCHOR)
        chosen = winnow(self.hash, NEXT)  # never falls from one string to the next
        n = np.maximum(0, lengths - LENGTH + 1)
        self.at = np.repeat(self.first[:-1], n) + (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
        self.own = np.repeat(np.arange(len(texts)), n)
        self.anchor = chosen[self.at]
        #: The first string of each run of strings that share an anchor, and the anchors of the runs.
        self.new = np.flatnonzero(np.diff(self.anchor, prepend=-1))
        self.anchors = self.anchor[self.new]

    def each(self, of_run: np.ndarray) -> np.ndarray:
        """What holds for each run, for each of its strings."""
        return np.repeat(of_run, np.diff(self.new, append=len(self.at)))

    def hot(self, anchor: np.ndarray, hot: np.ndarray) -> np.ndarray:
        h = self.hash[anchor]
        return hot[np.minimum(np.searchsorted(hot, h), len(hot) - 1)] == h if len(hot) else np.zeros(len(h), bool)

    def runs(self, hit: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of the strings `hit`: first and last string of each run that shares one anchor, its key, and whether it is a piece.

        A run around a hot anchor is cut into pieces by distance from the anchor; a piece's key is a hash of the
        bytes that all strings at these distances share, so equal strings always have equal keys.
        """
        at, anchor = self.at[hit], self.anchor[hit]
        new = np.diff(anchor, prepend=-1) != 0
        piece = self.hot(anchor[new], hot)
        split = np.flatnonzero(np.repeat(piece, np.diff(np.flatnonzero(new), append=len(at))))
        part = (anchor[split] - at[split]) // PIECE
        new[split[1:]] |= np.diff(part) != 0
        a = np.flatnonzero(new)
        b = np.append(a[1:], len(at)) - 1
        key, piece = self.hash[anchor[a]], np.zeros(len(at), bool)
        piece[split] = True
        cut = np.flatnonzero(piece[a])
        core = anchor[a[cut]] - (anchor[a[cut]] - at[a[cut]]) // PIECE * PIECE
        key[cut] = mix(key[cut] ^ span_hash(self.c, core, core + LENGTH - PIECE + 1))
        return hit[a], hit[b], key, piece[a]


def anchor_hashes(docs: DataFrame) -> DataFrame:
    """a: the hash of each anchor of each text, once for each place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in chunks(batch.column(0)):
                t = Anchored(texts)
                yield pa.RecordBatch.from_arrays([pa.array(t.hash[t.anchors].view(np.int64))], names=["a"])

    return docs.select("text").mapInArrow(run, "a long")


def piece_keys(docs: DataFrame, hot: np.ndarray) -> DataFrame:
    """a: the key of each piece around a hot anchor, once for each place."""
    shared = docs.sparkSession.sparkContext.broadcast(hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in chunks(batch.column(0)):
                t = Anchored(texts)
                if len(hit := np.flatnonzero(t.each(t.hot(t.anchors, shared.value)))):
                    yield pa.RecordBatch.from_arrays([pa.array(t.runs(hit, shared.value)[2].view(np.int64))], names=["a"])

    return docs.select("text").mapInArrow(run, "a long")


_NAMES = ["a", "doc_id", "k1", "k2", "start", "stop", "segment"]
_SCHEMA = "a long, doc_id long, k1 long, k2 long, start int, stop int, segment binary"


def segments(docs: DataFrame, anchors: bytes, hot: np.ndarray, pieces: bytes | None) -> DataFrame:
    """Segments around the anchors that may repeat: all strings that hold one anchor at one place, as one run of bytes.

    Of equal segments in a task only the first in order goes on; the others' bytes are known to be repeats, and
    are given as rows without segment (start to stop), whose key only spreads them.
    """
    shared = docs.sparkSession.sparkContext.broadcast((anchors, hot, pieces))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, hot, pieces = shared.value
        held, pieces = np.frombuffer(held, np.uint8), None if pieces is None else np.frombuffer(pieces, np.uint8)
        parts: list[tuple] = []
        size = 0

        def hand_on() -> Iterator[pa.RecordBatch]:
            nonlocal parts, size
            data, owners = [p[0] for p in parts], np.repeat(np.arange(len(parts)), [len(p[1]) for p in parts])
            a, g, lo, hi, start, null, doc, k1, k2 = (np.concatenate([p[j] for p in parts]) for j in range(1, 10))
            parts, size = [], 0
            order = np.lexsort((start, k2, doc, null, g, a))
            o = lambda x: x[order]
            new = np.ones(len(a), bool)
            new[1:] = (o(a)[1:] != o(a)[:-1]) | (o(g)[1:] != o(g)[:-1])
            group = np.cumsum(new) - 1
            head = np.flatnonzero(new)[group]
            # the same place of a repeated row is no earlier place
            same = (o(k1) == o(k1)[head]) & (o(k2) == o(k2)[head]) & (o(start) == o(start)[head])
            go, rest = order[new], order[~same]
            put = lambda i, a, start, stop, x: pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(doc[i], mask=null[i]), pa.array(k1[i]), pa.array(k2[i]), pa.array(start.astype(np.int32)), pa.array(stop.astype(np.int32)), pa.array(x, pa.binary())], names=_NAMES)
            for j in range(0, len(go), 20_000):
                i = go[j : j + 20_000]
                x = [data[w][p:q] for w, p, q in zip(owners[i].tolist(), lo[i].tolist(), hi[i].tolist(), strict=True)]
                yield put(i, a[i].view(np.int64), start[i], start[i] + hi[i] - lo[i], x)
            if len(rest):
                rest = rest[np.lexsort((start[rest], k2[rest], k1[rest]))]
                stop = start[rest] + hi[rest] - lo[rest]
                cut = np.flatnonzero(np.concatenate([[True], (k1[rest][1:] != k1[rest][:-1]) | (k2[rest][1:] != k2[rest][:-1])]))
                who, begin, end = [], [], []
                for x, y in zip(cut, np.append(cut[1:], len(rest)), strict=True):
                    b, e = merged(start[rest[x:y]], stop[x:y])
                    who.append(np.repeat(rest[x], len(b)))
                    begin.append(b)
                    end.append(e)
                i = np.concatenate(who)
                yield put(i, k2[i], np.concatenate(begin), np.concatenate(end), [None] * len(i))

        for batch in batches:
            null = np.asarray(batch.column(0).is_null())
            doc, k1, k2 = (batch.column(j).fill_null(0).to_numpy() for j in range(3))
            for first, texts in chunks(batch.column(3)):
                t = Anchored(texts)
                hit = np.flatnonzero(t.each(may_hold(held, t.hash[t.anchors])))
                if not len(hit):
                    continue
                begin, end, key, piece = t.runs(hit, hot)
                if pieces is not None:
                    keep = ~piece | may_hold(pieces, key)
                    begin, end, key = begin[keep], end[keep], key[keep]
                lo, hi = t.at[begin], t.at[end] + LENGTH
                own = first + t.own[begin]
                parts.append((t.data, key, span_hash(t.c, lo, hi), lo, hi, lo - t.first[own - first], null[own], doc[own], k1[own], k2[own]))
                size += len(t.data)
                if size >= HOLD_BYTES:
                    yield from hand_on()
        if parts:
            yield from hand_on()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "k1", "k2", "text").mapInArrow(run, _SCHEMA)


def dense(code: np.ndarray, n: int) -> tuple[int, np.ndarray]:
    """Numbers below n, numbered anew in order without gaps: how many kinds, and the new numbers."""
    seen = np.zeros(n, bool)
    seen[code] = True
    number = np.cumsum(seen, dtype=np.int32)
    return int(number[-1]), (number - 1)[code]


def symbols(data: np.ndarray) -> tuple[int, np.ndarray]:
    """The number of kinds of SYMBOL bytes in data, and the kind at each place: pairs of bytes are numbered, then pairs of these."""
    n, code = dense(data[:-1].astype(np.int64) << 8 | data[1:], 1 << 16)
    code = code[:-2].astype(np.int64) * n + code[2:]
    if n * n <= 1 << 24:
        return dense(code, n * n)
    kinds, code = np.unique(code, return_inverse=True)
    return len(kinds), code


def merge_orders(data: np.ndarray, base: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Strings of LENGTH bytes at the places `base` in data, in order, without those that are unique; and their intervals.

    The interleave of the segments' suffix orders is refined one symbol (SYMBOL bytes) at a time: pass t has
    the suffixes that begin LENGTH - t symbols into their strings, ordered by t symbols; one stable counting
    sort by the symbol before (the last-to-first mapping) gives pass t + 1.  Where a pass separates
    neighbours, their common prefix is t - 1 symbols; what no pass separates shares all LENGTH bytes.  A
    suffix that has become unique stays so with any symbol before it, so it leaves.
    """
    kinds, code = symbols(data)
    low, high = code.astype(np.uint16), (code >> 16).astype(np.uint16) if kinds > 1 << 16 else None
    kind = np.int32 if len(data) < 1 << 31 else np.int64
    z, interval = base.astype(kind), np.zeros(len(base), kind)
    for t in range(LENGTH // SYMBOL - 1, -1, -1):
        if len(z) < 2:
            return z[:0], interval[:0]
        place = z + t * SYMBOL
        c = low[place]
        o = np.argsort(c, kind="stable")
        if high is not None:
            o = o[np.argsort(high[place[o]], kind="stable")]
            c = code[place]
        z, interval, c = z[o], interval[o], c[o]
        new = np.ones(len(z) + 1, bool)
        np.not_equal(c[1:], c[:-1], out=new[1:-1])
        new[1:-1] |= interval[1:] != interval[:-1]
        alone = new[:-1] & new[1:]
        interval = np.cumsum(new[:-1], dtype=kind)
        if alone.any():
            z, interval = z[~alone], interval[~alone]
    return z, interval


def repeats(rows: DataFrame) -> DataFrame:
    """k1, k2, start, stop of the bytes of each segment whose strings also start earlier, and of what is known to repeat.

    Rows come by anchor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def merge(rows: pa.Table) -> pa.RecordBatch:
            raw = rows.column("segment").to_pylist()
            length = np.fromiter(map(len, raw), np.int64, len(raw))
            data = np.frombuffer(b"".join(raw) + b"\x00" * SYMBOL, np.uint8)
            begin = np.cumsum(length) - length
            n = length - LENGTH + 1
            own = np.repeat(np.arange(len(raw)), n)
            base = begin[own] + np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)
            z, interval = merge_orders(data, base)
            null = np.asarray(rows.column("doc_id").combine_chunks().is_null())
            doc, k1, k2, start = (rows.column(c).combine_chunks().fill_null(0).to_numpy() for c in ("doc_id", "k1", "k2", "start"))
            # texts in order, by one number; with the place in the text it orders the strings
            o = np.lexsort((k2, doc, null))
            text = np.zeros(len(o), np.int64)
            text[o] = np.cumsum(np.concatenate([[False], (k2[o][1:] != k2[o][:-1]) | (doc[o][1:] != doc[o][:-1]) | (null[o][1:] != null[o][:-1])]))
            first = (text << 32) + start - begin
            who = np.repeat(np.arange(len(o), dtype=np.int32), length)
            at = first[who[z]] + z
            new = np.flatnonzero(np.diff(interval, prepend=-1))
            later = np.ones(len(z), bool) if not len(new) else at != np.repeat(np.minimum.reduceat(at, new), np.diff(new, append=len(z)))
            gone = np.zeros(len(data), bool)
            gone[z[later]] = True
            z = np.flatnonzero(gone)
            who = who[z]
            place = start[who] + z - begin[who]
            new = np.concatenate([[True], (who[1:] != who[:-1]) | (z[1:] != z[:-1] + 1)]) if len(who) else np.zeros(0, bool)
            a = np.flatnonzero(new)
            b = np.append(a[1:], len(who)) - 1 if len(a) else a
            return pa.RecordBatch.from_arrays([pa.array(k1[who[a]]), pa.array(k2[who[a]]), pa.array(place[a].astype(np.int32)), pa.array((place[b] + LENGTH).astype(np.int32))], names=["k1", "k2", "start", "stop"])

        n = 0
        for batch in batches:
            known = batch.column("segment").is_null()
            if known.true_count:
                yield batch.filter(known).select(["k1", "k2", "start", "stop"])
                batch = batch.filter(pa.compute.invert(known))
            held.append(batch)
            n += len(batch)
            if n < MERGE:
                continue
            rows = pa.Table.from_batches(held)
            a = rows.column("a").to_numpy()
            cut = int(np.searchsorted(a, a[-1]))  # the last anchor may go on
            if cut:
                yield merge(rows.slice(0, cut))
            rest = rows.slice(cut).combine_chunks()
            held, n = rest.to_batches(), len(rest)
        if n:
            yield merge(pa.Table.from_batches(held))

    return rows.mapInArrow(run, "k1 long, k2 long, start int, stop int")


def remove_repeated_bytes(docs: DataFrame) -> DataFrame:
    """For each row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the bytes that are left).

    A byte goes if a string of LENGTH bytes that covers it also starts earlier: in a text with a smaller
    doc_id, or before in the same text.  Each string holds an anchor (its least ANCHOR-byte hash), so equal
    strings have equal anchors.  Anchors that occur once rule out their strings; the segments around the others
    meet by anchor, and their suffix orders are merged (see merge_orders), which gives the repeated strings.
    Anchors with very many places are split into pieces by what surrounds them first, and pieces that occur once go.

    A null text has no bytes; a null doc_id comes after all others; rows with the same doc_id and text are
    one document; of different texts with one doc_id the one with the smaller hash is the earlier.  doc_id is an
    integer.  Other columns are ignored; an empty table gives an empty result.
    """
    given = keyed(docs)
    twice = written(anchor_hashes(given).groupBy("a").count().filter("count > 1"))
    most = max(HOT, (twice.agg(F.sum("count")).first()[0] or 0) // HOT_MOST)
    hot = np.sort(np.array([r[0] for r in twice.filter(F.col("count") > most).select("a").collect()], np.int64).view(np.uint64))
    pieces = membership(written(piece_keys(given, hot).groupBy("a").count().filter("count > 1").select("a")), "a") if len(hot) else None
    gone = repeats(segments(given, membership(twice, "a"), hot, pieces).repartition("a").sortWithinPartitions("a"))
    spans = gone.groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "stop")).alias("gone"))
    rows = given.join(spans, ["k1", "k2"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {n: [] for n in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")}
            for first, texts in chunks(batch.column(1)):
                for k, text in enumerate(texts, first):
                    found = batch.column(2)[k].as_py() or []
                    a, b = merged(np.array([x["start"] for x in found], np.int64), np.array([x["stop"] for x in found], np.int64))
                    left = b"".join(text[x:y] for x, y in zip([0, *b.tolist()], [*a.tolist(), len(text)], strict=True))
                    for n, v in zip(out, (len(text), len(text) - len(left), len(a), hashlib.sha256(left).hexdigest(), left), strict=True):
                        out[n].append(v)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(out[n], pa.int64()) for n in ("n_bytes", "n_removed", "n_spans")), pa.array(out["kept_sha256"], pa.string()), pa.array(out["kept"], pa.binary())], names=["doc_id", *out])

    return rows.select("doc_id", "text", "gone").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def op10_bwt_merge_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_bytes(load(spark, sf_dir, "documents")).drop("kept")
