"""Near-duplicate groups by a chosen-path set similarity join."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm._spark import keyed, load, may_hold, membership, whole_rows, written
from palimpsest.llm._vec import WHITE, Words, chunks, mix

SHINGLE = 5
#: Independent trees, the level at which their nodes are looked at, and documents of a node that are compared exhaustively.
TREES, LEVEL, NODE = 16, 3, 512
#: Trees and level for documents of larger nodes (the crowd).
CROWD_TREES, CROWD_LEVEL = 64, 8
#: Nodes that share documents are one list, so that a set travels once, if it has so few documents and shingles.
LIST_DOCS, LIST_SHINGLES = 2048, 2_000_000
#: 100 * intersection >= PERCENT * union links two sets.
PERCENT = 85


def shingle_sets(texts: list[bytes], k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts one after the other, and where each text's begin (and the end).

    A text with fewer than k words, but some, has its whole sequence as one shingle.
    """
    w = Words(texts, WHITE, lower=True)
    h, ok = w.grams(k)
    at = np.flatnonzero(ok)
    owner = np.repeat(np.arange(len(texts)), w.count)
    own, hashes = [owner[at]], [h[at]]
    for n in range(1, k):
        short = np.flatnonzero(w.count == n)
        if len(short):
            g, _ = w.grams(n)
            own.append(short)
            hashes.append(mix(g[w.first[short]] + np.uint64(n)))
    o, h = np.concatenate(own), np.concatenate(hashes)
    order = np.lexsort((h, o))
    o, h = o[order], h[order]
    if len(h):
        new = np.concatenate([[True], (o[1:] != o[:-1]) | (h[1:] != h[:-1])])
        o, h = o[new], h[new]
    return h, np.searchsorted(o, np.arange(len(texts) + 1))


def tree_paths(h: np.ndarray, cut: np.ndarray, full: np.ndarray, trees: range, level: int) -> np.ndarray:
    """For each set of `full` its path in each of the trees (by number) after so many levels.

    A node's path gives the factor of a minwise function that no other node of any tree has; its value is the
    step to the child.
    """
    n, at = np.diff(cut)[full], cut[full]
    out = np.empty((len(full), len(trees)), np.uint64)
    for k, r in enumerate(trees):
        path = mix(np.full(len(full), r + 1, np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        for _ in range(level):
            least = np.minimum.reduceat(h * np.repeat(mix(path) | np.uint64(1), n) >> np.uint64(32), at)
            path = mix(path ^ (least * np.uint64(0x9E3779B97F4A7C15)))
        out[:, k] = path
    return out


def _lists(paths: np.ndarray) -> pa.Array:
    return pa.FixedSizeListArray.from_arrays(pa.array(paths.view(np.int64).ravel()), paths.shape[1]).cast(pa.list_(pa.int64()))


def signatures(docs: DataFrame, trees: int = TREES) -> DataFrame:
    """v, k1, k2, n_shingles, the 128-bit hash s1, s2 of the set, and its path in each tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in chunks(batch.column(3)):
                h, cut = shingle_sets(texts)
                n = np.diff(cut)
                full = np.flatnonzero(n)
                sums = np.zeros((2, len(texts)), np.uint64)
                paths = np.zeros((len(texts), trees), np.uint64)
                if len(full):
                    for j, salt in enumerate((0x51, 0xA7)):
                        sums[j, full] = np.add.reduceat(mix(h ^ np.uint64(salt * 0x0101010101010101)), cut[full])
                    paths[full] = tree_paths(h, cut, full, range(trees), LEVEL)
                keys = [batch.column(i).slice(first, len(texts)) for i in range(3)]
                yield pa.RecordBatch.from_arrays([*keys, pa.array(n, pa.int64()), *(pa.array(s.view(np.int64)) for s in sums), _lists(paths)], names=["v", "k1", "k2", "n_shingles", "s1", "s2", "paths"])

    return docs.select("v", "k1", "k2", "text").mapInArrow(run, f"v {dict(docs.dtypes)['v']}, k1 long, k2 long, n_shingles long, s1 long, s2 long, paths array<long>")


def crowd_paths(sets: DataFrame, trees: int = CROWD_TREES) -> DataFrame:
    """v, n_shingles, path: the paths of whole sets in the deeper trees of the crowd, a row for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                own = batch.slice(at, 128)
                items = [np.frombuffer(x, np.uint64) for x in own.column(2).to_pylist()]
                cut = np.concatenate([[0], np.cumsum([len(x) for x in items])])
                paths = tree_paths(np.concatenate(items), cut, np.arange(len(items)), range(TREES, TREES + trees), CROWD_LEVEL)
                yield pa.RecordBatch.from_arrays([own.column(0), own.column(1), _lists(paths)], names=["v", "n_shingles", "paths"])

    found = sets.select("v", "n_shingles", "items").mapInArrow(run, f"v {dict(sets.dtypes)['v']}, n_shingles long, paths array<long>")
    return found.select("v", "n_shingles", F.explode("paths").alias("path"))


def occupied(paths: DataFrame) -> DataFrame:
    """v, n_shingles, path, count: the places in nodes with two documents or more."""
    return written(paths.join(paths.groupBy("path").count().filter("count > 1"), "path"))


def small_lists(places: DataFrame, crowd: DataFrame | None, node: int) -> DataFrame:
    """members: sorted arrays of v to be compared with each other, from the nodes with up to `node` documents.

    A node of crowd documents only is left to the crowd's own trees.  Nodes whose documents lead to one least document
    in two steps become one list if it stays within LIST_DOCS and LIST_SHINGLES; else each is a list of its own.
    """
    own = places.filter(F.col("count") <= node).select("v", "n_shingles", "path")
    if crowd is not None:
        own = own.join(crowd.withColumn("crowded", F.lit(1)), "v", "left")
        own = own.join(own.groupBy("path").agg(F.min(F.coalesce("crowded", F.lit(0))).alias("all")).filter("all = 0"), "path").select("v", "n_shingles", "path")
        own = written(own)
    first = own.groupBy("path").agg(F.min("v").alias("v0"))
    near = own.join(first, "path").groupBy("v").agg(F.min("v0").alias("v1"))
    label = own.join(near, "v").groupBy("path").agg(F.min("v1").alias("label"))
    held = written(own.join(label, "path").select("label", "path", "v", "n_shingles"))
    few = (F.count("*") <= LIST_DOCS) & (F.sum("n_shingles") <= LIST_SHINGLES)
    size = held.select("label", "v", "n_shingles").distinct().groupBy("label").agg(few.alias("few"))
    by = F.when(F.col("few"), F.struct("label", F.lit(0).cast("long").alias("path"))).otherwise(F.struct("label", "path"))
    lists = held.join(size, "label").groupBy(by.alias("by")).agg(F.sort_array(F.collect_set("v")).alias("members"))
    return written(lists.select("members").filter(F.size("members") > 1).distinct())


def block_lists(places: DataFrame, component: DataFrame, node: int) -> DataFrame:
    """members: arrays of v that hold together every two documents of one family whose components differ.

    A family is what large nodes with documents in common hold.  It is dealt out into blocks of half a node,
    compared in pairs; a component of half a node or more has blocks of its own, which are not compared with
    each other.
    """
    first = places.groupBy("path").agg(F.min("v").alias("v0"))
    family = connected(written(places.join(first, "path").filter("v > v0").select(F.col("v").alias("hi"), F.col("v0").alias("lo")).distinct()))
    many = family.withColumnRenamed("component", "f").join(component, "v", "left").select("v", "f", F.coalesce("component", "v").alias("c"))
    count = many.groupBy("f", "c").count().withColumn("big", F.col("count") >= node // 2)
    placed = many.join(count, ["f", "c"]).select("v", "f", F.when(F.col("big"), F.col("c")).alias("c"))
    placed = written(placed.withColumn("h", F.xxhash64("c", F.isnull("c"))))
    width = placed.groupBy("f", "h").agg((F.floor(F.count("*") / (node // 2)) + 1).alias("w"))
    placed = written(placed.join(width, ["f", "h"]).select("v", "f", F.col("c").isNotNull().alias("big"), "h", F.pmod(F.xxhash64("v"), "w").alias("part")))
    blocks = written(placed.select("f", "big", "h", "part").distinct())
    a, b = blocks.alias("a"), blocks.alias("b")
    ahead = F.struct("a.h", "a.part") <= F.struct("b.h", "b.part")
    pairs = a.join(b, (F.col("a.f") == F.col("b.f")) & ahead & ~(F.col("a.big") & (F.col("a.h") == F.col("b.h"))))
    ends = F.explode(F.array_distinct(F.array(F.struct("a.h", "a.part"), F.struct("b.h", "b.part")))).alias("e")
    pairs = pairs.select(F.col("a.f").alias("f"), F.xxhash64("a.h", "a.part", "b.h", "b.part").alias("pair"), ends).select("f", "pair", F.col("e.h").alias("h"), F.col("e.part").alias("part"))
    lists = placed.join(pairs, ["f", "h", "part"]).groupBy("f", "pair").agg(F.sort_array(F.collect_set("v")).alias("members"))
    return written(lists.select("members").filter(F.size("members") > 1))


def links_in(sets: list[np.ndarray], percent: int = PERCENT) -> np.ndarray:
    """For each set the number of the first set of its component: all pairs are compared, on whole sets."""
    m = len(sets)
    size = np.fromiter(map(len, sets), np.int64, m)
    _, token = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(m), size)
    held = np.bincount(token)
    keep = held[token] > 1
    token, owner = token[keep], owner[keep]
    _, token = np.unique(token, return_inverse=True)
    order = np.argsort(token, kind="stable")
    token, owner = token[order], owner[order]
    both = np.zeros((m, m), np.float32)
    width = max(256, (1 << 21) // m)
    for lo in range(0, int(token[-1]) + 1 if len(token) else 0, width):
        a, b = np.searchsorted(token, [lo, lo + width])
        x = np.zeros((m, width), np.float32)
        x[owner[a:b], token[a:b] - lo] = 1
        both += x @ x.T
    n = both.astype(np.int64)
    linked = 100 * n >= percent * (size[:, None] + size[None, :] - n)
    root = np.full(m, -1)
    for i in range(m):
        if root[i] < 0:
            root[i], front = i, np.array([i])
            while len(front):
                front = np.flatnonzero(linked[front].any(0) & (root < 0))
                root[front] = i
    return root


def compare(lists: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """hi, lo: links that connect what is linked in each list, fewer than the list has documents."""
    rows = lists.select(F.xxhash64("members").alias("node"), F.size("members").alias("size"), F.explode("members").alias("v")).join(sets, "v")
    rows = rows.select("node", "size", "v", "items").repartition("node", "size").sortWithinPartitions("node", "size", "v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, names, items = None, [], []

        def links() -> pa.RecordBatch:
            root = links_in([np.frombuffer(x, np.uint64) for x in items], percent)
            pairs = {(max(names[i], names[r]), min(names[i], names[r])) for i, r in enumerate(root.tolist()) if names[i] != names[r]}
            return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], v_type) for k in (0, 1)], names=["hi", "lo"])

        for batch in batches:
            v_type = batch.column(2).type
            for n, s, v, x in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (n, s) != key:
                    if len(names) > 1:
                        yield links()
                    key, names, items = (n, s), [], []
                names.append(v)
                items.append(x)
        if len(names) > 1:
            yield links()

    kind = dict(sets.dtypes)["v"]
    return rows.mapInArrow(run, f"hi {kind}, lo {kind}").distinct()


def connected(edges: DataFrame) -> DataFrame:
    """v, component (its least member) of each end of the edges hi > lo (a written table): alternating large and small stars.

    Each round replaces an edge by one to the least neighbour; a star's centre never gathers its rays.
    """
    state = lambda e: tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo"))).first())
    before = state(edges)
    while True:
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("w")).unionByName(edges.select(F.col("lo").alias("u"), F.col("hi").alias("w")))
        least = both.groupBy("u").agg(F.min("w").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = written(both.filter("w > u").join(least, "u").select(F.col("w").alias("hi"), F.col("m").alias("lo")).distinct())
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi").filter("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        after = written(small.unionByName(least.select("hi", F.col("m").alias("lo"))).distinct())
        now = state(after)
        if now == before:
            found = after.select(F.col("hi").alias("v"), F.col("lo").alias("component"))
            return found.unionByName(found.select(F.col("component").alias("v"), "component").distinct())
        edges, before = after, now


def whole_sets(given: DataFrame, wanted: DataFrame) -> DataFrame:
    """v, n_shingles, items (the shingles as bytes) of the wanted rows (v, k1, k2).

    A bitmap of the wanted keys rules out most other rows where the texts are read; only what may be wanted is shuffled.
    """
    wanted = written(wanted)
    bitmap = membership(wanted, "k2")
    shared = given.sparkSession.sparkContext.broadcast(bitmap)

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            yield batch.filter(pa.array(may_hold(held, batch.column(1).to_numpy().view(np.uint64))))

    def items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in chunks(batch.column(1)):
                h, cut = shingle_sets(texts)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(texts)), pa.array(np.diff(cut), pa.int64()), pa.array([h[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary())], names=["v", "n_shingles", "items"])

    rows = given.select("k1", "k2", "text").mapInArrow(sift, "k1 long, k2 long, text string")
    once = rows.join(wanted, ["k1", "k2"]).select("v", "text")
    return written(once.mapInArrow(items, f"v {dict(wanted.dtypes)['v']}, n_shingles long, items binary"))


def stand_in(docs: DataFrame) -> Column:
    """doc_id; for rows without one a value after all others, from a hash of the text."""
    kind = dict(docs.dtypes)["doc_id"]
    hashed = F.xxhash64(F.lit("no id"), "text")
    late = F.concat(F.lit("\U0010ffff"), hashed.cast("string")) if kind == "string" else (hashed.bitwiseAND(F.lit((1 << 62) - 1)) + (1 << 62)).cast("long")
    return F.coalesce(F.col("doc_id") if kind == "string" else F.col("doc_id").cast("long"), late)


def near_duplicates(docs: DataFrame, trees: int = TREES, percent: int = PERCENT, node: int = NODE) -> DataFrame:
    """For each row: doc_id, k1, k2, n_shingles, component_id (the least doc_id reachable by links), kept.

    A document's set holds the distinct runs of 5 words (lower-cased ASCII).  Rows with equal sets are one
    class first, named by its least doc_id, so a group of copies, however large, is one document from then
    on.  In each of `trees` independent trees a node picks a minwise function by its path; classes with equal
    values there go to the same child.  Nodes at LEVEL with up to `node` documents are compared exhaustively on
    whole sets.  Documents of larger nodes, the crowd, walk CROWD_TREES more trees down to CROWD_LEVEL, where only
    alike sets still meet; nodes that are large even there are compared in blocks.  Links unite to components.

    A pair of similarity s is missed with probability (1 - s**3) ** 16 (2.4e-7 at 0.85, 1e-5 at 0.8), or in the
    crowd (1 - s**8) ** 64 (1.5e-9 and 8e-6).

    Null or empty texts have empty sets and no links.  Rows without doc_id (an integer below 2**62, or a string) count
    as after all others, rows with equal texts among them as one: they join groups, and component_id is null if
    no member has an id.  kept is true for each row of that doc_id that names the component, so of rows repeated with
    it too.  Other columns are ignored; an empty table gives none.
    """
    given = keyed(docs).withColumn("v", stand_in(docs))
    facts = written(signatures(given, trees))
    rep = F.min(F.struct("v", "k1", "k2", "n_shingles", "paths")).alias("rep")
    reps = written(facts.filter("n_shingles > 0").groupBy("s1", "s2").agg(rep).select("s1", "s2", "rep.*"))
    places = occupied(reps.select("v", "n_shingles", F.explode("paths").alias("path")))
    crowd = written(places.filter(F.col("count") > node).select("v").distinct())
    some = not crowd.isEmpty()
    lists = small_lists(places, crowd if some else None, node)
    sets = whole_sets(given, places.select("v").distinct().join(reps.select("v", "k1", "k2"), "v"))
    if some:
        places = occupied(crowd_paths(sets.join(crowd, "v", "left_semi")))
        lists = lists.unionByName(small_lists(places, None, node)).distinct()
    component = connected(written(compare(lists, sets, percent)))
    if some:
        large = places.filter(F.col("count") > node).join(component, "v", "left").select("v", "path", F.coalesce("component", "v").alias("c"))
        mixed = large.groupBy("path").agg(F.min("c").alias("a"), F.max("c").alias("b")).filter("a <> b").select("path")
        mixed = written(large.join(mixed, "path").select("v", "path"))
        if not mixed.isEmpty():
            more = compare(block_lists(mixed, component, node), sets, percent)
            stars = component.filter("v > component").select(F.col("v").alias("hi"), F.col("component").alias("lo"))
            component = connected(written(stars.unionByName(more).distinct()))
    own = written(reps.select("s1", "s2", "v").join(component, "v", "left").select("s1", "s2", F.coalesce("component", "v").alias("component")))
    out = facts.drop("paths").join(own, ["s1", "s2"], "left")
    cid = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("v"))
    # a stand-in for a missing doc_id is no id
    ids = docs.select("doc_id").schema[0].dataType
    named = lambda c: F.when(c < F.lit("\U0010ffff"), c) if ids.simpleString() == "string" else F.when(c < (1 << 62), c)
    return out.select(named(F.col("v")).cast(ids).alias("doc_id"), "k1", "k2", "n_shingles", named(cid).cast(ids).alias("component_id"), (F.col("v") == cid).alias("kept"))


def keep_one(docs: DataFrame, trees: int = TREES, percent: int = 80) -> DataFrame:
    """One row of docs, with all its columns, of each group of near duplicates: that with the least doc_id.

    Rows without doc_id lose to rows with one; of rows that agree in doc_id and text one stays.  A null or empty text is in no
    group.  Columns may have any names; an empty table gives an empty one.
    """
    groups = written(near_duplicates(docs, trees, percent).select("k1", "k2", "kept"))
    rest = whole_rows(docs, groups.filter("not kept"), "left_anti")
    repeated = written(groups.filter("kept").groupBy("k1", "k2").count().filter("count > 1"))
    if repeated.isEmpty():
        return rest
    once = whole_rows(rest, repeated, "left_anti")
    more = whole_rows(rest, repeated, "left_semi").select(F.struct("*").alias("_row"), F.xxhash64("doc_id").alias("_k1"), F.xxhash64("text", "doc_id").alias("_k2"))
    return once.unionByName(more.dropDuplicates(["_k1", "_k2"]).select("_row.*"))


def op4_chosen_path_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(load(spark, sf_dir, "documents")).drop("k1", "k2")


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i : i + 4], ' '))) AS g FROM w WHERE len(w) > 0
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM pairs JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 85 * (p.n + q.n - c)
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM n UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
), least AS (SELECT x, min(y) AS c FROM reach GROUP BY x)
SELECT w.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(c, w.doc_id) AS component_id, w.doc_id = coalesce(c, w.doc_id) AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN least ON least.x = w.doc_id
"""
