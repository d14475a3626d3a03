"""Secret scans behind a trigram index. DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from re import _constants as sre
from re import _parser as sre_parse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm._spark import keyed, load, written
from palimpsest.llm.quality import let


@dataclass(frozen=True)
class Rule:
    """Matches of pattern, leftmost and not overlapping; those whose group has under `least` characters are dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(map(_either_case, ("password", "passwd", "secret", "token"))) + "|" + _either_case("api") + "_?" + _either_case("key")
BASE = (
    Rule("assign", rf"({_NAMES})[\x22']?\x20*[:=]\x20*[\x22']?([A-Za-z0-9+/_.=-]+)", 2, 8),
    Rule("access", "AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", "[0-9a-f]{32,}"),  # the runs of [0-9a-f]+ that are long enough
)
MORE = (
    Rule("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("forge_token", "gh[opsu]_[A-Za-z0-9]{30,}"),
    Rule("chat_token", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("cloud_key", "AIza[A-Za-z0-9_-]{30,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]+"),
)
RULES = BASE + MORE
MASK_BITS = 60

# -- Boolean trigram queries -------------------------------------------------------------------------------
Query = tuple  # ("and", q...), ("or", q...), ("tri", t) or ("all",): every text may match
ALL: Query = ("all",)
_MOST = 64  # alternatives of literal text that are followed at once


def _join(op: str, parts: list[Query]) -> Query:
    parts = list(dict.fromkeys(parts))
    if op == "and":
        parts = [p for p in parts if p != ALL]
        return ALL if not parts else parts[0] if len(parts) == 1 else ("and", *parts)
    if ALL in parts or not parts:
        return ALL
    plain = {p: trigrams(p) for p in parts if p[0] == "tri" or p[0] == "and" and all(x[0] == "tri" for x in p[1:])}
    parts = [p for p in parts if p not in plain or not any(t < plain[p] for t in plain.values())]
    return parts[0] if len(parts) == 1 else ("or", *parts)


def _of_literals(words: set[str]) -> Query:
    each = [_join("and", [("tri", w[i : i + 3]) for i in range(len(w) - 2)]) for w in sorted(words)]
    return _join("or", each)


def _walk(tree) -> tuple[set[str] | None, Query]:
    """The lower-cased texts that the tree matches, if few, and the query that all its matches satisfy."""
    open_, needed, exact = {""}, [], True

    def flush() -> None:
        nonlocal open_, exact
        needed.append(_of_literals(open_))
        open_, exact = {""}, False

    def add(words: set[str] | None, query: Query) -> None:
        nonlocal open_
        if words is not None and len(open_) * len(words) <= _MOST:
            open_ = {a + b for a in open_ for b in words}
        else:
            flush()
            needed.append(query)
            if words is not None:
                open_ = words

    for op, arg in tree:
        if op is sre.LITERAL:
            add({chr(arg).lower()}, ALL)
        elif op is sre.IN and all(k is sre.LITERAL for k, _ in arg):
            add({chr(v).lower() for _, v in arg}, ALL)
        elif op is sre.SUBPATTERN:
            add(*_walk(arg[3]))
        elif op is sre.BRANCH:
            found = [_walk(b) for b in arg[1]]
            add(set().union(*(w for w, _ in found)) if all(w is not None for w, _ in found) else None, _join("or", [q if w is None else _of_literals(w) for w, q in found]))
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            low, high, inner = arg
            words, query = _walk(inner)
            if (low, high) == (0, 1) and words is not None:
                add(words | {""}, ALL)
            elif low >= 1 and words is not None:
                for _ in range(min(low, 3)):
                    add(words, query)
                flush()
            else:
                flush()
                if low:
                    needed.append(query)
        else:
            flush()
    if exact:
        return open_, _of_literals(open_)
    needed.append(_of_literals(open_))
    return None, _join("and", needed)


def trigram_query(pattern: str) -> Query:
    """What the lower-cased text of every match of the pattern must hold."""
    return _walk(sre_parse.parse(pattern))[1]


def trigrams(q: Query) -> set[str]:
    return {q[1]} if q[0] == "tri" else set().union(*(trigrams(x) for x in q[1:] if isinstance(x, tuple)))


def _holds(q: Query, number: dict[str, int]) -> Column:
    if q == ALL:
        return F.lit(True)
    if q[0] == "tri":
        n = number[q[1]]
        return F.col(f"m{n // MASK_BITS}").bitwiseAND(F.lit(1 << n % MASK_BITS)) != 0
    return reduce((lambda a, b: a & b) if q[0] == "and" else (lambda a, b: a | b), [_holds(x, number) for x in q[1:]])


# -- index and scan ----------------------------------------------------------------------------------------
def build_index(docs: DataFrame, terms: list[str]) -> DataFrame:
    """Postings: term (its number), k1, k2 for each text whose lower-cased form holds the trigram."""
    all_terms = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(t).alias("t")) for i, t in enumerate(terms)))
    found = let(F.lower("text"), lambda low: F.transform(F.filter(all_terms, lambda x: F.contains(low, x.t)), lambda x: x.i))
    return docs.select("k1", "k2", F.explode(found).alias("term"))


def candidates(index: DataFrame, number: dict[str, int]) -> DataFrame:
    """k1, k2 and, in bits of m0, m1, ..., the terms whose postings hold the row: intersections are tests of bits."""
    masks = []
    for j in range((max(number.values(), default=0)) // MASK_BITS + 1):
        own = F.when(F.floor(F.col("term") / MASK_BITS) == j, F.expr(f"shiftleft(1L, term % {MASK_BITS})")).otherwise(F.lit(0).cast("long"))
        masks.append(F.bit_or(own).alias(f"m{j}"))
    return index.groupBy("k1", "k2").agg(*masks)


def spans(text: Column, rule: Rule) -> Column:
    """start, end (code points) of the rule's matches: the pieces between matches give their places."""
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    kept = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else None
    parts = F.zip_with(F.transform(F.split(text, rule.pattern, -1), F.length), F.transform(found, F.length), lambda g, m: F.struct(g.alias("g"), m.alias("m")))
    empty = F.array().cast("array<struct<s:int,e:int>>")
    placed = F.aggregate(
        F.filter(parts, lambda x: x.m.isNotNull()),
        F.struct(F.lit(0).alias("at"), empty.alias("out")),
        lambda a, x: F.struct((a.at + x.g + x.m).alias("at"), F.concat(a.out, F.array(F.struct((a.at + x.g).alias("s"), (a.at + x.g + x.m).alias("e")))).alias("out")),
        lambda a: a.out,
    )
    if rule.least:
        sizes = F.transform(kept if kept is not None else found, F.length)
        placed = let(sizes, lambda z: F.filter(placed, lambda p, i: F.get(z, i) >= rule.least))
    return F.when(F.size(found) > 0, placed).otherwise(empty)


def _named(found: Column, n: int, kind: str) -> Column:
    return F.transform(found, lambda x: F.struct(x.s.alias("start"), F.lit(n).alias("n"), F.lit(kind).alias("kind"), x.e.alias("end")))


def _count(kind: str) -> Column:
    return F.size(F.filter("spans", lambda x: x.kind == kind)).cast("long")


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, k1, k2 (and the kept columns) of each row with its spans: an array of start, kind number, kind, end.

    Each rule's regular expression gives the trigrams that its matches must hold, as a Boolean query; an
    inverted index of these trigrams is written, its postings are intersected for each text, and the
    expression runs only on texts that satisfy its query.  A rule without mandatory trigrams (hex) runs on
    all.  Spans are ordered by start, then by the rule's place in the list.

    A null text is empty.  Repeated rows get repeated results; other columns do not matter; an empty table
    gives an empty result.
    """
    given = keyed(docs, *keep).withColumn("text", F.coalesce("text", F.lit("")))
    query = {r.kind: trigram_query(r.pattern) for r in rules}
    number = {t: i for i, t in enumerate(sorted(set().union(*map(trigrams, query.values()))))}
    index = written(build_index(given, list(number)))
    masks = candidates(index, number)
    rows = given.join(masks, ["k1", "k2"], "left").na.fill(0, [c for c in masks.columns if c[0] == "m"])
    none = F.array().cast("array<struct<s:int,e:int>>")
    found = []
    for n, r in enumerate(rules):
        own = F.when(_holds(query[r.kind], number), spans(F.col("text"), r)).otherwise(none)
        found.append(_named(own, n, r.kind))
    return rows.select("doc_id", "k1", "k2", "text", *keep, F.sort_array(F.concat(*found)).alias("spans"))


def shown(col: Column) -> Column:
    return F.array_join(F.transform(col, lambda x: F.concat_ws(":", x.kind, x.start.cast("string"), x.end.cast("string"))), ",")


def digest(scanned: DataFrame, base: tuple[Rule, ...] = BASE) -> DataFrame:
    """doc_id, the number of spans of each base kind, base_sha256 and the spans as a string."""
    n = [_count(r.kind).alias(f"n_{r.kind}") for r in base]
    own = F.filter("spans", lambda x: x.n < len(base))
    return scanned.select("doc_id", *n, F.sha2(shown(own).cast("binary"), 256).alias("base_sha256"), shown(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """docs with each maximal run of overlapping or touching spans replaced by the mark, and n_chars as it is then."""
    text = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda a, x: F.struct(
            F.greatest(a.at, x.end).alias("at"),
            F.when((x.start <= a.at) & (a.at > 0), a.out).otherwise(F.concat(a.out, F.substring(F.col("text"), a.at + 1, x.start - a.at), F.lit(mark))).alias("out"),
        ),
        lambda a: F.concat(a.out, F.substring(F.col("text"), a.at + 1, F.length("text"))),
    )
    null = "_null"
    while null in docs.columns:
        null += "_"
    rest = F.struct(F.col("text").isNull().alias(null), *(F.col(f"`{c}`") for c in docs.columns if c != "text"))  # a text is shuffled once
    done = scan(docs.select("doc_id", "text", rest.alias("_row")), keep=("_row",))
    done = done.withColumn("_new", F.when(F.size("spans") > 0, text).when(~F.col(f"_row.{null}"), F.col("text")))
    changed = {"text": F.col("_new")} | ({"n_chars": F.when(F.size("spans") > 0, F.length("_new")).otherwise(F.col("_row.n_chars")).cast(dict(docs.dtypes)["n_chars"])} if "n_chars" in docs.columns else {})
    return done.select(*(changed.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns))


def op3_trigram_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(scan(load(spark, sf_dir, "documents")))


def _oracle() -> str:
    quoted = {r.kind: r.pattern.replace("'", "''") for r in RULES}
    parts = []
    for n, r in enumerate(RULES):
        p = quoted[r.kind]
        size = f"list_transform(regexp_extract_all(x, '{p}', {r.group}), lambda y: length(y))"
        parts.append(f"""SELECT doc_id, {n} AS n, '{r.kind}' AS kind, unnest(list_filter(list_transform(range(1, len(m) + 1), lambda i: {{
              's': list_sum(g[:i]) + coalesce(list_sum(m[:i - 1]), 0), 'e': list_sum(g[:i]) + list_sum(m[:i]), 'k': k[i]}}), lambda z: z.k >= {r.least})) AS z
          FROM (SELECT doc_id, list_transform(string_split_regex(x, '{p}'), lambda y: length(y)) AS g, list_transform(regexp_extract_all(x, '{p}'), lambda y: length(y)) AS m, {size} AS k FROM t WHERE regexp_matches(x, '{p}'))""")
    n_base = ", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in BASE)
    n_out = ", ".join(f"coalesce(n_{r.kind}, 0)::BIGINT AS n_{r.kind}" for r in BASE)
    return f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS x FROM documents),
found AS ({" UNION ALL ".join(parts)}),
own AS (
  SELECT doc_id, {n_base},
         string_agg(kind || ':' || z.s::BIGINT || ':' || z.e::BIGINT, ',' ORDER BY z.s, n) FILTER (n < {len(BASE)}) AS base,
         string_agg(kind || ':' || z.s::BIGINT || ':' || z.e::BIGINT, ',' ORDER BY z.s, n) AS spans
  FROM found GROUP BY doc_id
)
SELECT doc_id, {n_out}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM t LEFT JOIN own USING (doc_id)
"""


ORACLE = _oracle()
