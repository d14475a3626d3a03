"""Quality rules: counts of a text, and its distance from what its language looks like. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from palimpsest.llm._spark import keyed, load, small, written

#: Words that a language's histogram tells apart, and the letters of the longest of them.
COMMON_WORDS, LONGEST = 24, 8
#: A text must have so many words and code points, and a reference so many words, before its classes may reject it, and so
#: many words before its common words may: in shorter texts their share is too much by chance.
MIN_WORDS, MIN_CHARS, MIN_REFERENCE, MIN_WORDS_COMMON = 50, 250, 2000, 100
#: Jensen-Shannon distance (0 to 1) of classes beyond which a text is rejected: in the test tables prose is below 0.2, symbols
#: and numbers above 0.3.
MAX_CLASS_DISTANCE = 0.25
#: Of the word distance that a text without any common word has, the share beyond which a text is rejected.  In the test
#: tables texts labelled good reach 0.70, texts given another language's label start at 0.77.
MAX_WORD_SHARE = 0.75
#: Character classes of the histogram; the last class is the rest.
CLASSES = ("[a-z]+", r"[\x20\x09-\x0D]+", "[A-Z]+", "[.,;:!?'\"()-]+", "[0-9]+", r"[^\x00-\x7F]+")
#: Which class parts words; and symbols, which are all in the rest.
BLANKS, SYMBOLS = 1, "[#*$%&|<>]+"
GAP = r"[\x20\x09-\x0D]+"
NO_LETTER = r"[^a-z\x{80}-\x{10FFFF}]+"


def let(value: Column, body) -> Column:
    """body(value) with the value computed once for each row, though body uses it in lambda functions."""
    return F.get(F.transform(F.array(value), body), 0)


def split_words(text: Column, gap: str) -> Column:
    return F.filter(F.split(text, gap, -1), lambda w: w != "")


def repeated_words(grams: Column, k: int = 5) -> Column:
    """Words in k-word windows that a text has twice or more, from the hash of each window.

    Windows are sorted by a 64-bit hash within the row; equal neighbours give the places, whose spans unite.
    """

    def places(s: Column) -> Column:
        return F.filter(s, lambda x, i: F.coalesce(F.get(s, i - 1).h == x.h, F.lit(False)) | F.coalesce(F.get(s, i + 1).h == x.h, F.lit(False)))

    def covered(p: Column) -> Column:
        each = F.transform(p, lambda x, i: F.least(F.lit(k), F.coalesce(F.get(p, i + 1) - x, F.lit(k))))
        return F.aggregate(each, F.lit(0).cast("long"), lambda a, x: a + x)

    pairs = F.sort_array(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    found = let(pairs, lambda s: let(F.sort_array(F.transform(places(s), lambda x: x.i)), covered))
    return F.when(F.size(F.array_distinct(grams)) == F.size(grams), F.lit(0).cast("long")).otherwise(found)


def counted(docs: DataFrame) -> DataFrame:
    """docs (text not null) with the base counts, chars, the sizes of CLASSES (c0, c1, ...), and no text.

    Each step is a column of its own, so that it is computed once: a class is counted by what stripping it takes from what the
    classes before it have left, and windows of 5 words are hashed by joining those of 2 and 4.
    """
    cols = [c for c in docs.columns if c != "text"]
    lines = F.filter(F.split("text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    left = docs.select(*cols, "text", F.length("text").alias("chars"), let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))
    held = [*cols, "chars", "n_dup_lines"]
    left = left.select(*held, F.col("text").alias("left"), F.array_remove(F.split("text", GAP, -1), "").alias("w"))
    for i, c in enumerate(CLASSES):
        left = left.select(*held, "w", "left", F.regexp_replace("left", F.lit(c), F.lit("")).alias("next"))
        held += [f"c{i}"]
        left = left.select(*held[:-1], (F.length("left") - F.length("next")).alias(f"c{i}"), "w", F.col("next").alias("left"))
    symbols = F.length("left") - F.length(F.regexp_replace("left", F.lit(SYMBOLS), F.lit("")))
    left = left.select(*held, symbols.cast("long").alias("n_symbols"), "w")
    held += ["n_symbols"]
    after = lambda c, n: F.slice(c, n + 1, F.greatest(F.size(c) - n, F.lit(0)))
    two = left.select(*held, "w", F.zip_with("w", after("w", 1), lambda a, b: F.xxhash64(a, b)).alias("two"))
    four = two.select(*held, "w", F.zip_with("two", after("two", 2), lambda a, b: F.xxhash64(a, b)).alias("four"))
    five = F.slice(F.zip_with("four", after("w", 4), lambda a, b: F.xxhash64(a, b)), 1, F.greatest(F.size("w") - 4, F.lit(0)))
    grams = four.select(*held, F.size("w").cast("long").alias("n_words"), five.alias("grams"))
    done = grams.select(*held, "n_words", repeated_words(F.col("grams")).alias("n_repeat_words"))
    return done.withColumn("word_chars", (F.col("chars") - F.col(f"c{BLANKS}")).cast("long"))


def common_words(docs: DataFrame) -> DataFrame:
    """lang, words: the COMMON_WORDS most frequent words of each language, ties by the word itself."""
    words = docs.select("lang", F.explode(split_words(F.lower("text"), NO_LETTER)).alias("w")).filter(F.length("w") <= LONGEST)
    top = Window.partitionBy("lang").orderBy(F.desc("n"), "w")
    counts = words.groupBy("lang", "w").agg(F.count("*").alias("n"))
    best = counts.withColumn("rank", F.row_number().over(top)).filter(F.col("rank") <= COMMON_WORDS)
    return best.groupBy("lang").agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", "w"))), lambda x: x.w).alias("words"))


def distance(p: str, q: str) -> Column:
    """Jensen-Shannon distance of two count arrays of one length; 0 if either is empty or all zero."""
    return F.expr(f"""
      coalesce(sqrt(greatest(0D, aggregate(
        zip_with({p}, {q}, (a, b) -> struct(
          a / nullif(aggregate({p}, 0L, (s, x) -> s + x), 0) as p, b / nullif(aggregate({q}, 0L, (s, x) -> s + x), 0) as q)),
        0D, (s, x) -> s + if(x.p > 0, x.p * log2(2 * x.p / (x.p + x.q)) / 2, 0D) + if(x.q > 0, x.q * log2(2 * x.q / (x.p + x.q)) / 2, 0D)))), 0D)
    """)


def quality(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """For each row: doc_id, the kept columns, the base counts, base_failed, class_distance, word_distance, word_limit, kept.

    Two histograms of a text, its character classes and the most common words of its language (with one
    entry for all other words), are compared with those of all base-passing texts of the same lang.  A text
    is rejected if its classes are further off than MAX_CLASS_DISTANCE, or its words further than
    MAX_WORD_SHARE of the distance that a text without any common word has; but only if it and its reference are long
    enough (MIN_WORDS, MIN_CHARS, MIN_REFERENCE, MIN_WORDS_COMMON).  Texts are read twice and never shuffled; what is kept of a row is a few numbers
    (and the kept columns).

    A null text has no words and fails; rows with a null lang form a language of their own.  Repeated rows
    give repeated results, ties between common words go by the word, other columns are ignored, an empty
    table gives an empty result.
    """
    given = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit("\x00")).alias("lang"), *keep)
    common = written(common_words(given))
    top = common.select("lang", F.col("words").alias("top"), F.array_max(F.transform("words", F.length)).alias("longest"))
    rows = given.join(small(top), "lang", "left")
    letters = F.array_remove(F.split(F.lower("text"), NO_LETTER, -1), "")
    rows = rows.select("doc_id", *keep, "lang", "text", "top", "longest", letters.alias("letters"))
    rows = rows.select("doc_id", *keep, "lang", "text", "top", F.size("letters").alias("letters"), F.filter("letters", lambda x: (F.length(x) <= F.col("longest")) & F.array_contains("top", x)).alias("held"))
    hits = F.transform("top", lambda t: F.size("held") - F.size(F.array_remove("held", t)))
    rows = rows.select("doc_id", *keep, "lang", "text", "letters", F.coalesce(hits, F.array().cast("array<int>")).alias("hits"))
    facts = counted(rows)
    size = [F.col(f"c{i}") for i in range(len(CLASSES))]
    others = F.col("letters") - F.aggregate("hits", F.lit(0), lambda a, x: a + x)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    rest = F.col("chars") - sum(size, F.lit(0))
    facts = written(facts.select("doc_id", *keep, "lang", "chars", *base, failed.alias("base_failed"), F.array(*size, rest).cast("array<bigint>").alias("classes"), F.concat("hits", F.array(others)).cast("array<bigint>").alias("words")))

    def total(col: str, n: int) -> Column:
        return F.array(*(F.coalesce(F.sum(F.get(col, F.lit(i))), F.lit(0)) for i in range(n)))

    passing = facts.filter(~F.col("base_failed")).groupBy("lang").agg(total("classes", len(CLASSES) + 1).alias("ref_classes"), total("words", COMMON_WORDS + 1).alias("ref_words"), F.sum("n_words").alias("ref_n"))
    reference = written(passing.join(small(common), "lang", "left").withColumn("ref_words", F.slice("ref_words", 1, F.coalesce(F.size("words"), F.lit(0)) + 1)).drop("words"))
    none = reference.withColumn("none", F.transform("ref_words", lambda x, i: F.when(i == F.size("ref_words") - 1, F.lit(1).cast("long")).otherwise(F.lit(0).cast("long"))))
    reference = none.select("lang", "ref_classes", "ref_words", "ref_n", (MAX_WORD_SHARE * distance("none", "ref_words")).alias("word_limit"))
    far = facts.join(small(written(reference)), "lang", "left").withColumn("class_distance", distance("classes", "ref_classes")).withColumn("word_distance", distance("words", "ref_words"))
    long_enough = (F.col("n_words") >= MIN_WORDS) & (F.col("chars") >= MIN_CHARS) & (F.coalesce("ref_n", F.lit(0)) >= MIN_REFERENCE)
    odd = long_enough & ((F.col("class_distance") > MAX_CLASS_DISTANCE) | (F.col("word_distance") > F.when(F.col("n_words") >= MIN_WORDS_COMMON, F.col("word_limit")).otherwise(1.0)))
    return far.select("doc_id", *keep, *base, "base_failed", (~F.col("base_failed") & ~odd).alias("kept"), "class_distance", "word_distance", "word_limit")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of docs that the rules keep, with all their columns.

    Rows travel with their numbers, so nothing is joined by row and no text is shuffled.  Nulls, repeated rows and empty tables:
    as in quality; columns may have any names.
    """
    return quality(docs.select("doc_id", "text", "lang", F.struct("*").alias("_row")), keep=("_row",)).filter("kept").select("_row.*")


def op1_quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(load(spark, sf_dir, "documents")).drop("class_distance", "word_distance", "word_limit")


def _oracle() -> str:
    js = lambda p, q: f"sqrt(greatest(0, list_sum([CASE WHEN x[1] > 0 THEN x[1] * log2(2 * x[1] / (x[1] + x[2])) / 2 ELSE 0 END + CASE WHEN x[2] > 0 THEN x[2] * log2(2 * x[2] / (x[1] + x[2])) / 2 ELSE 0 END for x in list_transform(range(1, len({p}) + 1), lambda i: [{p}[i] / list_sum({p}), {q}[i] / list_sum({q})])])))"
    size = lambda c: f"length(text) - length(regexp_replace(text, '{c.replace(chr(39), chr(39) * 2)}', '', 'g'))"
    return f"""
WITH t AS (
  SELECT doc_id, coalesce(lang, chr(1)) AS lang, coalesce(text, '') AS text FROM documents
), s AS (
  SELECT *, list_filter(string_split_regex(text, '{GAP}'), lambda x: x <> '') AS w,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines,
         list_filter(string_split_regex(lower(text), '{NO_LETTER}'), lambda x: x <> '') AS letters
  FROM t
), g AS (
  SELECT doc_id, i, array_to_string(w[i : i + 4], ' ') AS gram FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM s)
), twice AS (
  SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, gram) > 1
), repeats AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM twice) GROUP BY doc_id
), counted AS (
  SELECT lang, x, count(*) AS n FROM (SELECT lang, unnest(letters) AS x FROM s) WHERE length(x) <= {LONGEST} GROUP BY ALL
), top AS (
  SELECT lang, list(x ORDER BY rank) AS words FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, x) AS rank FROM counted) WHERE rank <= {COMMON_WORDS} GROUP BY lang
), facts AS (
  SELECT doc_id, s.lang, length(text) AS chars, len(w) AS n_words,
         length(regexp_replace(text, '{GAP}', '', 'g')) AS word_chars, {size(SYMBOLS)} AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
         [{", ".join(size(c) for c in CLASSES)}] AS c,
         list_transform(coalesce(words, []), lambda x: len(list_filter(letters, lambda y: y = x))) AS h, len(letters) AS letters
  FROM s LEFT JOIN repeats r USING (doc_id) LEFT JOIN top ON s.lang = top.lang
), f AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         list_append(c, chars - list_sum(c)) AS classes, list_append(h, letters - coalesce(list_sum(h), 0)) AS words FROM facts
), e AS (
  SELECT lang, k, i, sum(v) AS v FROM (
    SELECT lang, 'c' AS k, unnest(range(1, len(classes) + 1)) AS i, unnest(classes) AS v FROM f WHERE NOT base_failed
    UNION ALL SELECT lang, 'w', unnest(range(1, len(words) + 1)), unnest(words) FROM f WHERE NOT base_failed) GROUP BY ALL
), ref AS (
  SELECT lang, list(v ORDER BY i) FILTER (k = 'c') AS rc, list(v ORDER BY i) FILTER (k = 'w') AS rw FROM e GROUP BY lang
), size AS (SELECT lang, sum(n_words) AS n FROM f WHERE NOT base_failed GROUP BY lang),
j AS (
  SELECT f.*, n, {js("classes", "rc")} AS dc, {js("words", "rw")} AS dw, {MAX_WORD_SHARE} * {js("none", "rw")} AS most
  FROM (SELECT *, list_append(list_transform(h, lambda x: 0), 1) AS none FROM f) f LEFT JOIN ref USING (lang) LEFT JOIN size USING (lang)
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
       n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND NOT (n_words >= {MIN_WORDS} AND chars >= {MIN_CHARS} AND coalesce(n, 0) >= {MIN_REFERENCE}
         AND (coalesce(dc, 0) > {MAX_CLASS_DISTANCE} OR coalesce(dw, 0) > CASE WHEN n_words >= {MIN_WORDS_COMMON} THEN most ELSE 1 END)) AS kept
FROM j
"""


ORACLE = _oracle()
