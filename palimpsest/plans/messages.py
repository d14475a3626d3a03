"""Queries over single messages: cleaning, rules, deduplication, attempts, verdicts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.functions import rules
from palimpsest.functions.text import LEFT_THINK, SPACE, TOOL_CALL, basename, hash_number, join_list, normalize, sha256, split_answer, split_reasoning, strip, token_budget
from palimpsest.operators import attempts, dedup, judge, report, sample


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


#: Messages that meet each rule, made from documents; the same expression in both engines.
RAW = """CASE doc_id % 14 WHEN 0 THEN 'Pytanie: ' || text WHEN 1 THEN text || ' ...' WHEN 2 THEN '## ' || text WHEN 3 THEN 'assistant: ' || text
 WHEN 4 THEN text || '?' || chr(10) || chr(10) || 'Tak.' WHEN 5 THEN text || ' Ж' WHEN 6 THEN 'Dziękuję ' || text WHEN 7 THEN text || ' jailbreak'
 WHEN 8 THEN 'Temat ' || text WHEN 9 THEN 'Mowa o tym: The user ' || text WHEN 10 THEN 'ab' WHEN 11 THEN text || '</user> dalej' WHEN 12 THEN 'Jesteś ekspertem ' || text ELSE '' END"""
FINISH = "CASE WHEN doc_id % 29 = 0 THEN 'length' ELSE 'stop' END"
#: Answers with all kinds of think blocks.
ANSWER = """CASE doc_id % 8 WHEN 0 THEN '<think>' || lang || '</think> ' || source WHEN 1 THEN source WHEN 2 THEN '[THINK]a' || chr(10) || lang || '[/THINK]' || source
 WHEN 3 THEN lang || chr(10) || '</think>' || chr(10) || source WHEN 4 THEN '</think>' || source WHEN 5 THEN lang || '</think>  ' WHEN 6 THEN lang || '</think>' || source || '<think>' ELSE lang || '</think><tool_call>' END"""
N_SQL = r"trim(regexp_replace(lower(text), '[^\p{L}\p{N}_]+', ' ', 'g'))"


def strip_sql(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^{SPACE}+', ''), '{SPACE}+\\z', '')"


CLEANED = f"""
WITH r AS (SELECT doc_id, lang, source, text, {RAW} AS raw0, {FINISH} AS finish FROM documents),
c AS (SELECT *, CASE WHEN contains(raw0, '</user') THEN regexp_replace(substr(raw0, 1, instr(raw0, '</user') - 1), '{SPACE}+\\z', '') ELSE raw0 END AS cut FROM r),
m AS (SELECT *, regexp_replace(cut, '(?i){rules.POLISH.prefix}', '') AS raw FROM c),
cleaned AS (SELECT *, {strip_sql("string_split(raw, chr(10))[1]")} AS first, CASE WHEN raw <> raw0 THEN raw0 END AS raw_orig FROM m)
"""


def cleaned(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "documents").select("doc_id", "lang", "source", "text", F.expr(RAW).alias("raw0"), F.expr(FINISH).alias("finish"))
    r = r.withColumn("_c", rules.clean(F.col("raw0")))
    return r.select("doc_id", "lang", "source", "text", "finish", F.col("_c.raw").alias("raw"), F.col("_c.raw_orig").alias("raw_orig"), F.col("_c.first").alias("first"))


def classified(spark: SparkSession, d: str) -> DataFrame:
    return cleaned(spark, d).withColumn("reason", rules.classify(F.col("raw"), F.col("finish"), F.col("first")))


CLASSIFIED = CLEANED + f", classified AS (SELECT *, {rules.classify_sql('raw', 'finish', 'first')} AS reason FROM cleaned)"

#: Attempts: a job is doc_id % 250; each document tries it up to four times.
TRIES = "doc_id % 250 AS id, doc_id * 4 + k AS seq, (doc_id * 7 + k * 3) % 5 < 2 AS ok, CASE WHEN (doc_id * 7 + k * 3) % 5 = 2 THEN 'error' ELSE 'stop' END AS finish"


def tries(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.explode(F.expr("sequence(0L, doc_id % 4)")).alias("k")).selectExpr(TRIES.split(", doc_id * 4")[0], "doc_id * 4 + k AS seq", *(f"{x}" for x in ("(doc_id * 7 + k * 3) % 5 < 2 AS ok", "CASE WHEN (doc_id * 7 + k * 3) % 5 = 2 THEN 'error' ELSE 'stop' END AS finish")))


TRIES_SQL = f"WITH tries AS (SELECT {TRIES} FROM (SELECT doc_id, unnest(range(0, doc_id % 4 + 1)) AS k FROM documents))"
ORDERS = {
    "last_good_else_first_error": "(finish = 'error')::INT, CASE WHEN finish = 'error' THEN seq ELSE -seq END",
    "last_ok_else_first": "(NOT ok)::INT, CASE WHEN ok THEN -seq ELSE seq END",
    "first_good_else_last_error": "(finish = 'error')::INT, CASE WHEN finish = 'error' THEN -seq ELSE seq END",
    "first_ok_else_last_reject_else_first_error": "CASE WHEN ok THEN 0 WHEN finish = 'error' THEN 2 ELSE 1 END, CASE WHEN ok OR finish = 'error' THEN seq ELSE -seq END",
}


def _attempts(policy: str):
    return lambda spark, d: attempts.resolve_attempts(tries(spark, d), "id", "seq", policy)


SCORE = "(('0x' || substr(sha256(doc_id::VARCHAR || ':{c}'), 1, 8))::BIGINT % 10001)"


def scored(spark: SparkSession, d: str) -> DataFrame:
    one = lambda c: (hash_number(F.concat(F.col("doc_id").cast("string"), F.lit(f":{c}"))) % 10001 / 10000).alias(c)
    docs = table(spark, d, "documents").select("doc_id", "lang", *(one(c) for c in judge.CHECKS))
    scores = F.map_from_arrays(F.array(*map(F.lit, judge.CHECKS)), F.array(*judge.CHECKS))
    return docs.select("doc_id", "lang", judge.failed_checks(scores).alias("failed")).withColumn("verdict", judge.verdict("failed"))


_each = ", ".join(f"CASE WHEN {'' if want else '10000 - '}{SCORE.format(c=c)} < 7000 THEN '{c}' END" for c, want in judge.CHECKS.items())
SCORED = f"WITH scored AS (SELECT doc_id, lang, list_filter([{_each}], lambda x: x IS NOT NULL) AS failed FROM documents), s AS (SELECT *, CASE WHEN len(failed) = 0 THEN 'ok' ELSE 'fail' END AS verdict FROM scored)"


def q_normalize_dedup(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "lang", "text")
    kept = dedup.dedup_normalized(docs, "text")
    reason = rules.classify(F.col("text"), F.lit("stop"), strip("text"), None, rules.NEUTRAL)
    return kept.withColumn("reason", F.coalesce(reason, F.lit("ok"))).groupBy("lang", "reason").agg(F.count("*").alias("n"), F.sum("id").alias("ids"))


def q_normalized(spark, d):
    return table(spark, d, "documents").select("doc_id", sha256(normalize("text")).alias("h"))


def q_merge_priority(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "source", F.col("source").alias("priority"), F.col("text").alias("raw"), F.expr("doc_id % 5 <> 0").alias("ok"))
    return dedup.merge_questions(docs).select("id", "source", "source_id")


def q_source_report(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "source", "text")
    return dedup.contribution(docs, dedup.dedup_exact(docs, "text", ["source", "doc_id"]))


def q_clean(spark, d):
    return cleaned(spark, d).select("doc_id", sha256("raw").alias("raw_hash"), "first", F.col("raw_orig").isNotNull().alias("changed"))


def q_reasons(spark, d):
    return report.counts(classified(spark, d), "reason")


def q_top_reasons(spark, d):
    return report.most_common(classified(spark, d), "reason", 5)


def q_accept_summary(spark, d):
    rows = classified(spark, d)
    return dedup.accept_summary(rows, F.col("reason").isNull(), rules.self_answer(F.col("raw")))


def q_split_answer(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.expr(ANSWER).alias("a"), F.expr("doc_id % 3 > 0").alias("thinking"))
    return docs.select("doc_id", split_answer("a", F.col("thinking")).alias("s")).select("doc_id", "s.*")


_on, _at = "doc_id % 3 > 0", "instr(a, '</think>')"
_head, _tail = strip_sql(f"substr(a, 1, greatest({_at} - 1, 0))"), strip_sql(f"substr(a, {_at} + 8)")
SPLIT_ANSWER = f"""
WITH d AS (SELECT doc_id, {ANSWER} AS a FROM documents),
s AS (SELECT doc_id, CASE WHEN NOT ({_on}) THEN '' WHEN {_at} = 0 THEN {strip_sql("a")} ELSE {_head} END AS reasoning,
             CASE WHEN NOT ({_on}) THEN {strip_sql("a")} WHEN {_at} = 0 THEN '' ELSE {_tail} END AS answer, {_at} AS pos FROM d)
SELECT doc_id, reasoning, answer, CASE WHEN {_on} AND pos = 0 THEN 'niezamknięte rozumowanie' WHEN {_on} AND reasoning = '' THEN 'brak rozumowania' WHEN answer = '' THEN 'pusta odpowiedź'
  WHEN regexp_matches(answer, '{LEFT_THINK}') THEN 'tag think w odpowiedzi' WHEN regexp_matches(answer, '{TOOL_CALL}') THEN 'wywołanie narzędzia' END AS reason FROM s
"""


def q_split_reasoning(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.expr(ANSWER).alias("a"), F.expr("CASE WHEN doc_id % 5 = 0 THEN 'given' ELSE '' END").alias("r"))
    return docs.select("doc_id", split_reasoning("a", "r").alias("s")).select("doc_id", "s.*")


_block = rf"(?s)^{SPACE}*(?:<think>(.*?)</think>|\[THINK\](.*?)\[/THINK\]){SPACE}*"
SPLIT_REASONING = f"""
WITH d AS (SELECT doc_id, {ANSWER} AS a, CASE WHEN doc_id % 5 = 0 THEN 'given' ELSE '' END AS r FROM documents)
SELECT doc_id, {strip_sql(f"regexp_replace(a, '{_block}', '')")} AS answer,
  CASE WHEN regexp_matches(a, '{_block}') AND r = '' THEN {strip_sql(f"regexp_extract(a, '{_block}', 1) || regexp_extract(a, '{_block}', 2)")} ELSE r END AS reasoning FROM d
"""


def q_resume(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"))
    return attempts.resume(docs, tries(spark, d))


def q_retry_counts(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"))
    return attempts.resume_counting(docs, tries(spark, d), 3)


def q_hash_seed(spark, d):
    return table(spark, d, "documents").select("doc_id", hash_number(F.concat(F.col("doc_id").cast("string"), F.lit(":2"))).alias("seed"), token_budget("text", 8192, 2048).alias("budget"))


def q_failed_counts(spark, d):
    return judge.failed_counts(scored(spark, d))


def q_verdicts(spark, d):
    return scored(spark, d).groupBy("lang", "verdict").agg(F.count("*").alias("n"), F.sum(F.size("failed")).alias("failures"))


def q_verdict_rows(spark, d):
    return scored(spark, d).select("doc_id", F.array_join("failed", ",").alias("failed"), "verdict")


def q_list_join(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.slice(F.split("text", " ", -1), F.lit(1), F.expr("cast(doc_id % 4 + 1 as int)")).alias("w"), F.concat(F.lit("models/"), F.col("source"), F.lit("/"), F.col("lang")).alias("model"))
    return docs.select("doc_id", join_list(F.col("w")).alias("items"), basename("model").alias("model"))


def q_label_scores(spark, d):
    both = table(spark, d, "labels").join(table(spark, d, "documents").select("doc_id", "lang"), "doc_id")
    return both.groupBy("lang", "quality", "toxic").agg(F.count("*").alias("n"))


def q_sample(spark, d):
    return sample.sample_exactly(table(spark, d, "documents").select("doc_id", "lang"), 100, 7, "doc_id")


def q_select_turns(spark, d):
    return sample.select_turns(table(spark, d, "documents").select("doc_id"), 101, 7, 0.5, key="doc_id")


def q_split(spark, d):
    return table(spark, d, "documents").select("doc_id", sample.split("doc_id", 0.1).alias("part"))


def q_upsample(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "lang")
    return sample.upsample(docs, 3, F.col("lang") == "fr")


def q_round_robin(spark, d):
    return sample.round_robin(table(spark, d, "documents").select("doc_id"), 16, ["doc_id"])


RANKED = "row_number() OVER (ORDER BY sha256('7:' || doc_id::VARCHAR), doc_id)"
QUERIES = {
    "q_normalize_dedup": (q_normalize_dedup, f"""WITH k AS (SELECT * FROM documents QUALIFY row_number() OVER (PARTITION BY {N_SQL} ORDER BY doc_id) = 1)
      SELECT lang, coalesce({rules.classify_sql("text", "'stop'", strip_sql("text"), rules.NEUTRAL)}, 'ok') AS reason, count(*) AS n, sum(doc_id)::BIGINT AS ids FROM k GROUP BY ALL"""),
    "q_normalized": (q_normalized, f"SELECT doc_id, sha256({N_SQL}) AS h FROM documents"),
    "q_merge_priority": (q_merge_priority, "SELECT sha256(text) AS id, source, doc_id::VARCHAR AS source_id FROM documents WHERE doc_id % 5 <> 0 QUALIFY row_number() OVER (PARTITION BY text ORDER BY source, doc_id) = 1"),
    "q_source_report": (q_source_report, "WITH k AS (SELECT source, row_number() OVER (PARTITION BY text ORDER BY source, doc_id) = 1 AS first FROM documents) SELECT source, count(*) AS rows, count(*) FILTER (first) AS kept, count(*) FILTER (NOT first) AS duplicates FROM k GROUP BY source"),
    "q_clean": (q_clean, CLEANED + "SELECT doc_id, sha256(raw) AS raw_hash, first, raw_orig IS NOT NULL AS changed FROM cleaned"),
    "q_reasons": (q_reasons, CLASSIFIED + "SELECT reason, count(*) AS n FROM classified GROUP BY reason"),
    "q_top_reasons": (q_top_reasons, CLASSIFIED + "SELECT reason, count(*) AS n FROM classified WHERE reason IS NOT NULL GROUP BY reason ORDER BY n DESC, reason LIMIT 5"),
    "q_accept_summary": (q_accept_summary, CLASSIFIED + f""", k AS (SELECT *, row_number() OVER (PARTITION BY reason IS NULL, {N_SQL.replace("text", "raw")} ORDER BY doc_id) AS rn FROM classified)
      SELECT count(*) AS total, count(*) FILTER (reason IS NULL) AS ok, count(*) FILTER (reason IS NULL AND regexp_matches(raw, '{rules.SELF_ANSWER}')) AS suspects, count(*) FILTER (reason IS NULL AND rn = 1) AS kept, count(*) FILTER (reason IS NULL AND rn > 1) AS duplicates FROM k"""),
    "q_split_answer": (q_split_answer, SPLIT_ANSWER),
    "q_split_reasoning": (q_split_reasoning, SPLIT_REASONING),
    **{f"q_attempts_{p}": (_attempts(p), f"{TRIES_SQL} SELECT * FROM tries QUALIFY row_number() OVER (PARTITION BY id ORDER BY {o}) = 1") for p, o in ORDERS.items()},
    "q_resume": (q_resume, f"{TRIES_SQL} SELECT doc_id AS id FROM documents WHERE doc_id NOT IN (SELECT id FROM tries WHERE finish <> 'error')"),
    "q_retry_counts": (q_retry_counts, f"""{TRIES_SQL}, t AS (SELECT id, bool_or(ok) AS o, count(*) FILTER (NOT ok AND finish <> 'error') AS n FROM tries GROUP BY id)
      SELECT doc_id AS id, coalesce(n, 0) AS attempt FROM documents LEFT JOIN t ON t.id = doc_id WHERE NOT coalesce(o, false) AND coalesce(n, 0) <= 3"""),
    "q_hash_seed": (q_hash_seed, "SELECT doc_id, ('0x' || substr(sha256(doc_id::VARCHAR || ':2'), 1, 8))::BIGINT AS seed, least(2048, 8192 - length(text) // 2 - 32)::INT AS budget FROM documents"),
    "q_failed_counts": (q_failed_counts, SCORED + 'SELECT "check", count(*) AS n FROM (SELECT unnest(failed) AS "check" FROM s) GROUP BY ALL'),
    "q_verdicts": (q_verdicts, SCORED + "SELECT lang, verdict, count(*) AS n, sum(len(failed))::BIGINT AS failures FROM s GROUP BY ALL"),
    "q_verdict_rows": (q_verdict_rows, SCORED + "SELECT doc_id, array_to_string(failed, ',') AS failed, verdict FROM s"),
    "q_list_join": (q_list_join, "WITH d AS (SELECT doc_id, string_split(text, ' ')[1 : doc_id % 4 + 1] AS w, lang FROM documents) SELECT doc_id, CASE WHEN len(w) <= 1 THEN w[1] ELSE array_to_string(w[1 : len(w) - 1], ', ') || ' albo ' || w[-1] END AS items, lang AS model FROM d"),
    "q_label_scores": (q_label_scores, "SELECT lang, quality, toxic, count(*) AS n FROM labels JOIN documents USING (doc_id) GROUP BY ALL"),
    "q_sample": (q_sample, f"SELECT doc_id, lang FROM documents QUALIFY {RANKED} <= 100"),
    "q_select_turns": (q_select_turns, f"SELECT doc_id, CASE WHEN {RANKED} <= 50 THEN 5 ELSE 2 END AS target_turns FROM documents QUALIFY {RANKED} <= 101"),
    "q_split": (q_split, "SELECT doc_id, CASE WHEN ('0x' || substr(sha256(doc_id::VARCHAR), 1, 8))::BIGINT < 429496729 THEN 'valid' ELSE 'train' END AS part FROM documents"),
    "q_upsample": (q_upsample, "SELECT CASE WHEN k = 0 THEN doc_id::VARCHAR ELSE doc_id::VARCHAR || '#' || k::VARCHAR END AS id, lang FROM (SELECT doc_id, lang, unnest(range(0, CASE WHEN lang = 'fr' THEN 3 ELSE 1 END)) AS k FROM documents)"),
    "q_round_robin": (q_round_robin, "SELECT doc_id, ((row_number() OVER (ORDER BY doc_id) - 1) % 16)::INT AS shard FROM documents"),
}
