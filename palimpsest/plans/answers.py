"""Queries over answers, judges' scores and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from palimpsest.functions import conversation as c
from palimpsest.functions.rules import POLISH, classify, classify_sql, echoes
from palimpsest.functions.text import first_line, sha256
from palimpsest.operators import answers, dedup, dialogue, generate, judge, report, sample, tokens
from palimpsest.plans.conversations import NESTED, nested
from palimpsest.plans.messages import ANSWER, SPACE, strip_sql, table
from palimpsest.sources import jsonl

REASONING = "CASE WHEN doc_id % 3 = 0 THEN '' ELSE lang END"
FINISH = "CASE WHEN doc_id % 7 = 0 THEN 'length' ELSE 'stop' END"
THINKING = "doc_id % 2 = 0"


def _answers(spark, d):
    return table(spark, d, "documents").select("doc_id", "source", F.expr(ANSWER).alias("answer"), F.expr(REASONING).alias("reasoning"), F.expr(FINISH).alias("finish"), F.expr(THINKING).alias("thinking"))


def q_answer_status(spark, d):
    s = answers.status(F.col("answer"), F.col("reasoning"), F.col("finish"), F.col("thinking"))
    return _answers(spark, d).select("doc_id", s.alias("status"), answers.accepted(F.col("answer"), F.col("reasoning"), F.col("finish"), F.col("thinking")).alias("ok"))


STATUS = f"""WITH a AS (SELECT doc_id, {ANSWER} AS a, {REASONING} AS r, {FINISH} AS f, {THINKING} AS t FROM documents), s AS (
  SELECT doc_id, CASE WHEN regexp_matches(a, '\\[/?THINK\\]|</?think>') THEN 'niezamknięte rozumowanie' WHEN f <> 'stop' OR a = '' THEN 'ucięte/puste' WHEN t AND r = '' THEN 'brak rozumowania'
         WHEN regexp_matches(a, '<function=|<parameter=|</?tool_call>') THEN 'wywołanie narzędzia' ELSE 'ok' END AS status FROM a)
SELECT doc_id, status, status = 'ok' AS ok FROM s"""


def q_answer_conversations(spark, d):
    m = nested(spark, d).select(F.col("conv_id").cast("string").alias("id"), F.lit("Pytanie?").alias("raw"), F.concat(F.lit("Odpowiedź "), F.col("conv_id").cast("string")).alias("answer"), F.when(F.col("conv_id") % 2 == 0, "bo tak").alias("reasoning"),
                                F.when(F.col("conv_id") % 5 > 0, F.col("messages")).alias("history"), F.when(F.col("conv_id") % 4 == 0, F.array(F.lit("a"))).alias("models"), F.lit("dir/b").alias("model"), F.when(F.col("conv_id") % 6 == 0, "on").otherwise("off").alias("thinking"), (F.col("conv_id") % 9 > 0).alias("ok"))
    out = answers.conversations(m, "System.")
    return out.select("id", F.size("messages").cast("long").alias("n"), sha256(c.text_of("messages", "assistant")).alias("told"), F.get("messages", 0).role.alias("first"), F.array_join("models", ",").alias("models"), "same_mode")


_h = "conv_id % 5 > 0"
CONVERSATIONS = f"""{NESTED} SELECT conv_id::VARCHAR AS id, CASE WHEN {_h} THEN len(m) + 2 ELSE 3 END AS n,
  sha256(CASE WHEN {_h} THEN array_to_string(list_append(list_transform(list_filter(m, lambda x: x.role = 'assistant' AND x.content <> ''), lambda x: x.content), 'Odpowiedź ' || conv_id::VARCHAR), chr(10)) ELSE 'Odpowiedź ' || conv_id::VARCHAR END) AS told,
  CASE WHEN {_h} THEN m[1].role ELSE 'system' END AS first, CASE WHEN NOT {_h} THEN 'b' WHEN conv_id % 4 = 0 THEN 'a,b' ELSE 'dir/b,b' END AS models,
  CASE WHEN {_h} THEN (conv_id % 2 = 0) = (conv_id % 6 = 0) ELSE true END AS same_mode FROM n WHERE conv_id % 9 > 0"""


def q_latencies(spark, d):
    e = table(spark, d, "documents").select("lang", (F.col("n_chars") % 97 / 8.0).alias("ttft"), (F.col("n_chars") % 1009 / 4.0).alias("latency"))
    return report.latencies(e, by=("lang",)).select("lang", "value", F.round("p50", 6).alias("p50"), F.round("p95", 6).alias("p95"))


def _cut(v: str, i: int, m: int) -> str:
    """The exclusive quantile i/m of a sorted list v of numbers."""
    n = f"len({v})"
    j = f"greatest(1, least({i} * ({n} + 1) // {m}, {n} - 1))"
    delta = f"({i} * ({n} + 1) - {j} * {m})"
    return f"CASE WHEN {n} = 1 THEN {v}[1] ELSE ({v}[{j}] * ({m} - {delta}) + {v}[{j} + 1] * {delta}) / {m}::DOUBLE END"


LATENCIES = f"""WITH l AS (SELECT lang, 'ttft' AS value, n_chars % 97 / 8.0::DOUBLE AS x FROM documents UNION ALL SELECT lang, 'latency', n_chars % 1009 / 4.0::DOUBLE FROM documents), v AS (SELECT lang, value, list(x ORDER BY x) AS v FROM l WHERE x IS NOT NULL GROUP BY ALL)
SELECT lang, value, round({_cut("v", 1, 2)}, 6) AS p50, round({_cut("v", 19, 20)}, 6) AS p95 FROM v"""


def q_length_summary(spark, d):
    m = nested(spark, d).select(*(F.length(c.text_of("messages", r)).alias(r) for r in ("user", "assistant")), F.length(c.text_of("messages", "assistant", "reasoning_content")).alias("reasoning"))
    out = report.length_summary(m.withColumn("all", F.col("user") + F.col("assistant") + F.col("reasoning")), ["user", "assistant", "reasoning", "all"])
    return out.select("component", "total", F.round("mean", 6).alias("mean"), F.col("most").alias("most"), *(F.round(q, 6).alias(q) for q in ("median", "p95", "p99")))


_len = lambda r, f="content": f"length(array_to_string(list_transform(list_filter(m, lambda x: x.role = '{r}' AND coalesce(x.{f}, '') <> ''), lambda x: x.{f}), chr(10)))"
LENGTHS = f"""{NESTED}, l AS (SELECT {_len("user")} AS u, {_len("assistant")} AS a, {_len("assistant", "reasoning")} AS r FROM n),
p AS (SELECT unnest(['user', 'assistant', 'reasoning', 'all']) AS component, unnest([u, a, r, u + a + r]) AS x FROM l), v AS (SELECT component, sum(x)::BIGINT AS total, avg(x) AS mean, max(x) AS most, list(x ORDER BY x) AS v FROM p GROUP BY ALL)
SELECT component, total, round(mean, 6) AS mean, most, round({_cut("v", 1, 2)}, 6) AS median, round({_cut("v", 19, 20)}, 6) AS p95, round({_cut("v", 99, 100)}, 6) AS p99 FROM v"""


def q_judge_summary(spark, d):
    s = table(spark, d, "documents").select(F.create_map(F.lit("halucynacje"), F.expr("doc_id % 101 / 128D"), F.lit("dobry_przyklad_sft"), F.expr("n_chars % 89 / 64D")).alias("scores"))
    return judge.summary(s).select("question", "n", "flagged", *(F.round(x, 6).alias(x) for x in ("mean", "p10", "p50", "p90")))


SUMMARY = f"""WITH l AS (SELECT 'halucynacje' AS question, doc_id % 101 / 128::DOUBLE AS x FROM documents UNION ALL SELECT 'dobry_przyklad_sft', n_chars % 89 / 64::DOUBLE FROM documents),
v AS (SELECT question, count(*) AS n, count(*) FILTER (CASE WHEN question = 'halucynacje' THEN x > 0.5 ELSE x < 0.5 END) AS flagged, avg(x) AS mean, list(x ORDER BY x) AS v FROM l WHERE x IS NOT NULL GROUP BY question)
SELECT question, n, flagged, round(mean, 6) AS mean, round({_cut("v", 1, 10)}, 6) AS p10, round({_cut("v", 1, 2)}, 6) AS p50, round({_cut("v", 9, 10)}, 6) AS p90 FROM v"""

#: Instructions of the judge's questions in the queries.
TEXTS = {q: f"Czy {q}?" for q in (*c.CHECKS, *c.REASONING_CHECKS, *c.MULTI_TURN_CHECKS)}


def q_judge_request(spark, d):
    m = nested(spark, d)
    r = judge.request(F.col("messages"), c.checks_for("messages"), TEXTS, "Oceń. ", "Także rozumowanie. ")
    return m.select("conv_id", r.alias("r")).select("conv_id", sha256("r.state").alias("state"), F.size("r.questions").cast("long").alias("n"), F.element_at("r.questions", "halucynacje").instructions.alias("text"))


_block = "'[' || CASE x.role WHEN 'user' THEN 'Użytkownik' WHEN 'assistant' THEN 'Asystent' WHEN 'system' THEN 'System' ELSE x.role END || ']' || chr(10) || CASE WHEN coalesce(x.reasoning, '') <> '' THEN '(rozumowanie asystenta)' || chr(10) || x.reasoning || chr(10) || '(odpowiedź)' || chr(10) || x.content ELSE x.content END"
_thought = "len(list_filter(m, lambda x: coalesce(x.reasoning, '') <> '')) > 0"
REQUEST = f"""{NESTED} SELECT conv_id, sha256('Oceń. ' || CASE WHEN {_thought} THEN 'Także rozumowanie. ' ELSE '' END || 'Rozmowa:' || chr(10) || '\"\"\"' || chr(10) || array_to_string(list_transform(m, lambda x: {_block}), chr(10) || chr(10)) || chr(10) || '\"\"\"') AS state,
  2 + CASE WHEN {_thought} THEN 1 ELSE 0 END + CASE WHEN len(list_filter(m, lambda x: x.role = 'user')) >= 2 THEN 2 ELSE 0 END AS n, 'Czy halucynacje?' AS text FROM n"""


def q_stage_seeds(spark, d):
    docs = table(spark, d, "documents")
    return docs.select("doc_id", dialogue.stage_seed(F.col("doc_id"), F.lit(2), "q", 1).alias("q"), dialogue.stage_seed(F.col("doc_id"), F.lit(2), "a", 0).alias("a"))


def q_probability(spark, d):
    a = F.struct(F.when(F.col("doc_id") % 2 == 0, F.create_map(F.lit("true"), F.expr("doc_id % 10 / 8D"))).alias("probabilities"), F.lit(0.5).alias("noul"))
    return table(spark, d, "documents").select("doc_id", judge.probability(a).alias("p"), judge.flag(judge.probability(a), F.col("doc_id") % 3 == 0).alias("flag"))


def q_merge_conversations(spark, d):
    m = nested(spark, d).filter(F.exists("messages", lambda x: x.role == "user")).select("messages", F.struct(F.concat(F.lit("a/b/"), (F.col("conv_id") % 3).cast("string")).alias("model")).alias("meta"), F.col("conv_id").alias("seq"), F.col("conv_id").alias("source_id"))
    rows = dedup.union_prioritized([("x", m.filter("seq % 2 = 1")), ("x", m.filter("seq % 2 = 0"))])
    return dedup.merge_conversations(rows).select("id", "seq", "meta.model", "source", F.col("priority").cast("long").alias("priority"))


MERGED = f"""{NESTED}, f AS (SELECT conv_id, list_filter(m, lambda x: x.role = 'user')[1].content AS u FROM n WHERE len(list_filter(m, lambda x: x.role = 'user')) > 0)
SELECT sha256(u) AS id, conv_id AS seq, (conv_id % 3)::VARCHAR AS model, 'x' AS source, 1 - conv_id % 2 AS priority FROM f QUALIFY row_number() OVER (PARTITION BY u ORDER BY 1 - conv_id % 2, conv_id) = 1"""


def q_accepted(spark, d):
    rows = table(spark, d, "documents").select("doc_id", F.expr("CASE WHEN doc_id % 3 = 0 THEN 'ok' WHEN doc_id % 3 = 1 THEN 'fail' END").alias("verdict"), (F.col("doc_id") % 4 == 0).alias("ok"))
    return jsonl.accepted(rows).select("doc_id")


def q_shuffled(spark, d):
    docs = sample.shuffled(table(spark, d, "documents").select("doc_id"), 29, "doc_id").limit(50)  # the first of the order
    return docs


def q_percent(spark, d):
    n = table(spark, d, "documents").groupBy("lang").agg(F.count_if(F.col("doc_id") % 8 == 0).alias("part"), F.count("*").alias("whole"))
    return n.select("lang", report.percent("part", "whole").alias("shown"))


def q_script_share(spark, d):
    t = table(spark, d, "documents").select(F.col("lang").alias("model"), F.col("source").alias("variant"), "text")
    return report.script_share(t, "éèüöäßñ").select("model", "variant", F.round("share", 9).alias("share"), "paragraphs")


SHARE = r"""WITH p AS (SELECT lang AS model, source AS variant, unnest(string_split_regex(text, '\n\s*\n')) AS p FROM documents)
SELECT model, variant, round(avg((length(p) - length(regexp_replace(p, '[éèüöäßñ]', '', 'g'))) / length(p)::DOUBLE), 9) AS share, count(*) AS paragraphs FROM p WHERE p <> '' GROUP BY ALL"""


def q_followup_rules(spark, d):
    rows = table(spark, d, "conversations")
    skip = ("kontynuacja rozmowy",)
    return rows.select("conv_id", "turn", classify(F.col("text"), F.lit("stop"), first_line("text"), pack=POLISH, skip=skip).alias("reason"), echoes(F.col("text"), F.concat(F.substring("text", 1, 30), F.lit(". Inne zdanie."))).alias("echo"))


_sentences = f"list_transform(string_split_regex(regexp_replace(substr(text, 1, 30) || '. Inne zdanie.', '([.!?]){SPACE}+', '\\1' || chr(10), 'g'), '\\n'), lambda s: {strip_sql('s')})"
FOLLOWUP = f"SELECT conv_id, turn, {classify_sql('text', chr(39) + 'stop' + chr(39), strip_sql('string_split(text, chr(10))[1]'), skip=('kontynuacja rozmowy',))} AS reason, coalesce(len(list_filter({_sentences}, lambda s: length(s) > 15 AND contains(text, s))) > 0, false) AS echo FROM conversations"


def q_concatenated(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.floor(F.col("doc_id") / 8).alias("batch"), F.sequence(F.lit(1), F.expr("cast(doc_id % 5 + 1 as int)")).alias("tokens"))
    return tokens.concatenated(docs, "batch", "doc_id").select("batch", F.array_join("tokens", ",").alias("tokens"), F.array_join("positions", ",").alias("positions"), F.col("records").cast("long").alias("records"))


CONCATENATED = """WITH r AS (SELECT doc_id, doc_id // 8 AS batch, range(1, doc_id % 5 + 2) AS t FROM documents)
SELECT batch, array_to_string(flatten(list(t ORDER BY doc_id)), ',') AS tokens, array_to_string(flatten(list(list_transform(t, lambda x: x - 1) ORDER BY doc_id)), ',') AS positions, count(*) AS records FROM r GROUP BY batch"""


def q_instances(spark, d):
    s = table(spark, d, "region").select(F.concat(F.lit("http://h"), F.col("r_regionkey").cast("string"), F.lit(":6001-6003, http://b:1/,,x:9")).alias("spec"))
    return generate.instances(s).groupBy("url").agg(F.count("*").alias("n"))


INSTANCES = "SELECT url, count(*) AS n FROM (SELECT unnest(['http://h' || r_regionkey || ':6001', 'http://h' || r_regionkey || ':6002', 'http://h' || r_regionkey || ':6003', 'http://b:1', 'x:9']) AS url FROM region) GROUP BY url"


def q_first_lines(spark, d):
    rows = table(spark, d, "conversations")
    return rows.select("conv_id", "turn", first_line("text").alias("first"), classify(F.col("text"), F.lit("stop"), first_line("text")).alias("reason"))


_line = strip_sql("string_split(text, chr(10))[1]")
QUERIES = {
    "q_answer_status": (q_answer_status, STATUS),
    "q_answer_conversations": (q_answer_conversations, CONVERSATIONS),
    "q_latencies": (q_latencies, LATENCIES),
    "q_length_summary": (q_length_summary, LENGTHS),
    "q_judge_summary": (q_judge_summary, SUMMARY),
    "q_judge_request": (q_judge_request, REQUEST.replace('\\"', '"')),
    "q_stage_seeds": (q_stage_seeds, "SELECT doc_id, ('0x' || substr(sha256(doc_id::VARCHAR || ':2:q:1'), 1, 8))::BIGINT AS q, ('0x' || substr(sha256(doc_id::VARCHAR || ':2:a:0'), 1, 8))::BIGINT AS a FROM documents"),
    "q_probability": (q_probability, "WITH p AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN doc_id % 10 / 8::DOUBLE ELSE 0.5::DOUBLE END AS p FROM documents) SELECT doc_id, p, CASE WHEN doc_id % 3 = 0 THEN p > 0.5 ELSE p < 0.5 END AS flag FROM p"),
    "q_merge_conversations": (q_merge_conversations, MERGED),
    "q_accepted": (q_accepted, "SELECT doc_id FROM documents WHERE doc_id % 3 = 0 OR (doc_id % 3 = 2 AND doc_id % 4 = 0)"),
    "q_shuffled": (q_shuffled, "SELECT doc_id FROM documents ORDER BY sha256('29:' || doc_id::VARCHAR), doc_id LIMIT 50"),
    "q_percent": (q_percent, "SELECT lang, printf('%d (%.1f%%)', count(*) FILTER (doc_id % 8 = 0), 100.0 * count(*) FILTER (doc_id % 8 = 0) / count(*)) AS shown FROM documents GROUP BY lang"),
    "q_script_share": (q_script_share, SHARE),
    "q_followup_rules": (q_followup_rules, FOLLOWUP),
    "q_concatenated": (q_concatenated, CONCATENATED),
    "q_instances": (q_instances, INSTANCES),
    "q_first_lines": (q_first_lines, f"SELECT conv_id, turn, {_line} AS first, {classify_sql('text', chr(39) + 'stop' + chr(39), _line)} AS reason FROM conversations"),
}
