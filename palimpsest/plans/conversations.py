"""Queries over conversations: rendering, role patterns, next turns, enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.functions import conversation as c
from palimpsest.functions.similar import ratio, repeats_question, think_mode
from palimpsest.functions.text import normalize, sha256, shingles
from palimpsest.operators import enrich, generate, sample
from palimpsest.plans.messages import table

REASONING = "CASE WHEN role = 'assistant' AND conv_id % 3 = 0 THEN 'bo ' || CAST(turn AS {string}) END"


def nested(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "conversations").withColumn("reasoning_content", F.expr(REASONING.format(string="STRING")))
    return c.nest(rows)


NESTED = f"WITH n AS (SELECT conv_id, list({{'role': role, 'content': text, 'reasoning': {REASONING.format(string='VARCHAR')}}} ORDER BY turn) AS m FROM conversations GROUP BY conv_id)"


def _sql_chr(s: str) -> str:
    return "'" + s.replace("\n", "' || chr(10) || '") + "'"


def _form_sql(name: str) -> str:
    f = c.FORMATS[name]
    one = lambda form: _sql_chr(form.split("{}")[0]) + " || x.content || " + _sql_chr(form.split("{}")[1])
    return f"array_to_string(list_transform(m, lambda x: CASE x.role WHEN 'system' THEN {one(f.system)} WHEN 'user' THEN {one(f.user)} WHEN 'assistant' THEN {one(f.assistant)} END), '') || {_sql_chr(f.open_user)}"


def q_render_history(spark, d):
    return nested(spark, d).select("conv_id", *(sha256(c.render_history("messages", f)).alias(f) for f in c.FORMATS))


def q_render_judge(spark, d):
    return nested(spark, d).select("conv_id", sha256(c.render_for_judge("messages")).alias("thought"), sha256(c.render_for_judge("messages", False)).alias("plain"))


def _judge_sql(thought: bool) -> str:
    text = "CASE WHEN coalesce(x.reasoning, '') <> '' THEN '(rozumowanie asystenta)' || chr(10) || x.reasoning || chr(10) || '(odpowiedź)' || chr(10) || x.content ELSE x.content END" if thought else "x.content"
    return f"sha256(array_to_string(list_transform(m, lambda x: '[' || CASE x.role WHEN 'user' THEN 'Użytkownik' WHEN 'assistant' THEN 'Asystent' WHEN 'system' THEN 'System' ELSE x.role END || ']' || chr(10) || {text}), chr(10) || chr(10)))"


def q_render_training(spark, d):
    return nested(spark, d).select("conv_id", sha256(c.render_training("messages", True, True)).alias("text"))


_think = "CASE WHEN x.role <> 'assistant' THEN '' WHEN coalesce(x.reasoning, '') <> '' THEN '<think>' || chr(10) || x.reasoning || chr(10) || '</think>' || chr(10) WHEN substr(x.content, 1, 7) <> '<think>' THEN '<think></think>' || chr(10) ELSE '' END"


def q_roles(spark, d):
    m = nested(spark, d)
    return m.select("conv_id", c.well_formed("messages").alias("well_formed"), c.user_turns("messages").cast("long").alias("users"), c.has_roles("messages", ["system", "user", "assistant"]).alias("single"), F.array_join(c.roles(c.without_role("messages")), ",").alias("roles"), c.same_mode("messages", F.col("conv_id") % 2 == 0).alias("same_mode"))


def q_turns(spark, d):
    return nested(spark, d).groupBy(c.user_turns("messages").cast("long").alias("users")).agg(F.count("*").alias("n"))


def q_checks(spark, d):
    return nested(spark, d).select("conv_id", F.array_join(c.checks_for("messages"), ",").alias("checks"))


def q_next_turn(spark, d):
    m = nested(spark, d).withColumn("id", F.col("conv_id").cast("string"))
    jobs = generate.ask_jobs(m, 6)
    return jobs.select("id", F.col("turn").cast("long").alias("turn"), "seed", sha256("prompt").alias("prompt"), F.size("history").cast("long").alias("size"))


def q_role_texts(spark, d):
    m = nested(spark, d)
    return m.select("conv_id", *(sha256(c.text_of("messages", r)).alias(r) for r in ("user", "assistant")), sha256(c.text_of("messages", "assistant", "reasoning_content")).alias("reasoning"))


def q_shingles(spark, d):
    m = nested(spark, d).select("conv_id", shingles(c.text_of("messages", "user")).alias("u"), shingles(c.text_of("messages", "assistant")).alias("a"))
    return m.select("conv_id", F.size("u").cast("long").alias("users"), F.size("a").cast("long").alias("assistants"), F.arrays_overlap("u", "a").alias("echo"))


_norm = "list_filter(string_split(trim(regexp_replace(lower({x}), '[^\\p{{L}}\\p{{N}}_]+', ' ', 'g')), ' '), lambda w: w <> '')"
_text = lambda r, f="content": f"array_to_string(list_transform(list_filter(m, lambda x: x.role = '{r}' AND coalesce(x.{f}, '') <> ''), lambda x: x.{f}), chr(10))"
_sh = lambda w: f"CASE WHEN len({w}) >= 8 THEN list_distinct(list_transform(range(1, len({w}) - 6), lambda i: array_to_string({w}[i : i + 7], ' '))) ELSE [] END"


def q_similarity(spark, d):
    """Whether each user turn after the first repeats any earlier one, and the greatest ratio among them."""
    m = nested(spark, d).select("conv_id", F.transform(F.filter("messages", lambda x: x.role == "user"), lambda x: x.content).alias("u"))
    each = m.select("conv_id", "u", F.posexplode("u").alias("turn", "text")).filter("turn > 0").select("conv_id", "turn", "text", F.slice("u", F.lit(1), F.col("turn")).alias("earlier"))
    best = each.select("conv_id", "turn", "text", F.explode("earlier").alias("old")).groupBy("conv_id", "turn").agg(F.max(ratio(normalize("text"), normalize("old"))).alias("ratio"))
    return each.select("conv_id", "turn", repeats_question(F.col("text"), F.col("earlier")).alias("repeats")).join(best, ["conv_id", "turn"])


def q_enrich(spark, d):
    m = nested(spark, d).withColumn("messages", c.without_role("messages")).withColumn("first", F.get(F.filter("messages", lambda x: x.role == "user"), 0).content)
    m = m.filter("first is not null").select(sha256("first").alias("id"), "messages", "conv_id")
    a = m.filter("conv_id % 2 = 0").select("id", F.lit(0).alias("priority"), F.col("conv_id").alias("seq"), F.lit("Mówisz krótko.").alias("system"))
    b = m.select("id", F.lit(1).alias("priority"), F.col("conv_id").alias("seq"), F.concat(F.lit("Rozmowa "), (F.col("conv_id") % 3).cast("string")).alias("system"))
    out = enrich.attach_system(m, enrich.lookup(a.unionByName(b)))
    return out.select("conv_id", F.get("messages", 0).content.alias("system"), "ambiguous", F.size("messages").cast("long").alias("size"))


def q_upsample_turns(spark, d):
    m = nested(spark, d).withColumn("id", F.col("conv_id").cast("string"))
    return sample.upsample(m, 3, c.user_turns("messages") >= 2).select("id")


def q_models(spark, d):
    m = nested(spark, d).select("conv_id", F.lit("a").alias("model"), F.when(F.col("conv_id") % 2 == 0, F.array(F.lit("x"), F.lit("y"))).alias("models"))
    return m.select("conv_id", F.array_join(c.extend_models(F.col("models"), F.col("model"), F.lit("b")), ",").alias("models"))


def q_jobs(spark, d):
    jobs = generate.build_jobs(spark, 200, 11, 2, 3)
    return jobs.withColumns({"subtopics": F.array_join("subtopics", ","), "mode": think_mode("seed", F.lit(0.3))})


def q_generated(spark, d):
    jobs = generate.build_jobs(spark, 200, 11, 2, 3)
    raw = generate.generate(jobs, None, generate.Offline()).withColumn("seq", F.col("id"))
    return generate.finalize_generation(raw).select("id", "raw", "topic")


QUERIES = {
    "q_render_history": (q_render_history, f"{NESTED} SELECT conv_id, " + ", ".join(f"sha256({_form_sql(f)}) AS {f}" for f in c.FORMATS) + " FROM n"),
    "q_render_judge": (q_render_judge, f"{NESTED} SELECT conv_id, {_judge_sql(True)} AS thought, {_judge_sql(False)} AS plain FROM n"),
    "q_render_training": (q_render_training, f"{NESTED} SELECT conv_id, sha256(array_to_string(list_transform(m, lambda x: '<|im_start|>' || x.role || chr(10) || {_think} || x.content || '<|im_end|>' || chr(10)), '') || '<|im_start|>assistant' || chr(10) || '<think>' || chr(10)) AS text FROM n"),
    "q_roles": (q_roles, f"""{NESTED}, r AS (SELECT conv_id, m, array_to_string(list_transform(m, lambda x: x.role), ',') AS r FROM n)
      SELECT conv_id, regexp_full_match(r, 'system(,user,assistant)+') AS well_formed, len(list_filter(m, lambda x: x.role = 'user')) AS users, r = 'system,user,assistant' AS single,
      array_to_string(list_transform(list_filter(m, lambda x: x.role <> 'system'), lambda x: x.role), ',') AS roles, (conv_id % 3 = 0 AND contains(r, 'assistant')) = (conv_id % 2 = 0) AS same_mode FROM r"""),
    "q_turns": (q_turns, "SELECT users, count(*) AS n FROM (SELECT conv_id, count(*) FILTER (role = 'user') AS users FROM conversations GROUP BY conv_id) GROUP BY users"),
    "q_checks": (q_checks, f"{NESTED} SELECT conv_id, 'halucynacje,dobry_przyklad_sft' || CASE WHEN len(list_filter(m, lambda x: coalesce(x.reasoning, '') <> '')) > 0 THEN ',rozumowanie_sensowne' ELSE '' END || CASE WHEN len(list_filter(m, lambda x: x.role = 'user')) >= 2 THEN ',powtorzone_pytania,powtorzone_odpowiedzi' ELSE '' END AS checks FROM n"),
    "q_next_turn": (q_next_turn, f"""{NESTED}, j AS (SELECT *, len(list_filter(m, lambda x: x.role = 'user')) + 1 AS turn FROM n)
      SELECT conv_id::VARCHAR AS id, turn, ('0x' || substr(sha256(conv_id::VARCHAR || ':' || turn::VARCHAR), 1, 8))::BIGINT AS seed, sha256({_form_sql("v13")}) AS prompt, len(m) AS size FROM j WHERE turn <= 6 AND m[1].role = 'system' AND m[-1].role = 'assistant'"""),
    "q_role_texts": (q_role_texts, f"{NESTED} SELECT conv_id, sha256({_text('user')}) AS user, sha256({_text('assistant')}) AS assistant, sha256({_text('assistant', 'reasoning')}) AS reasoning FROM n"),
    "q_shingles": (q_shingles, f"{NESTED}, w AS (SELECT conv_id, {_norm.format(x=_text('user'))} AS u, {_norm.format(x=_text('assistant'))} AS a FROM n), s AS (SELECT conv_id, {_sh('u')} AS u, {_sh('a')} AS a FROM w) SELECT conv_id, len(u) AS users, len(a) AS assistants, len(list_intersect(u, a)) > 0 AS echo FROM s"),
    "q_similarity": (q_similarity, None),
    "q_enrich": (q_enrich, f"""{NESTED}, m AS (SELECT conv_id, list_filter(m, lambda x: x.role <> 'system') AS m FROM n), f AS (SELECT *, sha256(list_filter(m, lambda x: x.role = 'user')[1].content) AS id FROM m WHERE len(list_filter(m, lambda x: x.role = 'user')) > 0),
      d AS (SELECT id, 0 AS p, conv_id, 'Mówisz krótko.' AS s FROM f WHERE conv_id % 2 = 0 UNION ALL SELECT id, 1, conv_id, 'Rozmowa ' || (conv_id % 3)::VARCHAR FROM f),
      l AS (SELECT id, arg_min(s, p * 1000000000 + conv_id) AS s, count(DISTINCT s) > 1 AS ambiguous FROM d GROUP BY id) SELECT conv_id, s AS system, ambiguous, len(m) + 1 AS size FROM f JOIN l USING (id)"""),
    "q_upsample_turns": (q_upsample_turns, "WITH u AS (SELECT conv_id, count(*) FILTER (role = 'user') AS n FROM conversations GROUP BY conv_id) SELECT CASE WHEN k = 0 THEN conv_id::VARCHAR ELSE conv_id::VARCHAR || '#' || k::VARCHAR END AS id FROM (SELECT conv_id, unnest(range(0, CASE WHEN n >= 2 THEN 3 ELSE 1 END)) AS k FROM u)"),
    "q_models": (q_models, "SELECT DISTINCT conv_id, CASE WHEN conv_id % 2 = 0 THEN 'x,y,b' ELSE 'a,b' END AS models FROM conversations"),
    "q_jobs": (q_jobs, None),
    "q_generated": (q_generated, None),
}
