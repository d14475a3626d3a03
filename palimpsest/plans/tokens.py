"""Queries over numbers: quantiles, token chunks and batches, top-k distributions, speed windows."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import functions as F

from palimpsest.functions import stats
from palimpsest.operators import report, sample, tokens
from palimpsest.plans.messages import table
from palimpsest.streaming.runs import speed

CUTS = {"p10": Fraction(1, 10), "p50": Fraction(1, 2), "p90": Fraction(9, 10), "p95": Fraction(19, 20), "p99": Fraction(99, 100)}


def q_quantiles(spark, d):
    return stats.exclusive_quantiles(table(spark, d, "documents"), "n_chars", CUTS, ("lang",))


def _cut_sql(q: Fraction) -> str:
    i, m = q.numerator, q.denominator
    j = f"greatest(1, least({i} * (len(a) + 1) // {m}, len(a) - 1))"
    return f"CASE WHEN len(a) = 1 THEN a[1]::DOUBLE ELSE (a[{j}]::DOUBLE * ({m} - ({i} * (len(a) + 1) - {j} * {m})) + a[{j} + 1]::DOUBLE * ({i} * (len(a) + 1) - {j} * {m})) / {m} END"


def q_length_stats(spark, d):
    c = table(spark, d, "conversations").groupBy("conv_id").agg(F.sum(F.length("text")).alias("n"))
    own = c.agg(F.count("*").alias("conversations"), F.sum("n").alias("total"), F.max("n").alias("longest"), F.round(F.avg("n"), 6).alias("mean"))
    return own.join(F.broadcast(report.over(c, "n", (256, 1024, 4096))))  # one row each


def q_chunk_bounds(spark, d):
    return tokens.chunk_bounds(table(spark, d, "documents"), 7, "n_chars", "doc_id")


def q_greedy_batches(spark, d):
    return tokens.greedy_batches(table(spark, d, "documents").select("lang", "doc_id", F.col("n_chars").alias("tokens")), 20000, "lang", "doc_id")


def _positions(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", "label", stats.log_softmax("embedding").alias("l"))
    e = e.select("vec_id", "label", stats.top_k("l", 5).alias("top"), F.get("l", F.expr("cast(vec_id % 64 as int)")).alias("target_logp"))
    return e.select("vec_id", "label", "target_logp", F.transform("top", lambda x: x.logp).alias("logp"), F.transform("top", lambda x: x.id).alias("ids"), (F.get("top", 0).id == F.col("vec_id") % 64).alias("top1_hit"))


def q_topk(spark, d):
    return _positions(spark, d).select("vec_id", F.array_join("ids", ",").alias("ids"), F.round(stats.mass("logp"), 6).alias("mass"), F.round(stats.bucket_entropy("logp"), 6).alias("entropy"))


SOFTMAX = """WITH z AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
 l AS (SELECT vec_id, label, list_transform(e, lambda x: x - (list_max(e) + ln(list_sum(list_transform(e, lambda y: exp(y - list_max(e))))))) AS l FROM z),
 u AS (SELECT vec_id, unnest(l) AS v, unnest(range(0, len(l))) AS i FROM l),
 t AS (SELECT vec_id, list(v ORDER BY r) AS logp, list(i ORDER BY r) AS ids FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY v DESC, i) AS r FROM u) WHERE r <= 5 GROUP BY vec_id),
 p AS (SELECT vec_id, label, l[vec_id % 64 + 1] AS target, ids, logp, list_sum(list_transform(logp, lambda x: exp(x))) AS mass, -list_sum(list_transform(logp, lambda x: exp(x) * x)) AS head FROM l JOIN t USING (vec_id)),
 h AS (SELECT *, head - CASE WHEN 1 - mass > 0 THEN (1 - mass) * ln(1 - mass) ELSE 0 END AS entropy FROM p)"""


def q_topk_stats(spark, d):
    out = tokens.topk_stats(_positions(spark, d), by=("label",))
    return out.select("label", "positions", "top1_sum", *(F.round(c, 5).alias(c) for c in ("nll_sum", "mass_sum", "mass_min", "entropy_sum", "confidence_sum")))


def q_finalize_topk(spark, d):
    chunks = tokens.topk_stats(_positions(spark, d), by=("label",)).withColumns({"records": F.col("positions"), "k": F.lit(5), "model": F.lit("m"), "cache": F.lit("c")})
    shards = table(spark, d, "embeddings").agg(F.count("*").alias("records"), (2 * F.count("*")).alias("tokens"))
    out = tokens.finalize_topk(chunks, shards)
    return out.select("records", "positions", "complete", *(F.round(c, 5).alias(c) for c in ("nll", "top1_rate", "mass", "mass_min", "entropy", "confidence")))


def _shards(spark, d):
    docs = table(spark, d, "documents")
    return docs.groupBy(F.col("source").alias("prefix")).agg(F.count("*").alias("records"), F.sum("n_chars").alias("tokens")).withColumn("split", F.when(F.substring("prefix", -1, 1).isin("0", "5"), "valid").otherwise("train"))


SHARDS = "WITH s AS (SELECT source AS prefix, count(*) AS records, sum(n_chars)::BIGINT AS tokens, CASE WHEN source[-1] IN ('0', '5') THEN 'valid' ELSE 'train' END AS split FROM documents GROUP BY source)"


def q_shard_totals(spark, d):
    return tokens.shard_totals(_shards(spark, d))


def q_first_shards(spark, d):
    return sample.first_shards(_shards(spark, d), 3)


PATTERN = ", ".join(map(str, tokens.THINK_OFF))


def q_think_mask(spark, d):
    t = F.concat(F.sequence(F.lit(1), F.expr("cast(doc_id % 5 + 1 as int)")), F.array(*map(F.lit, tokens.THINK_OFF)), F.expr("if(doc_id % 2 = 0, array(7, 8), array(9))"), F.when(F.col("doc_id") % 3 == 0, F.array(*map(F.lit, tokens.THINK_OFF))).otherwise(F.array(F.lit(31981))))
    docs = table(spark, d, "documents").select("doc_id", t.alias("t"))
    masked = docs.withColumn("keep", tokens.kd_mask("t", F.transform("t", lambda x: (x % 7).cast("short"))))
    return masked.select("doc_id", F.array_join(F.transform("keep", lambda x: x.cast("int")), "").alias("keep"), tokens.after_first("t", 31977).alias("after"))


THINK = f"""WITH d AS (SELECT doc_id, range(1, doc_id % 5 + 2) || [{PATTERN}] || CASE WHEN doc_id % 2 = 0 THEN [7, 8] ELSE [9] END || CASE WHEN doc_id % 3 = 0 THEN [{PATTERN}] ELSE [31981] END AS t FROM documents),
 s AS (SELECT doc_id, t, list_filter(range(1, len(t) - 8), lambda i: t[i : i + 9] = [{PATTERN}]) AS s FROM d)
 SELECT doc_id, array_to_string(list_transform(range(1, len(t) + 1), lambda i: (t[i] % 7 > 0 AND len(list_filter(s, lambda a: i >= a AND i < a + 10)) = 0)::INT), '') AS keep, t[list_position(t, 31977) + 1]::INT AS after FROM s"""


def q_speed_window(spark, d):
    out = speed(table(spark, d, "events"))
    return out.select(F.expr("timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', start)").alias("start"), "n", F.round("per_second", 6).alias("per_second"))


QUERIES = {
    "q_quantiles": (q_quantiles, "WITH s AS (SELECT lang, list(n_chars ORDER BY n_chars) AS a FROM documents GROUP BY lang) SELECT lang, " + ", ".join(f"{_cut_sql(q)} AS {n}" for n, q in CUTS.items()) + " FROM s"),
    "q_length_stats": (q_length_stats, "WITH c AS (SELECT conv_id, sum(length(text))::BIGINT AS n FROM conversations GROUP BY conv_id) SELECT count(*) AS conversations, sum(n)::BIGINT AS total, max(n) AS longest, round(avg(n), 6) AS mean, count(*) FILTER (n > 256) AS over_256, count(*) FILTER (n > 1024) AS over_1024, count(*) FILTER (n > 4096) AS over_4096 FROM c"),
    "q_chunk_bounds": (q_chunk_bounds, "WITH s AS (SELECT doc_id, n_chars, coalesce(sum(n_chars) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS b, sum(n_chars) OVER ()::BIGINT AS e FROM documents) SELECT doc_id, n_chars AS tokens, least(6, b * 7 // e)::INT AS chunk FROM s"),
    "q_greedy_batches": (q_greedy_batches, """WITH RECURSIVE o AS (SELECT lang, doc_id, n_chars AS tokens, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS r FROM documents),
      g AS (SELECT lang, doc_id, tokens, r, tokens - 1 AS used, 0::BIGINT AS batch FROM o WHERE r = 1 UNION ALL
        SELECT o.lang, o.doc_id, o.tokens, o.r, CASE WHEN used + o.tokens - 1 > 20000 THEN o.tokens - 1 ELSE used + o.tokens - 1 END, CASE WHEN used + o.tokens - 1 > 20000 THEN batch + 1 ELSE batch END FROM g JOIN o ON o.lang = g.lang AND o.r = g.r + 1)
      SELECT lang, doc_id, tokens, batch FROM g"""),
    "q_topk": (q_topk, f"{SOFTMAX} SELECT vec_id, array_to_string(ids, ',') AS ids, round(mass, 6) AS mass, round(entropy, 6) AS entropy FROM h"),
    "q_topk_stats": (q_topk_stats, f"{SOFTMAX} SELECT label, count(*) AS positions, sum((ids[1] = vec_id % 64)::INT)::BIGINT AS top1_sum, round(sum(-target), 5) AS nll_sum, round(sum(mass), 5) AS mass_sum, round(min(mass), 5) AS mass_min, round(sum(entropy), 5) AS entropy_sum, round(sum(exp(logp[1])), 5) AS confidence_sum FROM h GROUP BY label"),
    "q_finalize_topk": (q_finalize_topk, f"{SOFTMAX} SELECT count(*) AS records, count(*) AS positions, true AS complete, round(avg(-target), 5) AS nll, round(avg((ids[1] = vec_id % 64)::INT), 5) AS top1_rate, round(avg(mass), 5) AS mass, round(min(mass), 5) AS mass_min, round(avg(entropy), 5) AS entropy, round(avg(exp(logp[1])), 5) AS confidence FROM h"),
    "q_shard_totals": (q_shard_totals, f"{SHARDS} SELECT split, count(*) AS shards, sum(records)::BIGINT AS records, sum(tokens)::BIGINT AS tokens, (sum(tokens) - sum(records))::BIGINT AS positions FROM s GROUP BY split"),
    "q_first_shards": (q_first_shards, f"{SHARDS} SELECT * FROM s WHERE split = 'valid' UNION ALL (SELECT * FROM s WHERE split = 'train' ORDER BY prefix LIMIT 3)"),
    "q_think_mask": (q_think_mask, THINK),
    "q_speed_window": (q_speed_window, "WITH w AS (SELECT unnest(range(0, 5)) AS k, epoch(date_trunc('minute', ts))::BIGINT AS m FROM events) SELECT m - 60 * k AS start, count(*) AS n, round(count(*) / 300.0, 6)::DOUBLE AS per_second FROM w GROUP BY ALL"),
}
