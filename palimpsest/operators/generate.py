"""Row-wise model calls behind a pluggable backend, and what goes before and after them."""

from __future__ import annotations

import hashlib
import time
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.functions.conversation import render_history, render_system_prompt
from palimpsest.functions.rules import POLISH, Pack, classify, clean, self_answer
from palimpsest.functions.text import hash_number, join_list, sha256
from palimpsest.operators.attempts import resolve_attempts, resume
from palimpsest.operators.dedup import dedup_normalized

# The system text of a question job, and personas with their possessives.
SYSTEM = "Rozmowa o {topic}, na przykład o {subs}. {person} pisze teraz jedno krótkie, naturalne pytanie po polsku na jeden z tych tematów. {poss} wiadomość kończy się zaraz po tym pytaniu."
PERSONAS = [("Polak", "Jego"), ("Polka", "Jej")]
#: A small topic table; callers pass their own.
TOPICS = {"ogrodzie": ["pomidorach", "kompoście", "przycinaniu", "trawniku"], "kuchni": ["zupach", "pieczeniu chleba", "kiszonkach", "przyprawach"], "podróżach": ["pociągach", "noclegach", "pakowaniu", "mapach"]}


def topic_table(spark: SparkSession, topics: dict[str, list[str]] = TOPICS) -> DataFrame:
    """number, topic, subtopics."""
    return spark.createDataFrame([(i, t, s) for i, (t, s) in enumerate(topics.items())], "number int, topic string, subtopics array<string>")


def build_jobs(spark: SparkSession, total: int, seed: int, low: int, high: int, topics: dict[str, list[str]] = TOPICS) -> DataFrame:
    """id, system, seed, persona, topic, subtopics: topics in turn, low to high subtopics in a hashed order.

    The same seed and topics give the same jobs, whatever the partitioning.
    """
    table = topic_table(spark, topics)
    h = lambda what: hash_number(F.concat(F.lit(f"{seed}:{what}:"), F.col("id").cast("string")))
    jobs = spark.range(total).withColumn("number", F.pmod("id", F.lit(len(topics))).cast("int")).join(F.broadcast(table), "number")  # one row a topic
    n = (F.lit(low) + F.pmod(h("n"), F.lit(high - low + 1))).cast("int")
    order = F.sort_array(F.transform("subtopics", lambda s: F.struct(sha256(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string"), F.lit(":"), s)).alias("h"), s.alias("s"))))
    who = F.pmod(h("who"), F.lit(len(PERSONAS))).cast("int")
    people = F.array(*(F.struct(F.lit(p).alias("p"), F.lit(q).alias("q")) for p, q in PERSONAS))
    jobs = jobs.withColumns({"subtopics": F.transform(F.slice(order, F.lit(1), n), lambda x: x.s), "_who": F.get(people, who)})
    form = SYSTEM.replace("{topic}", "%1$s").replace("{subs}", "%2$s").replace("{person}", "%3$s").replace("{poss}", "%4$s")
    system = F.format_string(form, F.col("topic"), join_list(F.col("subtopics")), F.col("_who.p"), F.col("_who.q"))
    return jobs.select("id", system.alias("system"), (1 + F.pmod(h("seed"), F.lit(10**9))).alias("seed"), F.col("_who.p").alias("persona"), "topic", "subtopics")


class ModelBackend(Protocol):
    """Answers prompts; called on executors, so it must be picklable. Raise Retry for a passing failure."""

    def complete(self, rows: list[dict]) -> list[dict]: ...


class Retry(Exception):
    """A failure that another try may not meet."""


@dataclass(frozen=True)
class Offline:
    """A deterministic stand-in: the answer follows from the prompt and the seed."""

    openings: tuple[str, ...] = ("Jak zacząć przygodę z tym tematem", "Co warto wiedzieć na początek", "Dlaczego to takie ważne")

    def complete(self, rows: list[dict]) -> list[dict]:
        out = []
        for r in rows:
            n = int(hashlib.sha256(f"{r['prompt']}|{r['seed']}".encode()).hexdigest()[:8], 16)
            out.append({"raw": f"{self.openings[n % len(self.openings)]} numer {n % 997}?", "finish": "stop"})
        return out


@dataclass(frozen=True)
class Settings:
    """Tries after the first, seconds of the linear back-off, rows in a call, calls a second of one task; 0: no limit."""

    retries: int = 2
    backoff: float = 0.0
    rows: int = 32
    rate: float = 0.0
    options: dict = field(default_factory=dict)  # sampling parameters; unset ones are left out


#: What a call adds to a job, beside the number of attempts.
ANSWER = (("raw", pa.string()), ("finish", pa.string()), ("error", pa.string()), ("reasoning", pa.string()), ("ttft", pa.float64()), ("latency", pa.float64()), ("url", pa.string()))


def run_model(jobs: DataFrame, backend: ModelBackend, settings: Settings = Settings(), prompt: str = "prompt", seed: str = "seed") -> DataFrame:
    """The jobs with raw, finish, error, reasoning, ttft, latency, url and attempts; jobs that fail to the end have finish `error`.

    A task calls the backend for `rows` rows at a time and emits as it goes; the number of tasks bounds the calls
    that run at once.  Jobs travel through the call with all their columns, so nothing is joined afterwards, and
    each comes back once.  A column max_tokens is a row's own limit.
    """
    given = jobs.drop(*(n for n, _ in ANSWER), "attempts")
    columns = given.columns
    options = {k: v for k, v in settings.options.items() if v is not None}

    def call(rows: list[dict]) -> tuple[list[dict], int]:
        for tries in range(1, settings.retries + 2):
            pause = settings.backoff * (tries - 1) + (1 / settings.rate if settings.rate else 0)
            if pause:
                time.sleep(pause)
            try:
                return backend.complete(rows), tries
            except Retry as e:
                problem = str(e)[:200]
        return [{"raw": "", "finish": "error", "error": problem}] * len(rows), tries

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, settings.rows):
                own = batch.slice(at, settings.rows)
                prompts, seeds = own.column(own.num_columns - 2).to_pylist(), own.column(own.num_columns - 1).to_pylist()
                most = [{"max_tokens": n} for n in own.column("max_tokens").to_pylist()] if "max_tokens" in columns else [{}] * own.num_rows
                got, tries = call([{"prompt": p, "seed": s, **options, **m} for p, s, m in zip(prompts, seeds, most, strict=True)])
                more = [pa.array([g.get(n) for g in got], t) for n, t in ANSWER]
                yield pa.RecordBatch.from_arrays([*own.columns[:-2], *more, pa.array([tries] * len(got), pa.int32())], names=[*columns, *(n for n, _ in ANSWER), "attempts"])

    kinds = ", ".join([*(f"`{c}` {t}" for c, t in given.dtypes), "raw string, finish string, error string, reasoning string, ttft double, latency double, url string, attempts int"])
    return given.select("*", F.col(prompt).alias("_prompt"), F.col(seed).cast("long").alias("_seed")).mapInArrow(run, kinds)


def generate(jobs: DataFrame, done: DataFrame | None, backend: ModelBackend, settings: Settings = Settings(), form: str = "glimmer", pack: Pack = POLISH) -> DataFrame:
    """Raw rows of the jobs that are not done: the job, the cleaned message, its reason or null, ok."""
    left = jobs if done is None else resume(jobs, done)
    rows = run_model(left.withColumn("prompt", render_system_prompt("system", form)), backend, settings).withColumn("_c", clean(F.col("raw"), pack))
    rows = rows.withColumns({"raw": F.col("_c.raw"), "raw_orig": F.col("_c.raw_orig"), "first": F.col("_c.first")}).drop("_c")
    reason = F.when(F.col("finish") == "error", F.concat(F.lit("błąd: "), F.coalesce("error", F.lit("")))).otherwise(classify(F.col("raw"), F.col("finish"), F.col("first"), F.col("system"), pack))
    return rows.withColumn("reason", reason).withColumns({"ok": F.col("reason").isNull(), "self_answer_suspect": self_answer(F.col("raw"))})


def finalize_generation(raw: DataFrame, seq: str = "seq") -> DataFrame:
    """Accepted messages: the attempt that counts of each job, one for each normalized text."""
    rows = resolve_attempts(raw, "id", seq, "last_good_else_first_error")
    return dedup_normalized(rows.filter("ok"))


def ask_jobs(conversations: DataFrame, target: int | None = None, form: str = "v13", most_chars: int = 0) -> DataFrame:
    """The next user turn of each conversation that wants one: id, turn, target_turns, system, history, seed, prompt."""
    from palimpsest.functions.conversation import user_turns, wants_turn, without_reasoning

    c = conversations.withColumn("target_turns", F.lit(target).cast("int")) if target else conversations
    c = c.filter(wants_turn("messages", F.col("target_turns"))).withColumn("turn", user_turns("messages") + 1)
    if "attempt" not in c.columns:
        c = c.withColumn("attempt", F.lit(0))
    seed = hash_number(F.concat(F.col("id").cast("string"), F.lit(":"), F.col("turn").cast("string"), F.when(F.col("attempt") > 0, F.concat(F.lit(":"), F.col("attempt").cast("string"))).otherwise("")))
    out = c.select("id", "turn", "target_turns", F.get("messages", 0).content.alias("system"), without_reasoning("messages").alias("history"), "attempt", seed.alias("seed"), render_history("messages", form).alias("prompt"))
    return out.filter(F.length("prompt") <= most_chars) if most_chars else out


def instances(specs: DataFrame, spec: str = "spec") -> DataFrame:
    """url: the addresses of a comma-separated list, in order; an address that ends with a range of ports stands for one of each port."""
    parts = specs.select(F.explode(F.split(spec, ",")).alias("part")).select(F.rtrim(F.trim("part"), F.lit("/")).alias("part")).filter("part <> ''")
    ends = F.regexp_extract_all("part", F.lit(r"(\d+)"))
    ports = F.sequence(F.element_at(ends, -2).cast("int"), F.element_at(ends, -1).cast("int"))
    base = F.regexp_replace("part", F.lit(r"\d+-\d+$"), F.lit(""))
    each = F.when(F.col("part").rlike(r":\d+-\d+$"), F.transform(ports, lambda p: F.concat(base, p.cast("string")))).otherwise(F.array("part"))
    return parts.select(F.explode(each).alias("url"))
