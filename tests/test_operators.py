import itertools
import json
import random
import re
import statistics
import threading
import time
from difflib import SequenceMatcher
from fractions import Fraction
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from palimpsest.functions import conversation as c
from palimpsest.functions import rules, similar, stats, text
from palimpsest.operators import attempts, checks, dedup, dialogue, enrich, generate, judge, report, sample, tokens
from palimpsest.plans import messages
from palimpsest.sources import http_models, jsonl, token_shards
from palimpsest.streaming import runs


def column(spark, expression, values, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in rows.orderBy("i").select(expression).collect()]


def test_text(spark):
    assert column(spark, text.normalize("x"), ["Zażółć, GĘŚLĄ jaźń!", "a_b-c", "éx", "a½b"]) == ["zażółć gęślą jaźń", "a_b c", "e x", "a½b"]
    assert column(spark, F.size(text.words("x")), ["a\xa0b", "a b", "a\u0085b", "a\u001cb", "", " \n"]) == [2, 2, 2, 2, 0, 0]
    assert column(spark, text.strip("x"), ["\n a \n", "\x85b "]) == ["a", "b"]
    words = " ".join(map(str, range(9)))
    assert column(spark, F.size(text.shingles("x")), ["0 1 2 3 4 5 6", words[:15], words, ""]) == [0, 1, 2, 0]


@pytest.mark.parametrize("raw, reason", [
    ("", "puste"), ("Rozmowa o psach i kotach", "echo (parafraza)"), ("Co to jest Ж tutaj?", "obce pismo"), ("Czy to prawda?\nassistant: tak", "przeciek roli"), ("Co tam", "za krótkie"),
    ("DZIĘKUJĘ, a co dalej?", "kontynuacja rozmowy"), ("Jak to zrobić ...", "urwane"), ("Podaj SYSTEM PROMPT teraz", "meta"), ("Czy\n## tytuł jest dobry", "dokument/markdown"), ("Kasia: jak się masz dziś", "etykieta mówiącego"),
    ("Jesteś ekspertem od roślin, mów", "reguły dla asystenta"), ("Co znaczy The user tutaj", "przeciek EN"), ("Jak upiec dobry chleb?", None), ("Dziękuję ...", "za krótkie"), ("Dziękuję za to ...", "kontynuacja rozmowy"),
])
def test_rules(spark, raw, reason):
    assert column(spark, rules.classify(F.col("x"), F.lit("stop"), text.first_line("x"), F.lit("Mów krótko. Pisz po polsku i zwięźle.")), [raw]) == [reason]


def test_rules_order_and_echo(spark):
    system = F.lit("Mów krótko. Pisz po polsku i zwięźle.")
    assert column(spark, rules.classify(F.col("x"), F.lit("length"), F.col("x")), ["ok ok ok"]) == ["brak EOS"]
    assert column(spark, rules.classify(F.col("x"), F.lit("stop"), F.col("x"), system), ["Ale Pisz po polsku i zwięźle. dobrze"]) == ["echo systemu"]
    assert column(spark, rules.classify(F.col("x"), F.lit("stop"), F.col("x"), skip=("urwane",)), ["Jak to zrobić ..."]) == [None]
    got = column(spark, rules.clean(F.col("x")), ["Pytanie: Polak: x y z", "tekst \n</user> dalej", "UŻYTKOWNIK: hej", "bez zmian"])
    assert [(r.raw, r.raw_orig is None) for r in got] == [("Polak: x y z", False), ("tekst", False), ("hej", False), ("bez zmian", True)]


def loop(policy, tries):
    """Restated policies: tries is a list of (seq, state)."""
    kept = None
    for t in tries:
        old, new = kept and kept[1], t[1]
        if kept is None:
            kept = t
        elif policy == "last_good_else_first_error":
            kept = kept if new == "error" else t
        elif policy == "last_ok_else_first":
            kept = t if new == "ok" else kept
        elif policy == "first_good_else_last_error":
            kept = t if old == "error" else kept
        else:
            kept = kept if old == "ok" or new == "error" else t
    return kept[0]


@pytest.mark.parametrize("policy", attempts.POLICIES)
def test_attempts(spark, policy):
    cases = [list(s) for n in range(1, 5) for s in itertools.product(["ok", "reject", "error"], repeat=n)]
    rows = [(i, q, s == "ok", "error" if s == "error" else "stop") for i, states in enumerate(cases) for q, s in enumerate(states)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "id int, seq int, ok boolean, finish string").repartition(3)
    got = {r.id: r.seq for r in attempts.resolve_attempts(df, "id", "seq", policy).collect()}
    assert got == {i: loop(policy, list(enumerate(s))) for i, s in enumerate(cases)}


@pytest.mark.parametrize("values", [[5], [1, 2], [1, 2, 3, 4, 7, 10, 20], [3] * 9 + [1]])
def test_quantiles(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v long")
    got = stats.exclusive_quantiles(df, "v", {"p10": Fraction(1, 10), "p50": Fraction(1, 2), "p90": Fraction(9, 10)}).first()
    want = statistics.quantiles(values, n=10) if len(values) > 1 else values * 9
    assert [got.p10, got.p50, got.p90] == pytest.approx([want[0], want[4], want[8]])


def test_dedup_and_merge(spark):
    a = spark.createDataFrame([(1, "x", True), (2, "y", True), (3, "z", False)], "id long, raw string, ok boolean")
    b = spark.createDataFrame([(9, "x", True), (8, "w", True)], "id long, raw string, ok boolean")
    for order, winner in (({"a": a, "b": b}, "a"), ({"b": b, "a": a}, "b")):
        rows = {r.raw: r for r in dedup.merge_questions(dedup.union_prioritized(order)).collect()}
        assert set(rows) == {"x", "y", "w"} and rows["x"].source == winner
    n = spark.createDataFrame([(2, "A b!"), (1, "a  B"), (3, "c")], "id long, raw string")
    assert sorted(r.id for r in dedup.dedup_normalized(n).collect()) == [1, 3]


def conv(spark, *rows):
    return spark.createDataFrame([(i, [(r, t, None) for r, t in ms]) for i, ms in enumerate(rows)], f"i int, messages array<{c.MESSAGE}>").orderBy("i")


def test_conversations(spark):
    s, u, a = ("system", "S"), ("user", "U"), ("assistant", "A")
    df = conv(spark, [s, u, a], [u, a], [s, u, a, a], [s, u], [s, u, a, u, a])
    assert [r[0] for r in df.select(c.well_formed("messages")).collect()] == [True, False, False, False, True]
    assert [r[0] for r in df.select(c.wants_turn("messages", F.lit(2))).collect()] == [True, False, True, False, False]
    assert df.select(c.render_history("messages")).first()[0] == "<|im_start|>system\nS<|im_end|>\n<|im_start|>user\nU<|im_end|>\n<|im_start|>assistant\n<think></think>\nA<|im_end|>\n<|im_start|>user\n"


def test_judge(spark):
    s = {k: 1.0 if want else 0.0 for k, want in judge.CHECKS.items()}
    rows = [s, s | {"prosba": 0.7}, s | {"prosba": 0.69994}, s | {"prosba": 0.69996}, s | {"glos_czatbota": 0.3}, s | {"glos_czatbota": 0.3002}]
    assert column(spark, judge.failed_checks("x"), rows, "map<string,double>") == [[], [], ["prosba"], [], [], ["glos_czatbota"]]


def test_enrich_fails_on_wrong_input(spark):
    table = spark.createDataFrame([("h", "S", False)], "id string, system string, ambiguous boolean")
    def df(i, ms):
        return spark.createDataFrame([(i, [(r, t, None) for r, t in ms])], f"id string, messages array<{c.MESSAGE}>")
    import hashlib

    good = hashlib.sha256(b"U").hexdigest()
    for i, ms in (("bad", [("user", "U")]), (good, [("user", "U")]), (good, [("user", "U"), ("system", "S")])):
        with pytest.raises(PySparkException):
            enrich.attach_system(df(i, ms), table).collect()


def test_samples_hold_under_repartition(spark):
    df = spark.range(500)
    got = [sorted(r.id for r in sample.sample_exactly(x, 20, 3).collect()) for x in (df, df.repartition(7))]
    assert got[0] == got[1] and len(got[0]) == 20
    with pytest.raises(ValueError):
        sample.sample_exactly(df, 501, 3)
    copies = sample.upsample(spark.createDataFrame([("a", 1), ("b", 2)], "id string, n int"), 3, F.col("n") >= 2)
    assert sorted(r.id for r in copies.collect()) == ["a", "b", "b#1", "b#2"]
    parts = {r.id: r.part for r in copies.select("id", sample.split("id", 0.5).alias("part")).collect()}
    assert parts["b"] == parts["b#1"] == parts["b#2"]


def test_similarity(spark):
    pairs = [("abcd", "bcde"), ("", ""), ("a" * 300, "a" * 250 + "b"), ("xyz", "xyz")]
    df = spark.createDataFrame(pairs, "a string, b string")
    assert [r[0] for r in df.select(similar.ratio(F.col("a"), F.col("b"))).collect()] == [SequenceMatcher(None, a, b).ratio() for a, b in pairs]


def test_followups(spark):
    history = [("system", "S", None), ("user", "Jak upiec chleb na zakwasie?", None), ("assistant", "jeden dwa trzy cztery pięć sześć siedem osiem dziewięć", None)]
    df = spark.createDataFrame([(0, "Jak upiec chleb na zakwasie", history), (1, "Czemu jeden dwa trzy cztery pięć sześć siedem osiem?", history), (2, "Dziękuję, a co z mąką żytnią?", history)], f"i int, x string, h array<{c.MESSAGE}>")
    got = df.orderBy("i").select(similar.classify_followup(F.col("x"), F.lit("stop"), F.col("x"), F.lit("S"), F.col("h"))).collect()
    assert [r[0] for r in got] == ["powtórzenie pytania", "echo odpowiedzi", None]


def test_entropy_and_mass(spark):
    logs = [[float(np.log(0.5)), float(np.log(0.3))], [0.0, -40.0], [float(np.log(0.7)), float(np.log(0.3000001))]]
    got = column(spark, stats.bucket_entropy("x"), logs, "array<double>")
    want = []
    for row in logs:
        p = np.exp(row)
        t = min(1, max(0, 1 - p.sum()))
        want.append(-(p * row).sum() - (t * np.log(t) if t > 0 else 0))
    assert got == pytest.approx(want) and np.isfinite(got).all()


def test_chunks_and_batches(spark):
    n = [5, 1, 9, 0, 3, 7, 2, 2, 8, 4]
    df = spark.createDataFrame(list(enumerate(n)), "id int, tokens int").repartition(3)
    got = [r.chunk for r in tokens.chunk_bounds(df, 3).orderBy("id").collect()]
    offsets = np.concatenate([[0], np.cumsum(n)])
    cuts = [0, *np.searchsorted(offsets, np.linspace(0, offsets[-1], 4)[1:-1]).tolist(), len(n)]
    assert got == [k for k in range(3) for _ in range(cuts[k + 1] - cuts[k])]
    one = df.withColumn("g", F.lit(0))
    batch = [r.batch for r in tokens.greedy_batches(one, 10, "g", "id").orderBy("id").collect()]
    want, used, b, some = [], 0, 0, False
    for x in n:
        if some and used + x - 1 > 10:
            b, used = b + 1, 0
        used, some = used + x - 1, True
        want.append(b)
    assert batch == want


def test_topk_totals_must_match(spark):
    pos = spark.createDataFrame([([-0.1, -3.0], -0.1, True)] * 4, "logp array<double>, target_logp double, top1_hit boolean")
    chunk = tokens.topk_stats(pos).withColumns({"records": F.lit(2), "k": F.lit(2), "model": F.lit("m"), "cache": F.lit("c")})
    good = spark.createDataFrame([(2, 6)], "records int, tokens int")
    assert tokens.finalize_topk(chunk, good).first().complete
    with pytest.raises(PySparkException):
        tokens.finalize_topk(chunk, spark.createDataFrame([(2, 7)], "records int, tokens int")).collect()
    with pytest.raises(ValueError):
        tokens.iterations(10, 8, 2)


def test_jsonl_order_and_sinks(spark, tmp_path):
    for i, lines in enumerate([["a"] * 50, ["b"], ["c"] * 5]):
        (tmp_path / f"f{i}.jsonl").write_text("".join(json.dumps({"x": x}) + "\n" for x in lines))
    df = jsonl.read(spark, str(tmp_path), "x string")
    assert [r.x for r in df.orderBy("seq").collect()] == ["a"] * 50 + ["b"] + ["c"] * 5
    assert [r.x for r in jsonl.read(spark, str(tmp_path), "x string", limit=51).collect()][-1] == "b"
    jsonl.write(df, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).count() == 56
    with pytest.raises(PySparkException):
        jsonl.write(df, str(tmp_path / "out"), "errorifexists")
    assert jsonl.pinned(spark, str(tmp_path / "meta"), {"seed": 1}) == {"seed": 1}
    with pytest.raises(ValueError):
        jsonl.pinned(spark, str(tmp_path / "meta"), {"seed": 2})


def test_token_shards(spark, tmp_path):
    (tmp_path / "s").mkdir()
    (tmp_path / "s/a.tokens.bin").write_bytes(np.array([1, 2, 60000, 4], "<u2").tobytes())
    (tmp_path / "s/a.masks.bin").write_bytes(bytes([0, 1, 1, 0]))
    (tmp_path / "s/a.offsets.bin").write_bytes(np.array([0, 1, 4], "<u8").tobytes())
    (tmp_path / "m.json").write_text(json.dumps({"format": tokens.MANIFEST_FORMAT, "shards": [{"prefix": "a", "records": 2}, {"prefix": "b", "records": 0}]}))
    got = token_shards.records(spark, str(tmp_path / "s")).orderBy("record").collect()
    assert [(r.prefix, r.tokens, r.masks) for r in got] == [("a", [1], [0]), ("a", [2, 60000, 4], [1, 1, 0])]
    assert [r.prefix for r in token_shards.manifest(spark, str(tmp_path / "m.json")).collect()] == ["a"]
    with pytest.raises(ValueError):
        token_shards.manifest(spark, str(tmp_path / "m.json"), "other")


def test_model_calls(spark):
    class Flaky:
        """Fails whenever a batch holds seed 3; a short while for seed 5."""

        def complete(self, rows):
            if any(r["seed"] == 3 for r in rows):
                raise generate.Retry("down")
            return generate.Offline().complete(rows)

    jobs = spark.range(8).selectExpr("id", "cast(id as string) AS prompt", "id AS seed")
    got = {r.id: r for r in generate.run_model(jobs, Flaky(), generate.Settings(retries=1, rows=1)).collect()}
    assert len(got) == 8 and got[3].finish == "error" and got[3].attempts == 2 and got[3].error == "down" and got[4].finish == "stop"
    a = generate.build_jobs(spark, 50, 1, 2, 3)
    assert sorted(a.collect()) == sorted(a.repartition(5).collect()) and {len(r.subtopics) for r in a.collect()} == {2, 3}
    specs = spark.createDataFrame([("http://a:1-3, http://b/",)], "spec string")
    assert [r.url for r in generate.instances(specs).collect()] == ["http://a:1", "http://a:2", "http://a:3", "http://b"]


def test_dialogue(spark):
    class Asker:
        """A question from the seed, so that each call differs; none good for prompts with 'bad', errors for 'down'."""

        def complete(self, rows):
            if any("down" in r["prompt"] for r in rows):
                raise generate.Retry("down")
            return [{"raw": "" if "bad" in r["prompt"] else f"Jak {''.join(chr(97 + int(x, 16)) for x in f'{r['seed'] * 2654435761 % 16**16:016x}' * 3)} działa nazwa {r['seed'] % 9973}?", "finish": "stop"} for r in rows]

    class Answerer:
        """Names the question that it was asked; cut off while the seed is odd for prompts with 'cut'."""

        def complete(self, rows):
            return [{"raw": "Odpowiedź na " + r["prompt"].split("nazwa ")[-1].split("?")[0], "finish": "length" if "cut" in r["prompt"] else "stop"} for r in rows]

    m = lambda s: [("system", s, None), ("user", "U", None), ("assistant", "A", None)]
    rows = [("x", m("S"), 2), ("y", m("S"), 3), ("z", m("S")[1:], 3), ("bad", m("bad"), 3), ("down", m("down"), 3), ("cut", m("cut"), 3), ("long", m("l" * 20000), 3)]
    df = spark.createDataFrame([(*r, ["one"]) for r in rows], f"id string, messages array<{c.MESSAGE}>, target_turns int, models array<string>")
    got = {r.id: r for r in dialogue.converse(df, Asker(), Answerer(), "dir/model", settings=generate.Settings(retries=0, rows=1)).collect()}
    assert {k: (r.turns, r.ok, r.finish, r.stage, r.reason) for k, r in got.items()} == {
        "x": (2, True, "stop", "koniec", None), "y": (3, True, "stop", "koniec", None), "z": (1, True, "stop", "koniec", None), "bad": (1, False, "stop", "pytanie", "puste"),
        "down": (1, False, "error", "pytanie", "błąd: down"), "cut": (1, False, "stop", "odpowiedź", "ucięte"), "long": (1, False, "stop", "pytanie", "za długa historia"),
    }
    assert got["y"].models == ["one", "model", "model"] and got["y"].tries == [1, 1] and got["cut"].tries == [1]
    for i in (3, 5):  # the answer belongs to the question that is stored
        assert got["y"].messages[i].content.endswith(f"działa nazwa {got['y'].messages[i + 1].content.split()[-1]}?")
    assert got["y"].messages[3].content != got["y"].messages[5].content
    kept = dialogue.finished(spark.createDataFrame([(1, "stop", 2, m("S")), (2, "error", 3, m("S")), (3, "stop", 1, m("S"))], f"id int, finish string, turns int, messages array<{c.MESSAGE}>"), False).collect()
    assert [(r.id, len(r.messages)) for r in kept] == [(1, 2)]


def test_http_models(spark):
    asked = []

    class Handler(BaseHTTPRequestHandler):
        def log_message(self, *a):
            pass

        def reply(self, status, kind, body):
            self.send_response(status)
            self.send_header("Content-Type", kind)
            self.end_headers()
            self.wfile.write(body)

        def do_GET(self):
            self.reply(200, "application/json", json.dumps({"data": [{"id": "dir/m", "max_model_len": 4096}, {"id": "n"}]}).encode())

        def do_POST(self):
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            asked.append((self.path, body))
            if self.path.startswith("/down"):
                return self.reply(500, "text/plain", b"down")
            if body.get("prompt") == "refuse":
                return self.reply(400, "text/plain", b"too long")
            if "systemone" in self.path:
                return self.reply(200, "application/json", json.dumps({"answers": {"q": {"noul": 0.25}}}).encode())
            if body.get("prompt") == "slow":
                time.sleep(1.5)
            if "chat" in self.path:
                parts = [{"delta": {"reasoning_content": "bo"}}, {"delta": {"content": "tak"}}, {"delta": {}, "finish_reason": "stop"}]
            else:
                parts = [{"text": "a"}, {"text": "b", "finish_reason": "length"}]
            lines = [b": hello\n", *(b"data: " + json.dumps({"choices": [p]}).encode() + b"\n\n" for p in parts), b"data: [DONE]\n", b"data: broken"]
            self.reply(200, "text/event-stream", b"".join(lines))

    server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    url = f"http://127.0.0.1:{server.server_port}"
    try:
        assert http_models.models(url) == [("dir/m", 4096), ("n", None)]
        one = http_models.Server((f"{url}/down", url), model="m", options={"top_p": 0.5})
        ok, refused = one.complete([{"prompt": "x", "seed": 2}, {"prompt": "refuse", "seed": 1}])
        assert (ok["raw"], ok["finish"], ok["url"]) == ("ab", "length", url) and ok["ttft"] <= ok["latency"]
        assert refused["finish"] == "rejected" and refused["error"] == "HTTP 400: too long"
        assert [p for p, _ in asked] == ["/down/completions", "/completions", "/completions"] and asked[1][1] == {"model": "m", "stream": True, "top_p": 0.5, "prompt": "x", "seed": 2}
        again = http_models.Server((url,), retries=1, refusal_is_final=False).complete([{"prompt": "refuse", "seed": 0}])[0]
        assert again["finish"] == "error" and [p for p, _ in asked][3:] == ["/completions"] * 2
        for limits in (http_models.Timeouts(first=0.3), http_models.Timeouts(total=0.3)):
            assert http_models.Server((url,), retries=0, timeouts=limits).complete([{"prompt": "slow"}])[0]["finish"] == "error"
        chat = http_models.Chat((url,)).complete([{"prompt": json.dumps([{"role": "user", "content": "x"}]), "seed": 0}, {"prompt": "plain"}])
        assert [(r["raw"], r["reasoning"], r["finish"]) for r in chat] == [("tak", "bo", "stop")] * 2 and asked[-1][1]["messages"] == [{"role": "user", "content": "plain"}]
        jobs = spark.createDataFrame([(1, '{"state": "s"}', 0)], "id int, prompt string, seed int")
        judged = generate.run_model(jobs, http_models.Judge((url,))).first()
        assert json.loads(judged.raw) == {"q": {"noul": 0.25}} and judged.finish == "stop" and judged.url == url
    finally:
        server.shutdown()


def test_checks(spark):
    df = spark.createDataFrame([(1, "a")], "x int, y string")
    assert checks.expect_count(df, 0) is df and checks.expect_count(df, 1) is df and checks.expect_columns(df, ["x"], more=True) is df
    for wrong in (lambda: checks.expect_count(df, 2), lambda: checks.expect_columns(df, ["x"]), lambda: checks.expect_columns(df, ["x", "y", "z"], more=True)):
        with pytest.raises(ValueError):
            wrong()
    turns = spark.createDataFrame([([("system", "S", None), ("user", "U", None), ("assistant", "A", None)],)], f"messages array<{c.MESSAGE}>")
    assert checks.expect_turns(turns) is turns
    with pytest.raises(ValueError):
        checks.expect_turns(turns.selectExpr("slice(messages, 2, 2) AS messages"))
    with pytest.raises(ValueError):
        tokens.checked_iterations(spark.createDataFrame([(5,)], "records long"), 6, 10, 4)
    assert tokens.checked_iterations(spark.createDataFrame([(5,)], "records long"), 5, 10, 4) == 3


def test_inputs_of_one_folder_are_two(spark, tmp_path):
    for name, rows in (("a", ["1", "2"]), ("b", ["2", "3"])):
        (tmp_path / f"{name}.jsonl").write_text("\n".join(json.dumps({"x": r}) for r in rows) + "\n")
    got = jsonl.read_prioritized(spark, [str(tmp_path / "b.jsonl"), str(tmp_path / "a.jsonl")], "x string").collect()
    assert sorted((r.x, r.priority, r.source) for r in got) == [("1", 1, tmp_path.name), ("2", 0, tmp_path.name), ("2", 1, tmp_path.name), ("3", 0, tmp_path.name)]


def test_shards_of_one_name_and_sinks(spark, tmp_path):
    for k, folder in enumerate(("d1", "d2")):
        (tmp_path / "s" / folder).mkdir(parents=True)
        for kind, data in (("tok", np.array([k, 7], "<u2")), ("mask", np.array([1, 1], np.uint8)), ("off", np.array([0, 2], "<u8"))):
            (tmp_path / "s" / folder / f"a.{kind}").write_bytes(data.tobytes())
    got = token_shards.records(spark, str(tmp_path / "s"), (".tok", ".mask", ".off"))
    assert sorted((r.prefix, r.tokens) for r in got.collect()) == [("d1/a", [0, 7]), ("d2/a", [1, 7])]
    top = spark.createDataFrame([(0, 0, 0, [(-0.5, 3), (-1.0, 9)]), (1, 1, 0, [(-0.25, 4), (-2.0, 5)])], "chunk int, record long, position int, top array<struct<logp:double,id:int>>")
    out, marks = str(tmp_path / "top"), str(tmp_path / "marks")
    assert token_shards.not_done(top.select("chunk"), marks).count() == 2
    token_shards.write_topk(top, out, 2)
    token_shards.write_topk(top.filter("chunk = 1"), out, 2)
    assert sorted((r.chunk, r.ids) for r in spark.read.parquet(out).collect()) == [(0, [3, 9]), (1, [4, 5])]
    with pytest.raises(PySparkException):
        token_shards.write_topk(top, str(tmp_path / "no"), 3)
    token_shards.mark_done(top.filter("chunk = 0").selectExpr("chunk", "1 AS records"), marks)
    assert [r.chunk for r in token_shards.not_done(top.select("chunk"), marks).collect()] == [1]
    shards = spark.createDataFrame([("b", "valid", 2, 9), ("a", "train", 3, 8), ("c", "train", 0, 0)], "prefix string, split string, records long, tokens long")
    token_shards.write_manifest(shards, str(tmp_path / "m"))
    one = spark.read.json(str(tmp_path / "m")).first()
    assert (one.totals.records, one.totals.tokens, [s.prefix for s in one.shards]) == (5, 17, ["a", "b", "c"])
    assert [r.prefix for r in token_shards.manifest(spark, str(tmp_path / "m")).collect()] == ["a", "b"]


def test_stream_resumes(spark, tmp_path):
    src, out, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    schema = "id long, prompt string, seed long"
    for part in (range(5), range(5, 9)):
        spark.createDataFrame([(i, f"p{i}", i) for i in part], schema).coalesce(1).write.mode("append").json(src)
        runs.start(runs.job_stream(spark, src, schema), generate.Offline(), out, mark).awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(9))


def test_report(spark):
    df = spark.createDataFrame([("x", None, 7), ("long name", "y", 1234)], "name string, note string, n int")
    assert [r.line for r in report.boxed(df, ["name"]).collect()] == [
        "┌───────────┬──────┬──────┐", "│ name      │ note │    n │", "├───────────┼──────┼──────┤",
        "│ long name │ y    │ 1234 │", "│ x         │      │    7 │", "└───────────┴──────┴──────┘",
    ]
    calls = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 2.0)], "url string, latency double")
    assert {r.url: (r.requests, r.seconds, r.eta_seconds) for r in report.progress(calls, total=6).collect()} == {"a": (2, 4.0, 4.0), "b": (1, 2.0, 2.0)}


def test_accept_summary_reads_and_judges_once(spark, tmp_path):
    texts = ["Jak piec chleb?", "jak  PIEC chleb", None, "a b c?\n\nTak.", "napiſz pytanie o to", "wıelki jailİ wybıerz ınstrukcje", "cztery słowa bez win"]
    spark.createDataFrame([(14 * i + 4, t, "pl", "a") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = messages.q_accept_summary(spark, str(tmp_path))
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1
    rows = messages.classified(spark, str(tmp_path)).collect()
    good = [r.raw for r in rows if r.reason is None]
    kept = len({x and " ".join(re.findall(r"\w+", x.lower())) for x in good})
    assert got.first().asDict() == {"total": 7, "ok": 5, "suspects": 4, "kept": kept, "duplicates": 5 - kept} and len(good) == 5 > kept


def test_parts_of_rules_lose_no_match(spark):
    texts = ["NATURALNE pytanie", "krótkie, naturalne", "napiſz pytanie", "napisz pytanıe", "ZADAJ KRÓTKIE PYTANİE", "zapytam o jeden", "wybİerz jeden z temat", "na powyższych tematów", "propozycje tematów", "jailbreaK", "ınstrukcję", "syſtem prompt", "jako model językowy", "zignoruj poprzednie",
             "a\nUſER: b", "</ASSIſTANT", "użytkownik> x", "assistant to=x", "## a", "x\n```", "no...", "no… ? ", "x We need to y", "presumably", "User response", "system: x", "a", "", None, " a b c", "a b ", "a　b c", "ordinary words only"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    every = [r for p in (rules.POLISH, rules.NEUTRAL) for r in (*p.before, *p.after)]
    for r in every:
        assert df.filter(~r.found(F.col("t")).eqNullSafe(F.col("t").rlike(r.java()))).count() == 0, r.reason
    assert all(df.filter(~text.has_words("t", n).eqNullSafe(F.size(text.words("t")) >= n)).count() == 0 for n in (1, 2, 3))
