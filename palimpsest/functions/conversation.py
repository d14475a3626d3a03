"""Conversations as arrays of messages struct(role, content, reasoning_content): expressions over one row."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.functions.text import col

MESSAGE = "struct<role:string,content:string,reasoning_content:string>"


@dataclass(frozen=True)
class Format:
    """How one message of each role is written, and how an open user turn begins."""

    system: str
    user: str
    assistant: str
    open_user: str


# Two chat formats.
FORMATS = {
    "glimmer": Format("<|start|>system<|message|>{}<|eot|>", "<|start|>user<|message|>{}<|eot|>", "<|start|>assistant to=user<|message|>{}<|eot|>", "<|start|>user<|message|>"),
    "v13": Format("<|im_start|>system\n{}<|im_end|>\n", "<|im_start|>user\n{}<|im_end|>\n", "<|im_start|>assistant\n<think></think>\n{}<|im_end|>\n", "<|im_start|>user\n"),
}
ROLE_NAMES = {"user": "Użytkownik", "assistant": "Asystent", "system": "System"}


def nest(rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """key, messages of a table with a row for each message, in order of turn. One conversation is one group."""
    reasoning = F.col("reasoning_content") if "reasoning_content" in rows.columns else F.lit(None).cast("string")
    item = F.struct(F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("content"), reasoning.alias("reasoning_content"))
    own = F.transform(F.sort_array(F.collect_list(item)), lambda m: F.struct(m.role.alias("role"), m.content.alias("content"), m.reasoning_content.alias("reasoning_content")))
    return rows.groupBy(key).agg(own.alias("messages"))


def _each(messages: Column | str, body, between: str) -> Column:
    return F.array_join(F.transform(col(messages), body), between)


def _filled(form: str, text: Column) -> Column:
    a, b = form.split("{}")
    return F.concat(F.lit(a), text, F.lit(b))


def render_history(messages: Column | str, form: str = "v13") -> Column:
    """All messages without reasoning, then an open user turn."""
    f = FORMATS[form]
    one = lambda m: F.when(m.role == "system", _filled(f.system, m.content)).when(m.role == "user", _filled(f.user, m.content)).when(m.role == "assistant", _filled(f.assistant, m.content))
    return F.concat(_each(messages, one, ""), F.lit(f.open_user))


def render_system_prompt(system: Column | str, form: str = "v13") -> Column:
    """The system text and an open user turn."""
    return F.concat(_filled(FORMATS[form].system, col(system)), F.lit(FORMATS[form].open_user))


def _has_reasoning(m: Column) -> Column:
    return F.coalesce(m.reasoning_content != "", F.lit(False))


def render_for_judge(messages: Column | str, with_reasoning: bool = True) -> Column:
    """[Role] and text blocks; roles without a name stay as they are."""

    def one(m: Column) -> Column:
        name = F.lit(None).cast("string")
        for role, shown in ROLE_NAMES.items():
            name = F.when(m.role == role, shown).otherwise(name)
        text = F.when(_has_reasoning(m), F.concat(F.lit("(rozumowanie asystenta)\n"), m.reasoning_content, F.lit("\n(odpowiedź)\n"), m.content)).otherwise(m.content) if with_reasoning else m.content
        return F.concat(F.lit("["), F.coalesce(name, m.role), F.lit("]\n"), text)

    return _each(messages, one, "\n\n")


def render_training(messages: Column | str, thinking: bool | None = None, prompt: bool = False) -> Column:
    """The text of a training chat template: think blocks before assistant turns; an open assistant turn if asked."""

    def one(m: Column) -> Column:
        content = F.coalesce(m.content, F.lit(""))
        think = F.when(m.role != "assistant", "").when(_has_reasoning(m), F.concat(F.lit("<think>\n"), m.reasoning_content, F.lit("\n</think>\n"))).when(F.substring(content, 1, 7) != "<think>", "<think></think>\n").otherwise("")
        return F.concat(F.lit("<|im_start|>"), m.role, F.lit("\n"), think, content, F.lit("<|im_end|>\n"))

    end = ("<|im_start|>assistant\n" + {True: "<think>\n", False: "<think></think>\n", None: ""}[thinking]) if prompt else ""
    return F.concat(_each(messages, one, ""), F.lit(end))


def roles(messages: Column | str) -> Column:
    return F.transform(col(messages), lambda m: m.role)


def has_roles(messages: Column | str, wanted: list[str]) -> Column:
    return roles(messages) == F.array(*map(F.lit, wanted))


def user_turns(messages: Column | str) -> Column:
    return F.size(F.filter(col(messages), lambda m: m.role == "user"))


def well_formed(messages: Column | str) -> Column:
    """system, then user and assistant in turns, once at least."""
    r = roles(messages)
    return (F.size(r) >= 3) & (F.size(r) % 2 == 1) & (F.get(r, 0) == "system") & F.forall(F.transform(r, lambda x, i: (i == 0) | (x == F.when(i % 2 == 1, "user").otherwise("assistant"))), lambda ok: ok)


def wants_turn(messages: Column | str, target: Column) -> Column:
    """Begins with system, ends with assistant, and has fewer user turns than the target."""
    r = roles(messages)
    return F.coalesce((F.get(r, 0) == "system") & (F.element_at(r, -1) == "assistant"), F.lit(False)) & (user_turns(messages) + 1 <= target)


def without_reasoning(messages: Column | str) -> Column:
    return F.transform(col(messages), lambda m: F.struct(m.role.alias("role"), m.content.alias("content")))


def without_role(messages: Column | str, role: str = "system") -> Column:
    return F.filter(col(messages), lambda m: m.role != role)


def text_of(messages: Column | str, role: str, field: str = "content") -> Column:
    """The non-empty texts of one role, a line each."""
    return F.array_join(F.transform(F.filter(col(messages), lambda m: (m.role == role) & F.coalesce(m[field] != "", F.lit(False))), lambda m: m[field]), "\n")


def message(role: str, content: Column, reasoning: Column | None = None) -> Column:
    """Reasoning is absent (null) when empty."""
    r = F.lit(None).cast("string") if reasoning is None else F.when(reasoning != "", reasoning)
    return F.struct(F.lit(role).alias("role"), content.alias("content"), r.alias("reasoning_content"))


def prepend(messages: Column | str, *new: Column) -> Column:
    return F.concat(F.array(*new), col(messages))


def append(messages: Column | str, *new: Column) -> Column:
    return F.concat(col(messages), F.array(*new))


def extend_models(models: Column, model: Column, new: Column) -> Column:
    """One model for each assistant turn: the list so far, or the single model, and the new one."""
    return F.concat(F.coalesce(models, F.array(model)), F.array(new))


def same_mode(messages: Column | str, thinking: Column) -> Column:
    """Whether a conversation's mode agrees with the presence of reasoning in its assistant turns."""
    return F.exists(col(messages), lambda m: (m.role == "assistant") & _has_reasoning(m)) == thinking


# Names of the judge's questions about conversations, in order.
CHECKS, REASONING_CHECKS, MULTI_TURN_CHECKS = ("halucynacje", "dobry_przyklad_sft"), ("rozumowanie_sensowne",), ("powtorzone_pytania", "powtorzone_odpowiedzi")


def checks_for(messages: Column | str, with_reasoning: bool = True) -> Column:
    """Names of the questions that a conversation is asked."""
    lits = lambda names: F.array(*map(F.lit, names))
    none = F.array().cast("array<string>")
    thought = F.exists(col(messages), _has_reasoning) if with_reasoning else F.lit(False)
    return F.concat(lits(CHECKS), F.when(thought, lits(REASONING_CHECKS)).otherwise(none), F.when(user_turns(messages) >= 2, lits(MULTI_TURN_CHECKS)).otherwise(none))
