"""Ordered rule packs: a text gets the name of the first rule that holds, or null."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from palimpsest.functions.text import NO_WORD, SPACE, WORD, col, cut_after, first_line, has_words, replace

_END = rf"(?:{NO_WORD}|\z)"


@dataclass(frozen=True)
class Rule:
    """reason holds if the pattern is found; fold: whatever the case, in all scripts.

    parts: strings of which every match holds one (fold: ASCII, lower case); a text without any is not searched.
    """

    reason: str
    pattern: str
    fold: bool = True
    parts: tuple[str, ...] = ()

    def java(self) -> str:
        return f"(?d{'iu' if self.fold else ''}){self.pattern}"

    def re2(self) -> str:
        return f"{'(?i)' if self.fold else ''}{self.pattern}"

    def found(self, raw: Column) -> Column:
        if not self.parts:
            return raw.rlike(self.java())
        some = lambda x: reduce(Column.__or__, (F.contains(x, F.lit(p)) for p in (*self.parts, *(FOLDED if self.fold else ()))))
        may = F.get(F.transform(F.array(F.lower(raw)), some), 0) if self.fold else some(raw)  # lower case is made once
        return may & raw.rlike(self.java())


#: Lower case of the characters beyond ASCII that a folding pattern takes for ASCII letters and that lower() does not make such: long s, dotless i, dotted I.
FOLDED = ("\u017f", "\u0131", "\u0307")


@dataclass(frozen=True)
class Pack:
    """Rules before and after the check of the number of words, prefixes to cut off, and fixed reasons."""

    before: tuple[Rule, ...] = ()
    after: tuple[Rule, ...] = ()
    prefix: str = ""
    least_words: int = 3
    names: dict[str, str] = field(default_factory=lambda: {"unfinished": "unfinished", "empty": "empty", "echo": "echo", "short": "short"})


# Reasons, order and patterns of the Polish pack.
POLISH = Pack(
    before=(
        Rule("echo (parafraza)", rf"^{NO_WORD}*(Rozmow{WORD}*|Temat{_END}|Kontekst|Scena{_END}|Opis{_END}|Pewn[ay] Pol|Pol(ka|ak) (pisze|pyta|zadaje)|Użytkownik|Użytkowniczka)"),
        Rule("obce pismo", r"[\x{370}-\x{3ff}\x{400}-\x{4ff}\x{900}-\x{97f}\x{600}-\x{6ff}\x{4e00}-\x{9fff}]", False),
        Rule("przeciek roli", rf"(^|\n){SPACE}*(assistant|asystent|user|użytkownik)([:>]|[^\p{{L}}\p{{N}}_\n][^\n]{{0,29}}[:>])|assistant to=|</?(user|assistant)", parts=("assistant", "asystent", "user", "ytkownik")),
    ),
    after=(
        Rule("kontynuacja rozmowy", rf"^{NO_WORD}*(Dziękuj|Dzięki|Bardzo dziękuj|Jasne[,.!]|Oczywiście[,.!]|Rozumiem[,.!]|Zrozumiał|To teraz|A teraz|A mogę|Wracając do|Jak już mówił|Tak jak pisał|Czas już najwyższy|Masz rację|No dobra, to)"),
        Rule("urwane", rf"(\.\.\.|…){SPACE}*\??{SPACE}*\z", False, ("...", "…")),
        Rule(
            "meta",
            r"naturalne pytanie|krótkie,? naturalne|napisz (jedno |krótkie )?pytanie|zapytam o jeden|jeden z tych tematów|instrukcj|jailbreak|zignoruj poprzednie|system prompt|prompt systemow|jako model językowy|"
            rf"jedno krótkie pytanie|zadaj (jedno |krótkie )*pytanie|wybierz (losowo )?jeden z (tych |powyższych )?temat|(z|na) (jeden z )?powyższych tematów|jeden z powyższych|propozycj{WORD}* tematów|tematów do wyboru",
            parts=("naturalne", "pytanie", "zapytam", "jeden z ", "temat", "instrukcj", "jailbreak", "zignoruj", "system", "jako model"),
        ),
        Rule("dokument/markdown", rf"(^|\n){SPACE}*#{{1,4}}{SPACE}|```", False, ("#", "```")),
        Rule("etykieta mówiącego", rf"^[A-ZĄĆĘŁŃÓŚŹŻ][a-ząćęłńóśźż]{{2,15}}:{SPACE}", False),
        Rule("reguły dla asystenta", rf"^{NO_WORD}*(Twoja odpowiedź|Twoje odpowiedzi|Na twojej odpowiedzi|Odpowiadasz|Odpowiadaj|Każda (twoja )?odpowiedź|Jesteś (asystentem|ekspertem|specjalistą)|Wciel się|Zachowuj się)"),
        Rule("przeciek EN", rf"(^|{NO_WORD})(We need to|The user|Answer in|User response|presumably){_END}", False, ("We need to", "The user", "Answer in", "User response", "presumably")),
    ),
    prefix=rf"^(Polak|Polka|Użytkownik|Użytkowniczka|Pytanie( użytkownika)?|Krótko|Wiadomość (Polki|Polaka|użytkownika)){SPACE}*:{SPACE}*",
    names={"unfinished": "brak EOS", "empty": "puste", "echo": "echo systemu", "short": "za krótkie"},
)

#: A pack without a language of its own.
NEUTRAL = Pack(before=(Rule("role", rf"(^|\n){SPACE}*(assistant|user|system){SPACE}*[:>]|</?(user|assistant)", parts=("assistant", "user", "system")),), after=(Rule("truncated", rf"(\.\.\.|…){SPACE}*\??{SPACE}*\z", False, ("...", "…")), Rule("markdown", rf"(^|\n){SPACE}*#{{1,4}}{SPACE}|```", False, ("#", "```"))))

SELF_ANSWER = rf"\?{SPACE}*\n{SPACE}*\n{SPACE}*[^\t-\r\x{{1c}}-\x{{20}}\x{{85}}\x{{a0}}\x{{1680}}\x{{2000}}-\x{{200a}}\x{{2028}}\x{{2029}}\x{{202f}}\x{{205f}}\x{{3000}}]"


def clean(raw: Column | str, pack: Pack = POLISH) -> Column:
    """struct(raw, raw_orig, first): cut at a textual end of the turn, then one speaker prefix; raw_orig only if changed."""
    r = col(raw)
    cut = cut_after(r, "</user")
    done = replace(cut, f"(?iu){pack.prefix}") if pack.prefix else cut
    changed = (F.instr(r, "</user") > 0) | (cut.rlike(f"(?iu){pack.prefix}") if pack.prefix else F.lit(False))
    return F.struct(done.alias("raw"), F.when(changed, r).alias("raw_orig"), first_line(done).alias("first"))


def echoes(raw: Column, system: Column, longer_than: int = 15) -> Column:
    """Whether a sentence of the system text occurs in the message."""
    parts = F.transform(F.split(system, rf"(?<=[.!?]){SPACE}+|\n", -1), lambda s: replace(replace(s, rf"^{SPACE}+"), rf"{SPACE}+\z"))
    return F.coalesce(F.exists(parts, lambda s: (F.length(s) > longer_than) & F.contains(raw, s)), F.lit(False))


def classify(raw: Column, finish: Column, first: Column, system: Column | None = None, pack: Pack = POLISH, skip: tuple[str, ...] = ()) -> Column:
    """The first reason against a message, in the pack's order, or null: one CASE, evaluated from cheap to dear."""
    out = F.when(F.coalesce(finish != "stop", F.lit(True)), pack.names["unfinished"]).when(first == "", pack.names["empty"])
    if system is not None:
        out = out.when(echoes(raw, system), pack.names["echo"])
    for r in pack.before:
        if r.reason not in skip:
            out = out.when(r.found(raw), r.reason)
    out = out.when(~has_words(raw, pack.least_words), pack.names["short"])
    for r in pack.after:
        if r.reason not in skip:
            out = out.when(r.found(raw), r.reason)
    return out


def self_answer(raw: Column) -> Column:
    return raw.rlike(SELF_ANSWER)


def classify_sql(raw: str, finish: str, first: str, pack: Pack = POLISH, skip: tuple[str, ...] = ()) -> str:
    """The same rules in DuckDB's SQL, without the echo of a system text."""
    quote = lambda s: s.replace("'", "''")
    one = lambda r: f"WHEN regexp_matches({raw}, '{quote(r.re2())}') THEN '{quote(r.reason)}'"
    few = f"WHEN len(list_filter(string_split_regex({raw}, '{SPACE}+'), lambda w: w <> '')) < {pack.least_words} THEN '{pack.names['short']}'"
    return f"CASE WHEN {finish} <> 'stop' THEN '{pack.names['unfinished']}' WHEN {first} = '' THEN '{pack.names['empty']}' " + " ".join([*(one(r) for r in pack.before if r.reason not in skip), few, *(one(r) for r in pack.after if r.reason not in skip)]) + " END"
