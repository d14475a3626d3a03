"""Text expressions with Python's Unicode meaning of letters and white space; all run in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Python's str.split and \s have it; written out, since engines differ. Fixed values.
SPACE = r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
WORD = r"[\p{L}\p{N}_]"
NO_WORD = r"[^\p{L}\p{N}_]"


def col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def replace(x: Column, pattern: str, by: str = "") -> Column:
    return F.regexp_replace(x, F.lit(pattern), F.lit(by))


def strip(x: Column | str) -> Column:
    return replace(replace(col(x), rf"^{SPACE}+"), rf"{SPACE}+\z")


def words(x: Column | str) -> Column:
    """Runs of characters that are not white space."""
    return F.filter(F.split(col(x), rf"{SPACE}+", -1), lambda w: w != "")


def has_words(x: Column | str, n: int) -> Column:
    """Whether there are n words at least; a long text is read up to the nth."""
    other = SPACE.replace("[", "[^", 1)
    return col(x).rlike(rf"^{SPACE}*+(?:{other}++{SPACE}++){{{n - 1}}}{other}" if n > 0 else "")


def normalize(x: Column | str) -> Column:
    """Lower case; each run of other characters than letters, digits and _ is one blank."""
    return F.trim(replace(F.lower(col(x)), NO_WORD + "+", " "))


def first_line(x: Column | str) -> Column:
    return strip(F.get(F.split(col(x), "\n", -1), 0))


def shingles(x: Column | str, n: int = 8) -> Column:
    """Distinct runs of n normalized words, joined by blanks; none if there are fewer words."""
    w = F.filter(F.split(normalize(x), " ", -1), lambda t: t != "")
    one = lambda a: F.when(F.size(a) >= n, F.array_distinct(F.transform(F.sequence(F.lit(1), F.size(a) - n + 1), lambda i: F.array_join(F.slice(a, i, n), " ")))).otherwise(F.array().cast("array<string>"))
    return F.get(F.transform(F.array(w), one), 0)


def sha256(x: Column | str) -> Column:
    return F.sha2(col(x).cast("binary"), 256)


def hash_number(x: Column | str) -> Column:
    """The first 8 hexadecimal digits of the SHA-256 as a number."""
    return F.conv(F.substring(sha256(x), 1, 8), 16, 10).cast("long")


def basename(x: Column | str) -> Column:
    return F.element_at(F.split(col(x), "/", -1), -1)


def join_list(items: Column, last: str = " albo ") -> Column:
    """a, b and the last word before the last item; a single item is itself."""
    n = F.size(items)
    return F.when(n <= 1, F.array_join(items, "")).otherwise(F.concat(F.array_join(F.slice(items, F.lit(1), F.greatest(n - 1, F.lit(1))), ", "), F.lit(last), F.element_at(items, -1)))


def cut_after(x: Column, marker: str) -> Column:
    """The part before the marker, without trailing white space; all of x if the marker is absent."""
    at = F.instr(x, marker)
    return F.when(at > 0, replace(F.substring(x, F.lit(1), at - 1), rf"{SPACE}+\z")).otherwise(x)


def split_reasoning(content: Column | str, reasoning: Column | str) -> Column:
    """struct(answer, reasoning): a leading think block leaves the content; a reasoning given apart wins."""
    c, given = F.coalesce(col(content), F.lit("")), F.coalesce(col(reasoning), F.lit(""))
    block = rf"(?s)^{SPACE}*(?:<think>(.*?)</think>|\[THINK\](.*?)\[/THINK\]){SPACE}*"
    found = c.rlike(block)
    inner = strip(F.concat(F.regexp_extract(c, block, 1), F.regexp_extract(c, block, 2)))
    return F.struct(
        strip(F.when(found, F.regexp_replace(c, F.lit(block), F.lit(""))).otherwise(c)).alias("answer"),
        strip(F.when(found & (given == ""), inner).otherwise(given)).alias("reasoning"),
    )


#: Markers of the answers' format. Fixed values.
LEFT_THINK, LEFT_ANY_THINK = r"</?think>", r"\[/?THINK\]|</?think>"
TOOL_CALL = r"<function=|<parameter=|</?tool_call>"


def split_answer(text: Column | str, thinking: Column) -> Column:
    """struct(reasoning, answer, reason) of a generated turn; reason is null if it can be used.

    With thinking the first </think> parts reasoning from answer.
    """
    t = col(text)
    at = F.instr(t, "</think>")
    head, tail = strip(F.substring(t, F.lit(1), at - 1)), strip(F.substring(t, at + 8, F.length(t)))
    answer = F.when(thinking & (at == 0), "").when(thinking, tail).otherwise(strip(t))
    reasoning = F.when(thinking & (at == 0), strip(t)).when(thinking, head).otherwise("")
    reason = (
        F.when(thinking & (at == 0), "niezamknięte rozumowanie")
        .when(thinking & (head == ""), "brak rozumowania")
        .when(answer == "", "pusta odpowiedź")
        .when(answer.rlike(LEFT_THINK), "tag think w odpowiedzi")
        .when(answer.rlike(TOOL_CALL), "wywołanie narzędzia")
    )
    return F.struct(reasoning.alias("reasoning"), answer.alias("answer"), reason.alias("reason"))


def token_budget(prompt: Column | str, context: int, most: int = 0) -> Column:
    """Tokens left for an answer: at most one token for each two characters of the prompt, and 32 to spare."""
    left = F.lit(context) - F.floor(F.length(col(prompt)) / 2).cast("int") - 32
    return F.least(F.lit(most), left) if most else left
