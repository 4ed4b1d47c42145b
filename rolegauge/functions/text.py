"""Text primitives as Column -> Column functions; everything runs inside the JVM."""

from __future__ import annotations

import re
import string
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from rolegauge.functions.columns import contains_any, let, occurrences, words
from rolegauge.lexicon import DEFAULT, REPLACED_PHRASES, Lexicon

ASCII_DIGITS, ASCII_LETTERS = string.digits, string.ascii_letters


def char_class(plain: str, others: str) -> str:
    """The ASCII characters of ``plain`` and, beyond ASCII, those of ``others``. Characters named one by one are looked up in one table; only
    for those beyond ASCII the engine asks for properties."""
    return rf"[[{plain}][\x80-\x{{10ffff}}&&{others}]]"


# Every character Python and Unicode call white space.
SPACE = r"[[\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0][\u1680-\u3000&&[\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]]]"
# Runs of it that are no single plain space.
UNEVEN_SPACE = rf"{SPACE}(?:(?<! ){SPACE}*+|{SPACE}++)"
# The same characters one by one, for trimming without a pattern.
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
LINE_BREAK = r"[\n\r\x0b\x0c\x1c\x1d\x1e\x85[\u2028-\u2029]](?:(?<=\r)\n)?"
# Characters that may belong to a technical term, so "sql" is not found in "nosql" or "sql-like".
TERM_CHAR = f"[{string.ascii_lowercase}{ASCII_DIGITS}+#.-]"
# What counts as part of a word; the engine's own \w and \b leave out some numerals and follow the Java version.
WORD_CHAR = char_class(f"{ASCII_LETTERS}{ASCII_DIGITS}_", r"[\p{L}\p{N}]")
DIGIT = char_class(ASCII_DIGITS, r"\p{Nd}")

# Fixed patterns.
# An address starts where no address sign stands before, and its name part gives nothing back: linear on any text.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
PHONE = rf"\+?{DIGIT}[{DIGIT}{SPACE}().-]{{6,}}{DIGIT}"
# The first, cheap look-ahead spares most positions the costlier word border.
YEAR = rf"(?=[12])(?<!{WORD_CHAR})(?:19|20){DIGIT}{{2}}(?!{WORD_CHAR})"
DATE_MARKER = (
    rf"(?=[jfmasond{DIGIT}])(?<!{WORD_CHAR})(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec|{DIGIT}{{4}})(?!{WORD_CHAR})"
)
WORD = WORD_CHAR + "+"
# A token may end in a letter before a border, or in a sign before a word character.
TOKEN = rf"(?=[{ASCII_LETTERS}])(?<!{WORD_CHAR})[a-zA-Z][a-zA-Z+#.-]+(?:(?<=[a-zA-Z])(?!{WORD_CHAR})|(?<=[+#.-])(?={WORD_CHAR}))"
FIGURE = char_class(f"{ASCII_DIGITS}%$", r"\p{Nd}")
# Alternatives tried one after the other in a prefix tree.
MOST_BRANCHES = 4
# A pattern for so few values is tried only on texts that hold one of them.
FEW_VALUES = 4
RESULT_WORDS = ["increased", "reduced", "improved", "optimized"]


def normalize(text: Column) -> Column:
    """One line, single spaces, lower case."""
    return F.trim(F.lower(F.regexp_replace(text, UNEVEN_SPACE, " ")))


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACES))


def compact(text: Column, limit: int = 150) -> Column:
    """Single spaces; longer texts end in three dots and keep to ``limit`` characters."""
    return let(
        F.trim(F.regexp_replace(text, UNEVEN_SPACE, " ")),
        lambda t: F.when(F.length(t) > limit, F.concat(F.rtrim(F.substring(t, 1, limit - 3)), F.lit("..."))).otherwise(t),
    )


def alternatives(values: Iterable[str]) -> str:
    return "|".join(re.escape(v) for v in values)


def prefix_tree(values: Iterable[str]) -> str:
    """A pattern for the longest value at a position. Values share their prefixes, so the cost per position does not
    grow with their number."""
    tree: dict = {}
    for value in values:
        node = tree
        for char in value:
            node = node.setdefault(char, {})
        node[""] = {}

    def render(node: dict) -> str:
        branches = [(char, re.escape(char) + render(child)) for char, child in sorted(node.items()) if char]
        if not branches:
            return ""
        body = branches[0][1] if len(branches) == 1 and "" not in node else f"(?:{divided(branches)})"
        return body + ("?" if "" in node else "")

    def divided(branches: list[tuple[str, str]]) -> str:
        """Alternatives that start with different characters; many are divided by their first one, so that few are tried."""
        if len(branches) <= MOST_BRANCHES:
            return "|".join(branch for _, branch in branches)
        size = -(-len(branches) // MOST_BRANCHES)
        groups = [branches[at : at + size] for at in range(0, len(branches), size)]
        return "|".join(f"(?=[{''.join(re.escape(char) for char, _ in group)}])(?:{divided(group)})" for group in groups)

    return render(tree)


def hit_layers(values: Iterable[str], char: str, same_in_python: str | None = None) -> list[list[str]]:
    """The values in groups for one pattern each.

    One pattern reports one value per position. Values that may start at the same position ("unit", "unit test")
    therefore go into separate patterns; usually one or two are enough for a whole list.
    """
    layers: list[list[str]] = []
    for value in sorted(set(values), key=lambda v: (-len(v), v)):
        for layer in layers:
            if not any(v.startswith(value) and not re.match(same_in_python or char, v[len(value)]) for v in layer):
                layer.append(value)
                break
        else:
            layers.append([value])
    return layers


def hit_pattern(values: Iterable[str], char: str) -> str:
    """A pattern whose group 1 finds the values that stand free of ``char`` characters on both sides."""
    return rf"(?<!{char})(?=({prefix_tree(values)})(?!{char}))"


def hit_patterns(values: Iterable[str], char: str, same_in_python: str | None = None) -> list[str]:
    """Patterns that find every value, one for each layer."""
    return [hit_pattern(layer, char) for layer in hit_layers(values, char, same_in_python)]


def term_hits(text: Column, values: Iterable[str]) -> Column:
    """Distinct values that occur in normalized ``text`` as free-standing terms, in no particular order."""

    def layer_hits(layer: list[str]) -> Column:
        hits = F.regexp_extract_all(text, F.lit(hit_pattern(layer, TERM_CHAR)), F.lit(1))
        return hits if len(layer) > FEW_VALUES else F.when(~contains_any(text, layer), words([])).otherwise(hits)

    found = [layer_hits(layer) for layer in hit_layers(values, TERM_CHAR)]
    return F.array_distinct(F.concat(*found)) if found else words([])


def listed_terms(text: Column, values: Column) -> Column:
    """Which of a few terms, given as an array column, stand free in ``text``. No term may begin another one followed
    by a space."""
    quoted = F.transform(values, lambda v: F.concat(F.lit(r"\Q"), v, F.lit(r"\E")))
    pattern = F.concat(F.lit(f"(?<!{TERM_CHAR})(?=("), F.array_join(quoted, "|"), F.lit(f")(?!{TERM_CHAR}))"))
    none = F.array().cast("array<string>")
    return F.when(F.size(values) > 0, F.array_distinct(F.regexp_extract_all(text, pattern, F.lit(1)))).otherwise(none)


def word_hits(text: Column, values: Iterable[str]) -> Column:
    """Sorted distinct values that occur as whole words."""
    found = [F.regexp_extract_all(text, F.lit(p), F.lit(1)) for p in hit_patterns(values, WORD_CHAR, r"\w")]
    return F.sort_array(F.array_distinct(F.concat(*found)))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD))


def bullet_markers(text: Column) -> Column:
    return occurrences(text, ["- ", "\u2022", "* "])


def typo_count(text: Column, lex: Lexicon = DEFAULT) -> Column:
    return occurrences(text, lex.typos)


def has_contact(text: Column) -> Column:
    """An e-mail address or a phone-like number. Texts without "@" skip the costlier pattern."""
    return (text.contains("@") & F.rlike(text, F.lit(EMAIL))) | F.rlike(text, F.lit(PHONE))


def is_email(text: Column) -> Column:
    return F.rlike(text, F.lit(rf"\A(?:{EMAIL})\z"))


def year_markers(text: Column) -> Column:
    return F.regexp_count(text, F.lit(YEAR))


def date_markers(text: Column) -> Column:
    return F.regexp_count(text, F.lit(DATE_MARKER))


def bullet_lines(raw: Column, shortest: int = 18) -> Column:
    """Lines without surrounding space and leading bullet signs, at least ``shortest`` characters long."""
    return F.filter(F.transform(F.split(raw, LINE_BREAK), without_bullet), lambda line: F.length(line) >= shortest)


def without_bullet(line: Column) -> Column:
    return F.ltrim(F.ltrim(strip(line), F.lit("-* \u2022")), F.lit(SPACES))


def shows_result(text: Column, result_words: list[str]) -> Column:
    """A figure, a percent or dollar sign, or a word that names a result."""
    return F.rlike(text, F.lit(FIGURE)) | contains_any(text, result_words)


def weak_bullets(raw: Column, lex: Lexicon = DEFAULT, most: int = 3, shortest: int = 18) -> Column:
    """The first ``most`` of ``bullet_lines`` that use a weak phrase or show no result. Lines behind them are not looked at."""

    def improvable(line: Column) -> Column:
        return let(normalize(line), lambda t: contains_any(t, lex.weak_verbs) | ~shows_result(t, [*RESULT_WORDS, "delivered"]))

    def with_line(found: Column, line: Column) -> Column:
        return F.when((F.length(line) >= shortest) & improvable(line), F.concat(found, F.array(line))).otherwise(found)

    return F.aggregate(
        F.split(raw, LINE_BREAK), F.array().cast("array<string>"),
        lambda found, line: F.when(F.size(found) >= most, found).otherwise(let(without_bullet(line), lambda t: with_line(found, t))),
    )


def rewritten_bullet(bullet: Column, title: Column) -> Column:
    """Replace weak phrases; where no result is named, add the sentence that asks for one."""
    swapped = F.regexp_replace(bullet, rf"(?i)(?<!{WORD_CHAR})(?:{alternatives(REPLACED_PHRASES)})(?!{WORD_CHAR})", "Delivered")

    def capitalized(t: Column) -> Column:
        return F.concat(F.upper(F.substring(t, 1, 1)), _tail(t))

    def finished(t: Column) -> Column:
        role = F.when(F.coalesce(title, F.lit("")) != "", F.concat(F.lit(" for "), title)).otherwise(F.lit(""))
        asking = F.concat(
            F.lit("Improved "), F.lower(F.substring(t, 1, 1)), _tail(t), role,
            F.lit(", adding measurable outcomes such as time saved, quality gains, or user impact."),
        )
        return F.when(let(normalize(t), lambda n: shows_result(n, RESULT_WORDS)), t).otherwise(asking)

    return compact(let(let(swapped, capitalized), finished), 240)


def _tail(text: Column) -> Column:
    return F.substring(text, F.lit(2), F.length(text))


def bullet_rewrites(raw: Column, title: Column, lex: Lexicon = DEFAULT) -> Column:
    return F.transform(
        weak_bullets(raw, lex),
        lambda line: F.struct(line.alias("before"), rewritten_bullet(line, title).alias("after")),
    )


def keyword_list(keywords: Column) -> Column:
    """A comma list as an array: trimmed, without empty parts, case kept."""
    return F.filter(F.transform(F.split(keywords, ","), strip), lambda k: k != "")
