"""Years of experience: an explicit statement, otherwise the union of dated work ranges."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rolegauge.functions.columns import let
from rolegauge.functions.text import WORD_CHAR, alternatives
from rolegauge.lexicon import WORK_CONTEXT_WORDS

# Fixed patterns and limits.
EXPLICIT = [
    rf"(?=[0-9])(?<!{WORD_CHAR})([0-9]{{1,2}})\+?\s*(?:years|yrs)(?:\s+of)?\s+(?:work\s+)?experience(?!{WORD_CHAR})",
    rf"(?=e)(?<!{WORD_CHAR})experience(?:\s+of|\s*:)?\s*([0-9]{{1,2}})\+?\s*(?:years|yrs)(?!{WORD_CHAR})",
]
MONTH = (
    "jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|jun(?:e)?|jul(?:y)?|aug(?:ust)?|"
    "sep(?:tember)?|sept|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?"
)
YEAR = r"(?:19|20)\d{2}"
DATE = rf"(?:{MONTH})?\s*{YEAR}"
OPEN_END = "present|current|now"
MOST_YEARS = 25
EARLIEST = 1970
CONTEXT = 80

MARK, FIELD = "\x01", "\x02"


def explicit_years(text: Column) -> Column:
    """Stated years of experience, NULL when nothing is stated. The patterns are tried on texts that hold the words of such a statement."""
    # Without `let` each pattern would be tried twice: once for the comparison and once for the value.
    stated = [let(F.regexp_extract(text, p, 1), lambda years: F.nullif(years, F.lit(""))) for p in EXPLICIT]
    named = text.contains("experience") & (text.contains("years") | text.contains("yrs"))
    return let(
        F.when(named, F.coalesce(*stated)).cast("int"),
        lambda years: F.when(years.isNotNull(), F.least(years, F.lit(MOST_YEARS))),
    )


def dated_ranges(text: Column, as_of_year: int) -> Column:
    """``ARRAY<STRUCT<start_year, end_year, at_work>>`` of the year ranges in reading order.

    One pass of one pattern marks each range together with the 80 characters before and after it; the marked
    text is then cut at the marks. Texts without a year and an end after it skip the pattern.
    """
    replaced = F.replace(F.replace(text, F.lit(MARK), F.lit("?")), F.lit(FIELD), F.lit("?"))
    plain = F.when(text.contains(MARK) | text.contains(FIELD), replaced).otherwise(text)
    # The range is looked for before the context: the backward look is the costly part. Most places fail at their first signs.
    between = r"\s*(?:-|–|—|to|until)\s*"
    pattern = (
        rf"(?s)(?=[\sjfmasond12])(?=\s*[12]|jan|feb|ma[ry]|apr|ju[nl]|aug|sep|oct|nov|dec)(?={DATE}{between}(?:{OPEN_END}|{DATE}))(?<=(^.{{0,{CONTEXT - 1}}}|.{{{CONTEXT}}}))"
        rf"({DATE}){between}({OPEN_END}|{DATE})(?=(.{{0,{CONTEXT}}}))"
    )
    # $0 keeps the range itself, so the window is "before + range + after" without a gap.
    marked = F.regexp_replace(plain, pattern, f"{MARK}$2{FIELD}$3{FIELD}$1$0$4{MARK}")

    def parsed(piece: Column) -> Column:
        return let(
            F.split(piece, FIELD),
            lambda f: F.struct(
                F.regexp_extract(F.get(f, F.lit(0)), YEAR, 0).cast("int").alias("start_year"),
                F.when(F.get(f, F.lit(1)).isin(OPEN_END.split("|")), F.lit(as_of_year))
                .otherwise(F.expr("NULL"))
                .cast("int")
                .alias("open_end"),
                F.nullif(F.regexp_extract(F.get(f, F.lit(1)), YEAR, 0), F.lit("")).cast("int").alias("closed_end"),
                F.rlike(F.get(f, F.lit(2)), F.lit(alternatives(WORK_CONTEXT_WORDS))).alias("at_work"),
            ),
        )

    pieces = F.filter(F.split(marked, MARK), lambda p: p.contains(FIELD))
    ranges = F.transform(
        F.transform(pieces, parsed),
        lambda r: F.struct(
            r["start_year"].alias("start_year"),
            F.coalesce(r["open_end"], r["closed_end"]).alias("end_year"),
            r["at_work"].alias("at_work"),
        ),
    )
    kept = F.filter(
        ranges,
        lambda r: (r["end_year"] >= r["start_year"]) & (r["start_year"] >= EARLIEST) & (r["end_year"] <= as_of_year),
    )
    empty = F.array().cast("array<struct<start_year:int,end_year:int,at_work:boolean>>")
    ranged = rf"(?=[12]){YEAR}{between}(?:{OPEN_END}|{DATE})"
    return F.when(F.rlike(text, F.lit(ranged)), kept).otherwise(empty)


def range_years(ranges: Column) -> Column:
    """Distinct years covered by the work ranges; the end year of a range does not count."""
    years = F.transform(
        F.filter(ranges, lambda r: r["at_work"] & (r["end_year"] > r["start_year"])),
        lambda r: F.sequence(r["start_year"], r["end_year"] - 1),
    )
    return F.least(F.size(F.array_distinct(F.flatten(years))), F.lit(MOST_YEARS))


def experience_years(text: Column, as_of_year: int) -> Column:
    """Years of experience found in normalized ``text``."""
    return F.coalesce(explicit_years(text), range_years(dated_ranges(text, as_of_year)))
