"""Stored reports: payload parsing, the report table sink, and the line export."""

from __future__ import annotations

import ast
import json
import warnings

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rolegauge.functions.columns import first, joined, nonempty
from rolegauge.functions.text import strip
from rolegauge.lexicon import CRITERION_KEYS, DEFAULT, Lexicon
from rolegauge.operators.numbering import number_rows
from rolegauge.schemas import path_exists
from rolegauge.storage import materialize

# Numbers stay as they were written, so a fraction is neither lost nor rounded.
JOB = "struct<title:string,match_score:string>"
JOBS = f"array<{JOB}>"
CRITERIA = "map<string,string>"
TEXTS = "array<string>"
ANALYSIS = (
    "struct<word_count:int,score_details:map<string,string>,bullet_rewrites:array<struct<before:string,after:string>>,"
    "analysis_steps:array<struct<label:string,detail:string>>>"
)
# An empty report table: the payloads as a scan writes them.
REPORTS_DDL = (
    f"id bigint, user_id bigint, filename string, uploaded_at timestamp, score int, matched_jobs {JOBS}, criteria {CRITERIA}, "
    f"suggestions {TEXTS}, analysis {ANALYSIS}"
)

@F.pandas_udf(T.StringType())
def python_literals(texts: pd.Series) -> pd.Series:
    """Python literals of old reports as JSON; NULL for NULL, for what is no literal and for other kinds than lists, dictionaries and
    strings. Adjacent and prefixed strings, escapes and tuples inside are what Python reads; bytes and sets inside become empty lists."""

    def converted(text: str | None) -> str | None:
        if text is None:
            return None
        try:
            with warnings.catch_warnings():
                warnings.simplefilter("ignore")
                value = ast.literal_eval(text)
            return json.dumps(value, ensure_ascii=False, default=lambda _: []) if isinstance(value, (list, dict, str)) else None
        except (ValueError, SyntaxError, TypeError, MemoryError, RecursionError):
            return None

    return texts.map(converted)


def canonical(text: Column) -> Column:
    """A payload as JSON text: itself if it is JSON, else the Python literal it holds, else NULL. Only texts that are no JSON leave the JVM."""
    is_json = F.try_parse_json(text).isNotNull()
    return F.coalesce(F.when(is_json, text), python_literals(F.when(~is_json, text)))


def of_kind(json_text: Column, schema: str, opening: str) -> Column:
    """A canonical payload by its schema, NULL if it is of another kind. ``opening`` is the first character of its kind."""
    return F.when(F.ltrim(json_text).startswith(opening), F.from_json(json_text, schema))


def parsed(text: Column, schema: str, opening: str) -> Column:
    """A payload text, JSON or a Python literal, by its schema; else NULL."""
    return of_kind(canonical(text), schema, opening)


def string_payload(json_text: Column) -> Column:
    """The value of a canonical payload that is one string, else NULL."""
    return F.get(of_kind(F.concat(F.lit("["), F.when(F.ltrim(json_text).startswith('"'), json_text), F.lit("]")), TEXTS, "["), F.lit(0))


def elements(json_text: Column) -> Column:
    """The elements of a canonical list as structs of text and kind ("STRING", "OBJECT<...>", ...): a number is no title, whatever it looks
    like."""
    kinds = F.transform(F.try_parse_json(F.when(F.ltrim(json_text).startswith("["), json_text)).cast("array<variant>"), F.schema_of_variant)
    return F.zip_with(of_kind(json_text, TEXTS, "["), kinds, lambda t, k: F.struct(t.alias("text"), k.alias("kind")))


def is_object(element: Column) -> Column:
    return element["kind"].startswith("OBJECT")


def job_list(text: Column) -> Column:
    """Matches of a stored report, element by element: objects stay, other elements are no matches. One quoted string of titles is
    split at its commas."""
    payload = canonical(text)
    objects = F.transform(F.filter(elements(payload), is_object), lambda e: F.from_json(e["text"], JOB))
    names = F.filter(F.transform(F.split(string_payload(payload), ","), strip), lambda t: t != "")
    from_names = F.transform(names, lambda t: F.struct(t.alias("title"), F.lit(None).cast("string").alias("match_score")))
    return F.coalesce(objects, from_names, F.array().cast(JOBS))


def match_summary(text: Column) -> Column:
    """Titles of the matches as one line, objects and plain titles mixed; a quoted string is returned as it is."""
    payload = canonical(text)
    title = lambda e: F.when(is_object(e), F.from_json(e["text"], JOB)["title"]).when(e["kind"] == "STRING", strip(e["text"]))
    titles = F.filter(F.transform(elements(payload), title), nonempty)
    return F.coalesce(F.when(F.size(titles) > 0, joined(titles)), string_payload(payload), F.lit("None"))


def summaries(reports: DataFrame) -> Column:
    """The summary line of each report, whether its matches are text or typed."""
    if is_text(reports, "matched_jobs"):
        return match_summary(F.col("matched_jobs"))
    titles = F.filter(F.col("matched_jobs.title"), nonempty)
    return F.when(F.size(titles) > 0, joined(titles)).otherwise("None")


def is_text(reports: DataFrame, name: str) -> bool:
    return dict(reports.dtypes)[name] == "string"


def with_payload(reports: DataFrame) -> DataFrame:
    """Typed payloads: texts are parsed, what cannot be read becomes empty; columns that are typed already stay."""
    typed = {
        "matched_jobs": job_list(F.col("matched_jobs")),
        "criteria": F.coalesce(parsed(F.col("criteria"), CRITERIA, "{"), F.create_map().cast(CRITERIA)),
        "suggestions": F.coalesce(parsed(F.col("suggestions"), TEXTS, "["), F.array().cast(TEXTS)),
        "analysis": parsed(F.col("analysis"), ANALYSIS, "{"),
    }
    return reports.withColumns({name: value for name, value in typed.items() if is_text(reports, name)})


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    """The stored reports with typed payloads, of old tables (texts) and of those that a scan has written; empty when there are none."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], REPORTS_DDL)
    return with_payload(spark.read.parquet(path)).drop("upload_day")


def timestamp_text(ts: Column) -> Column:
    """UTC, whole seconds, with offset, whatever the session time zone is."""
    utc = F.to_utc_timestamp(ts.cast("timestamp"), F.current_timezone())
    return F.concat(F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))


def report_lines(lex: Lexicon = DEFAULT) -> Column:
    """The lines of a report from the typed columns of ``with_payload``."""

    def section(title: str, body: Column, shown: Column) -> Column:
        return F.when(shown, F.concat(F.array(F.lit(""), F.lit(title)), body)).otherwise(F.array().cast(TEXTS))

    def text(*parts: Column | str) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("")) for p in parts])

    def stored(value: Column) -> Column:
        return F.coalesce(value.cast("string"), F.lit("None"))

    analysis = F.col("analysis")
    details = analysis["score_details"]

    def criterion(entry: Column) -> Column:
        reason = F.coalesce(details[entry["key"]], F.lit(""))
        line = text("- ", entry["key"], ": ", entry["value"], "/10")
        return F.when(reason != "", F.array(line, text("  ", reason))).otherwise(F.array(line))

    head = F.array(
        F.lit(f"{lex.system_title} Report"), text("File: ", stored(F.col("filename"))),
        text("Saved: ", timestamp_text(F.col("uploaded_at"))), text("Score: ", stored(F.col("score")), " / 100"),
        F.lit(""), F.lit("Criteria"),
    )
    advice = F.when(F.size("suggestions") > 0, F.transform("suggestions", lambda s: text("- ", s))).otherwise(
        F.array(F.lit("- No suggestions saved."))
    )
    rewrites, steps = analysis["bullet_rewrites"], analysis["analysis_steps"]
    return F.concat(
        head,
        F.flatten(F.transform(F.map_entries("criteria"), criterion)),
        section("Suggestions", advice, F.lit(True)),
        section(
            "Suggested Bullet Rewrites",
            F.flatten(
                F.transform(
                    first(rewrites, 3),
                    lambda r: F.array(text("- Before: ", r["before"]), text("  After: ", r["after"])),
                )
            ),
            F.coalesce(F.size(rewrites), F.lit(0)) > 0,
        ),
        section(
            "Analysis Steps",
            F.transform(first(steps, 4), lambda s: text("- ", s["label"], ": ", s["detail"])),
            F.coalesce(F.size(steps), F.lit(0)) > 0,
        ),
        section(
            "Matches",
            F.transform(
                "matched_jobs",
                lambda j: text("- ", F.coalesce(j["title"], F.lit("Role")), ": ", F.coalesce(j["match_score"].cast("string"), F.lit("0")), "%"),
            ),
            F.lit(True),
        ),
    )


def page(lines: Column, most_lines: int | None, most_chars: int | None) -> Column:
    """The lines of a page; without limits all of them, whole."""
    kept = lines if most_lines is None else first(lines, most_lines)
    return kept if most_chars is None else F.transform(kept, lambda line: F.substring(line, 1, most_chars))


def export_lines(
    reports: DataFrame, lex: Lexicon = DEFAULT, most_lines: int | None = None, most_chars: int | None = None
) -> DataFrame:
    """``id, line_no, line``: every line of every report, unless limits are given."""
    lines = page(report_lines(lex), most_lines, most_chars)
    return with_payload(reports).select("id", F.posexplode(lines).alias("line_no", "line"))


def write_pages(
    reports: DataFrame, path: str, lex: Lexicon = DEFAULT, most_lines: int | None = None, most_chars: int | None = None
) -> None:
    """The exported page of each report as a text file in a folder of its own; meant for a selection of reports."""
    text = F.array_join(page(report_lines(lex), most_lines, most_chars), "\n")
    with_payload(reports).select("id", text.alias("page")).write.partitionBy("id").text(path)


def labelled(values: Column, lex: Lexicon = DEFAULT) -> Column:
    """A criterion struct as a map from label to value, in criterion order."""
    labels = F.array(*[F.lit(label) for label in lex.labels()])
    return F.map_from_arrays(labels, F.array(*[values[key] for key in CRITERION_KEYS]))


def report_ids(docs: DataFrame, key: str, stored: DataFrame) -> DataFrame:
    """``key, id``: the ids that follow those of the ``stored`` reports, in the order of ``key``.

    Only the keys are counted, so ids cost no second scan of the documents.
    """
    next_id = stored.agg(F.coalesce(F.max("id"), F.lit(0)) + 1).scalar()
    placed = number_rows(docs.select(key), "offset", order=key)
    return placed.select(key, (next_id + F.col("offset")).alias("id"))


def append_reports(reports: DataFrame, path: str) -> None:
    """Append to the report table, one folder per upload day so that time filters prune files.

    The reports are written once and then dealt out by day, so that a day has a file or a few, not one of every task; a day with
    many reports is cut by their ids.
    """
    dated = materialize(reports.withColumn("upload_day", F.to_date("uploaded_at")), "reports-by-day").repartitionByRange("upload_day", "id")
    dated.write.mode("append").partitionBy("upload_day").parquet(path)


def write_backfill(reports: DataFrame, primary: DataFrame, path: str) -> None:
    """The whole table with its owners filled in, as a new snapshot; the old one stays until the caller switches to the new path."""
    filled = backfill_owner(reports, primary).withColumn("upload_day", F.to_date("uploaded_at"))
    filled.write.mode("errorifexists").partitionBy("upload_day").parquet(path)


def backfill_owner(reports: DataFrame, primary: DataFrame) -> DataFrame:
    """Reports without an owner go to the primary user; ``primary`` holds that one id, or NULL without users."""
    return reports.withColumn("user_id", F.coalesce("user_id", primary.scalar()))
