"""A document against its own target role: one comparison per row, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rolegauge.functions.columns import clip_percent, first
from rolegauge.functions.text import strip
from rolegauge.lexicon import DEFAULT, Lexicon

MATCH_TYPE = (
    "struct<rank:int,source:string,job_id:bigint,title:string,description:string,match_score:int,"
    "matched:array<string>,missing:array<string>>"
)


def target_text(title: Column, description: Column) -> Column:
    return strip(F.concat(F.coalesce(title, F.lit("")), F.lit(" "), F.coalesce(description, F.lit(""))))


def coverage(matched: Column, candidates: Column) -> Column:
    return F.size(matched) / F.greatest(F.size(candidates), F.lit(1))


def target_match(title: Column, description: Column, similarity: Column, candidates: Column, present: Column) -> Column:
    """The match struct of the target role. ``present`` holds every term the document can show."""
    matched = F.array_intersect(candidates, present)
    missing = F.array_except(candidates, present)
    score = similarity * 0.6 + coverage(matched, candidates) * 0.4
    name = F.coalesce(title, F.lit(""))
    return F.struct(
        F.lit(1).alias("rank"),
        F.lit("target").alias("source"),
        F.lit(None).cast("bigint").alias("job_id"),
        F.when(name == "", "Target Role").otherwise(name).alias("title"),
        F.coalesce(description, F.lit("")).alias("description"),
        clip_percent(score * 100, 100).alias("match_score"),
        first(matched, 10).alias("matched"),
        first(missing, 8).alias("missing"),
    )


def explanation(matched: Column, candidates: Column) -> Column:
    return F.concat(
        F.lit("Matched "), F.size(matched).cast("string"), F.lit(" of "), F.size(candidates).cast("string"),
        F.lit(" high-signal target terms."),
    )
