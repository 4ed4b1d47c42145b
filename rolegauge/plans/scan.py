"""A whole scan: score the documents, match them, advise, and build the report rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rolegauge.functions.text import bullet_rewrites
from rolegauge.lexicon import DEFAULT, Lexicon
from rolegauge.operators.advice import analysis_steps, suggestions
from rolegauge.operators.catalog_match import Prepared, prepare
from rolegauge.operators.history import previous_at_scan
from rolegauge.plans.documents import score_termed, termed
from rolegauge.plans.matching import catalog_matches, merged
from rolegauge.sources.reports import labelled
from rolegauge.storage import materialize

KEPT = (
    "doc_id", "user_id", "filename", "uploaded_at", "title", "description", "text", "vector", "doc_squared", "target_match", "profile",
    "criteria", "reasons", "weights", "score", "bullet_rewrites",
)


def analyzed(docs: DataFrame, catalog: DataFrame | Prepared, as_of_year: int, lex: Lexicon = DEFAULT) -> DataFrame:
    """Scores, matches, suggestions, steps and rewrites of every document.

    The documents are read, tokenized and scored once and written to the shared folder without their raw texts. The catalog
    side reads the term columns of it, the report side the others; one shuffle by document joins them.
    """
    ready = catalog if isinstance(catalog, Prepared) else prepare(catalog, lex)
    scored = score_termed(termed(docs, lex), as_of_year, lex, vectors=True)
    scored = scored.withColumn("bullet_rewrites", bullet_rewrites(F.col("raw_text"), F.col("title"), lex))
    local = materialize(scored.select(*KEPT), "scored")
    both = merged(local.join(catalog_matches(local, ready), "doc_id", "left"))
    scores, matches, p, title = F.col("criteria"), F.col("matches"), F.col("profile"), F.col("title")
    return both.withColumns(
        {
            "suggestions": suggestions(scores, matches, p, lex),
            "analysis_steps": analysis_steps(scores, matches, p, title, lex),
        }
    )


def report_rows(analysis: DataFrame, lex: Lexicon = DEFAULT) -> DataFrame:
    """Report rows with nested payloads, by ``doc_id``; ``report_ids`` gives the ids to join."""
    title = F.coalesce("title", F.lit(""))
    match = F.transform(
        "matches",
        lambda m: F.struct(
            m["title"].alias("title"), m["description"].alias("description"), m["match_score"].alias("match_score"),
            m["matched"].alias("matched_keywords"), m["missing"].alias("missing_keywords"), m["source"].alias("source"),
        ),
    )
    return analysis.select(
        "doc_id", "user_id", "filename", "uploaded_at", "score",
        match.alias("matched_jobs"),
        labelled(F.col("criteria"), lex).alias("criteria"),
        "suggestions",
        F.struct(
            "profile.*",
            title.alias("target_role"),
            (F.coalesce("description", F.lit("")) != "").alias("target_description_provided"),
            labelled(F.col("reasons"), lex).alias("score_details"),
            F.map_from_arrays(F.array(*[F.lit(x) for x in lex.labels()]), F.col("weights")).alias("score_weights"),
            "analysis_steps", "bullet_rewrites",
        ).alias("analysis"),
    )


def scan(docs: DataFrame, catalog: DataFrame | Prepared, as_of_year: int, lex: Lexicon = DEFAULT) -> DataFrame:
    return report_rows(analyzed(docs, catalog, as_of_year, lex), lex)


def scan_with_previous(docs: DataFrame, catalog: DataFrame | Prepared, as_of_year: int, stored: DataFrame, lex: Lexicon = DEFAULT) -> DataFrame:
    """The report rows of a scan with ``previous_score``: the score of the owner's newest report in ``stored`` at the time of the scan."""
    return scan(docs, catalog, as_of_year, lex).join(previous_at_scan(docs, stored, "doc_id"), "doc_id")
