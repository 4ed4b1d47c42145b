"""Criteria, totals and advice."""

from __future__ import annotations

from pyspark.sql import functions as F

from rolegauge import lexicon as L
from rolegauge.checks import corpus as X
from rolegauge.checks.sentences import AS_OF_YEAR
from rolegauge.checks.plans import planned
from rolegauge.checks.sql import base as B
from rolegauge.functions.columns import elements
from rolegauge.operators import criteria as C
from rolegauge.plans import documents as D
from rolegauge.plans.scan import analyzed

LABELS = L.DEFAULT.labels()
COLUMNS = {"education": "education_score", "skills": "skills_score"}


@planned
def scored(spark, folder):
    return D.score_documents(X.corpus(spark, folder), AS_OF_YEAR)


@planned
def full(spark, folder):
    return analyzed(X.corpus(spark, folder), X.catalog(spark, folder), AS_OF_YEAR)


def one_criterion(key: str):
    def query(spark, folder):
        return scored(spark, folder).select("doc_id", f"criteria.{key}", F.col(f"reasons.{key}").alias("reason"))

    return query, f"SELECT doc_id, {COLUMNS.get(key, key)} AS {key}, {B.REASONS[key]} AS reason FROM k_criteria"


def criteria(spark, folder):
    return scored(spark, folder).select("doc_id", "criteria.*")


def criteria_reasons(spark, folder):
    rows = F.array(
        *[
            F.struct(F.lit(label).alias("criterion"), F.col(f"criteria.{key}").alias("score"), F.col(f"reasons.{key}").alias("reason"))
            for key, label in zip(L.CRITERION_KEYS, LABELS)
        ]
    )
    return scored(spark, folder).select("doc_id", F.inline(rows))


def score_default(spark, folder):
    return scored(spark, folder).select("doc_id", C.default_score(F.col("criteria")).alias("score"))


def score_role(spark, folder):
    return scored(spark, folder).select("doc_id", "title", "score")


def crit_extremes(spark, folder):
    strongest, weakest = C.extreme_labels(F.col("criteria"))
    return scored(spark, folder).select("doc_id", strongest.alias("strongest"), weakest.alias("weakest"))


def analysis_steps(spark, folder):
    details = F.col("analysis_steps.detail")
    return full(spark, folder).select(
        "doc_id", F.get(details, F.lit(0)).alias("parsed"), F.get(details, F.lit(1)).alias("checked"),
        F.get(details, F.lit(2)).alias("compared"),
    )


def suggestions(spark, folder):
    return elements(full(spark, folder), "suggestions", ["doc_id"], ["at", "suggestion"]).select(
        "doc_id", (F.col("at") + 1).alias("place"), "suggestion"
    )


def scan_scores(spark, folder):
    p = F.col("profile")
    return scored(spark, folder).select(
        "doc_id", "criteria.*", "score", p["experience_years"].alias("years"), p["word_count"].alias("word_count"),
        F.size(p["skills"]).alias("n_skills"),
    )


VALUES = ", ".join(f"{COLUMNS.get(key, key)} AS {key}" for key in L.CRITERION_KEYS)

ENTRIES = {
    **{
        f"crit_{key}": one_criterion(key)
        for key in ("contact", "summary", "experience", "education", "skills", "keywords", "consistency", "proofreading", "relevance")
    },
    "criteria": (criteria, f"SELECT doc_id, {VALUES} FROM k_criteria"),
    "criteria_reasons": (criteria_reasons, "SELECT doc_id, criterion, score, reason FROM k_reasons"),
    "score_default": (score_default, "SELECT doc_id, default_score AS score FROM k_scored"),
    "score_role": (score_role, "SELECT doc_id, title, score FROM k_scored"),
    "crit_extremes": (
        crit_extremes,
        f"""SELECT doc_id, ({B.LABELS})[list_position(vals, list_max(vals))] AS strongest,
        ({B.LABELS})[list_position(vals, list_min(vals))] AS weakest FROM k_valued""",
    ),
    "analysis_steps": (analysis_steps, "SELECT * FROM k_steps"),
    "suggestions": (
        suggestions,
        """SELECT doc_id, generate_subscripts(suggestions, 1)::INTEGER AS place, unnest(suggestions) AS suggestion FROM k_suggestions""",
    ),
    "scan_scores": (
        scan_scores,
        f"SELECT doc_id, {VALUES}, score, years, word_count::INTEGER AS word_count, len(skills)::INTEGER AS n_skills FROM k_scored",
    ),
}
