"""Text functions and the profile."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rolegauge import lexicon as L
from rolegauge.checks import corpus as X
from rolegauge.checks.sentences import AS_OF_YEAR
from rolegauge.checks.plans import planned
from rolegauge.checks.sql import base as B
from rolegauge.checks.sql import stored  # noqa: F401  (registers its sub-queries)
from rolegauge.functions import experience, terms
from rolegauge.functions import text as T
from rolegauge.functions.columns import contained, contains_count
from rolegauge.operators import criteria as C
from rolegauge.plans import documents as D
from rolegauge.sources import reports as R
from rolegauge.sources.catalog import with_keywords

LEX = L.DEFAULT
ALIASES = sorted({a for group in LEX.skills.values() for a in group})


@planned
def named(spark: SparkSession, folder: str) -> DataFrame:
    return D.with_text(X.corpus(spark, folder))


@planned
def skilled(spark: SparkSession, folder: str) -> DataFrame:
    return D.with_skills(named(spark, folder))


@planned
def profiled(spark: SparkSession, folder: str) -> DataFrame:
    return D.with_profile(skilled(spark, folder), AS_OF_YEAR)


def bar(array, cast: bool = False):
    return F.array_join(F.transform(array, lambda x: x.cast("string")) if cast else array, "|")


def norm_text(spark, folder):
    return named(spark, folder).select("doc_id", "text")


def alias_hits(spark, folder):
    hits = F.sort_array(T.term_hits(F.col("text"), ALIASES))
    return named(spark, folder).select("doc_id", bar(hits).alias("aliases"))


def lexicon_hits(spark, folder):
    text = F.col("text")
    return named(spark, folder).select(
        "doc_id", bar(contained(text, L.GENERAL_KEYWORDS)).alias("keywords"),
        contains_count(text, L.GENERAL_KEYWORDS).alias("n_keywords"),
    )


def bullet_typo_counts(spark, folder):
    text = F.col("text")
    return named(spark, folder).select(
        "doc_id", T.bullet_markers(text).alias("n_bullets"), T.typo_count(text).alias("n_typos")
    )


def compact_text(spark, folder):
    raw = F.col("raw_text")
    return X.corpus(spark, folder).select("doc_id", T.compact(raw).alias("short"), T.compact(raw, 240).alias("longer"))


def contact_signals(spark, folder):
    signals = C.signals(F.col("text"))
    return named(spark, folder).select(
        "doc_id", signals["contact_found"].alias("contact_found"), signals["link_found"].alias("link_found")
    )


def date_markers(spark, folder):
    text = F.col("text")
    return named(spark, folder).select("doc_id", T.date_markers(text).alias("n_dates"), T.year_markers(text).alias("n_years"))


def word_count(spark, folder):
    return named(spark, folder).select("doc_id", T.word_count(F.col("text")).alias("word_count"))


def experience_explicit(spark, folder):
    return named(spark, folder).select("doc_id", experience.explicit_years(F.col("text")).alias("years"))


def experience_ranges(spark, folder):
    ranges = experience.dated_ranges(F.col("text"), AS_OF_YEAR)
    return (
        named(spark, folder)
        .select("doc_id", F.posexplode(ranges).alias("at", "r"))
        .select("doc_id", (F.col("at") + 1).alias("place"), "r.start_year", "r.end_year", "r.at_work")
    )


def experience_years(spark, folder):
    return named(spark, folder).select("doc_id", experience.experience_years(F.col("text"), AS_OF_YEAR).alias("years"))


def _placed(df, array, name):
    return df.select("doc_id", F.posexplode(array).alias("at", name)).select("doc_id", (F.col("at") + 1).alias("place"), name)


def bullet_lines(spark, folder):
    return _placed(X.corpus(spark, folder), T.bullet_lines(F.col("raw_text")), "line")


def weak_bullets(spark, folder):
    return _placed(X.corpus(spark, folder), T.weak_bullets(F.col("raw_text")), "line")


def bullet_rewrites(spark, folder):
    docs = named(spark, folder)
    return _placed(docs, T.bullet_rewrites(F.col("raw_text"), F.col("title")), "r").select(
        "doc_id", "place", "r.before", "r.after"
    )


def tokens(spark, folder):
    docs = D.with_tokens(skilled(spark, folder))
    return docs.select("doc_id", F.size("text_tokens").alias("n_tokens"), F.array_join("text_tokens", " ").alias("tokens"))


def catalog_keywords(spark, folder):
    return with_keywords(X.catalog(spark, folder)).select("job_id", F.posexplode("keywords").alias("at", "keyword")).select(
        "job_id", (F.col("at") + 1).alias("place"), "keyword"
    )


def payload_parse(spark, folder):
    entries = F.map_entries(F.coalesce(R.parsed(F.col("criteria"), R.CRITERIA, "{"), F.create_map().cast(R.CRITERIA)))
    shown = F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    advice = F.coalesce(R.parsed(F.col("suggestions"), R.TEXTS, "["), F.array().cast(R.TEXTS))
    return X.reports(spark, folder).select("id", bar(shown).alias("criteria"), bar(advice).alias("suggestions"))


def match_summary(spark, folder):
    return X.reports(spark, folder).select("id", R.match_summary(F.col("matched_jobs")).alias("summary"))


def report_payload(spark, folder):
    shown = F.transform(
        "matched_jobs",
        lambda j: F.concat(j["title"], F.lit("="), F.coalesce(j["match_score"].cast("string"), F.lit("?"))),
    )
    return R.with_payload(X.reports(spark, folder)).select(
        "id", bar(shown).alias("jobs"), F.size("criteria").alias("n_criteria"), F.size("suggestions").alias("n_suggestions"),
        F.coalesce(F.col("analysis.word_count"), F.lit(-1)).alias("word_count"),
    )


def role_hints(spark, folder):
    return named(spark, folder).select(
        "doc_id", bar(terms.role_hints(F.coalesce("title", F.lit("")))).alias("hints")
    )


def role_weights(spark, folder):
    docs = named(spark, folder).withColumn("weights", C.role_weights(F.col("title")))
    return docs.select(
        "doc_id", *[F.round(F.get("weights", F.lit(n)), 6).alias(f"w_{key}") for n, key in enumerate(L.CRITERION_KEYS)]
    )


def profile_skills(spark, folder):
    return skilled(spark, folder).select("doc_id", bar(F.col("text_skills")).alias("skills"))


def profile_verbs(spark, folder):
    return profiled(spark, folder).select(
        "doc_id", bar(F.col("profile.action_verbs")).alias("action_verbs"), bar(F.col("profile.weak_verbs")).alias("weak_verbs")
    )


def profile(spark, folder):
    p = F.col("profile")
    return profiled(spark, folder).select(
        "doc_id", bar(p["skills"]).alias("skills"), p["experience_years"].alias("years"),
        bar(p["action_verbs"]).alias("action_verbs"), bar(p["weak_verbs"]).alias("weak_verbs"),
        bar(p["education"]).alias("education"), p["word_count"].alias("word_count"),
    )


def _free(value: str) -> str:
    return f"regexp_matches(text, '(^|{B.FREE}){B.alt([value])}($|{B.FREE})')"


ENTRIES = {
    "norm_text": (norm_text, "SELECT doc_id, text FROM k_docs"),
    "alias_hits": (
        alias_hits,
        f"SELECT doc_id, array_to_string({B.found([(_free(a), a) for a in ALIASES])}, '|') AS aliases FROM k_docs",
    ),
    "lexicon_hits": (
        lexicon_hits,
        f"""SELECT doc_id, array_to_string(k, '|') AS keywords, len(k)::INTEGER AS n_keywords
        FROM (SELECT doc_id, {B.contained('text', L.GENERAL_KEYWORDS)} AS k FROM k_docs)""",
    ),
    "bullet_typo_counts": (
        bullet_typo_counts,
        f"SELECT doc_id, ({B.BULLETS})::INTEGER AS n_bullets, ({B.TYPOS})::INTEGER AS n_typos FROM k_docs",
    ),
    "compact_text": (
        compact_text,
        f"SELECT doc_id, {B.compact('raw_text')} AS short, {B.compact('raw_text', 240)} AS longer FROM k_corpus",
    ),
    "contact_signals": (
        contact_signals, f"SELECT doc_id, {B.CONTACT_HIT} AS contact_found, {B.LINK_HIT} AS link_found FROM k_docs",
    ),
    "date_markers": (
        date_markers, f"SELECT doc_id, ({B.DATES})::INTEGER AS n_dates, ({B.YEARS})::INTEGER AS n_years FROM k_docs",
    ),
    "word_count": (word_count, "SELECT doc_id, word_count::INTEGER AS word_count FROM k_profile"),
    "experience_explicit": (experience_explicit, "SELECT doc_id, years::INTEGER AS years FROM k_explicit"),
    "experience_ranges": (
        experience_ranges,
        """SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY pos))::INTEGER AS place, start_year, end_year, at_work
        FROM k_kept_ranges""",
    ),
    "experience_years": (experience_years, "SELECT doc_id, years FROM k_years"),
    "bullet_lines": (bullet_lines, "SELECT doc_id, pos::INTEGER AS place, line FROM k_lines"),
    "weak_bullets": (weak_bullets, "SELECT doc_id, place::INTEGER AS place, line FROM k_weak"),
    "bullet_rewrites": (bullet_rewrites, "SELECT doc_id, place::INTEGER AS place, before, after FROM k_rewrites"),
    "tokens": (
        tokens,
        """SELECT id AS doc_id, len(terms)::INTEGER AS n_tokens, array_to_string(terms, ' ') AS tokens
        FROM k_token_lists WHERE src = 'doc'""",
    ),
    "catalog_keywords": (
        catalog_keywords,
        """SELECT job_id, generate_subscripts(keywords, 1)::INTEGER AS place, unnest(keywords) AS keyword FROM k_roles""",
    ),
    "payload_parse": (
        payload_parse,
        """SELECT id, array_to_string(list_transform(criteria, lambda c: c.name || '=' || c.value), '|') AS criteria,
        array_to_string(suggestions, '|') AS suggestions FROM k_reports""",
    ),
    "match_summary": (match_summary, "SELECT id, summary FROM k_reports"),
    "report_payload": (
        report_payload,
        """SELECT id, array_to_string(list_transform(jobs, lambda j: j.title || '=' || coalesce(CAST(j.match_score AS VARCHAR), '?')), '|') AS jobs,
        len(criteria)::INTEGER AS n_criteria, len(suggestions)::INTEGER AS n_suggestions,
        CASE WHEN analyzed THEN id ELSE -1 END::INTEGER AS word_count FROM k_reports""",
    ),
    "role_hints": (role_hints, "SELECT doc_id, array_to_string(hints, '|') AS hints FROM k_docs"),
    "role_weights": (
        role_weights,
        "SELECT doc_id, "
        + ", ".join(f"round(weights[{n}], 6) AS w_{key}" for n, key in enumerate(L.CRITERION_KEYS, start=1))
        + " FROM k_valued",
    ),
    "profile_skills": (profile_skills, "SELECT doc_id, array_to_string(skills, '|') AS skills FROM k_docs"),
    "profile_verbs": (
        profile_verbs,
        """SELECT doc_id, array_to_string(action_verbs, '|') AS action_verbs, array_to_string(weak_verbs, '|') AS weak_verbs
        FROM k_profile""",
    ),
    "profile": (
        profile,
        """SELECT doc_id, array_to_string(skills, '|') AS skills, years, array_to_string(action_verbs, '|') AS action_verbs,
        array_to_string(weak_verbs, '|') AS weak_verbs, array_to_string(education, '|') AS education,
        word_count::INTEGER AS word_count FROM k_profile""",
    ),
}
