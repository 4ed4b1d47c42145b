"""The column stages of a scan. Each stage only adds columns, so Catalyst drops whatever a caller does not use."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rolegauge.functions.columns import contained, let
from rolegauge.functions.experience import experience_years
from rolegauge.functions.terms import (
    bag_cosine, begun_squared_norm, cosine_of, dot_product, present_terms, role_hints, skills, squared_norm, term_vector, tokens, top_terms,
    weighted_bag,
)
from rolegauge.functions.text import normalize, strip, word_count, word_hits
from rolegauge.lexicon import CRITERION_KEYS, DEFAULT, EDUCATION_WORDS, Lexicon
from rolegauge.operators import criteria as C
from rolegauge.operators.target import target_match, target_text


def with_text(docs: DataFrame) -> DataFrame:
    """Normalized texts of the document, of its target role, and of that role with its known keywords."""
    docs = docs.withColumns({name: strip(F.col(name)) for name in ("title", "description")})
    plain_target = target_text(F.col("title"), F.col("description"))
    hints = F.array_join(role_hints(F.coalesce(F.col("title"), F.lit(""))), " ")
    return docs.withColumn("text", normalize(F.col("raw_text"))).withColumn("target", normalize(plain_target)).withColumn(
        "role_text", F.when(F.col("target") != "", normalize(F.concat_ws(" ", plain_target, hints))).otherwise("")
    )


def with_skills(docs: DataFrame, lex: Lexicon = DEFAULT) -> DataFrame:
    return docs.withColumns({f"{name}_skills": skills(F.col(name), lex) for name in ("text", "target", "role_text")})


def with_tokens(docs: DataFrame, lex: Lexicon = DEFAULT) -> DataFrame:
    return docs.withColumns(
        {f"{name}_tokens": tokens(F.col(name), F.col(f"{name}_skills"), lex) for name in ("text", "target", "role_text")}
    )


def with_bags(docs: DataFrame, lex: Lexicon = DEFAULT) -> DataFrame:
    return docs.withColumns(
        {
            f"{name}_bag": weighted_bag(F.col(name), F.col(f"{name}_skills"), F.col(f"{name}_tokens"), lex)
            for name in ("text", "role_text")
        }
    )


def with_vectors(docs: DataFrame) -> DataFrame:
    return docs.withColumns(
        {
            "plain_vector": term_vector(F.col("text_tokens")),
            "plain_target_vector": term_vector(F.col("target_tokens")),
            "vector": term_vector(F.col("text_bag")),
            "role_vector": term_vector(F.col("role_text_bag")),
        }
    ).withColumn("doc_squared", squared_norm(F.col("vector")))


def with_similarity(docs: DataFrame, lex: Lexicon = DEFAULT, vectors: bool = False) -> DataFrame:
    """Similarity with the target role, NULL where there is none. With ``vectors`` the weighted vectors are computed anyhow, and what they know
    of the plain ones is used."""
    given = F.col("target") != ""
    plain_squared = begun_squared_norm(F.col("text_tokens"), F.col("text_bag"), F.col("doc_squared")) if vectors else None
    dot = dot_product(F.col("vector"), F.col("role_vector"))
    similarity = let(squared_norm(F.col("role_vector")), lambda role_squared: cosine_of(dot, F.col("doc_squared"), role_squared))
    return docs.withColumns(
        {
            "plain_similarity": F.when(given, bag_cosine(F.col("text_tokens"), F.col("target_tokens"), plain_squared)),
            "role_similarity": F.when(given, similarity),
            "candidates": F.when(given, top_terms(F.col("role_text_bag"), lex)),
        }
    ).withColumn("present", present_terms(F.col("text"), F.col("text_skills"), F.col("candidates"), lex))


def with_target_match(docs: DataFrame) -> DataFrame:
    match = target_match(
        F.col("title"), F.col("description"), F.col("role_similarity"), F.col("candidates"), F.col("present")
    )
    return docs.withColumn("target_match", F.when(F.col("target") != "", match))


def with_profile(docs: DataFrame, as_of_year: int, lex: Lexicon = DEFAULT) -> DataFrame:
    """Adds the profile, and its years as `profile_years`: criteria read those, so that a query without profiles does not compute the rest."""
    text = F.col("text")
    return docs.withColumn("profile_years", experience_years(text, as_of_year)).withColumn(
        "profile",
        F.struct(
            F.col("text_skills").alias("skills"),
            F.col("profile_years").alias("experience_years"),
            word_hits(text, lex.action_verbs).alias("action_verbs"),
            contained(text, sorted(lex.weak_verbs)).alias("weak_verbs"),
            contained(text, sorted(EDUCATION_WORDS)).alias("education"),
            word_count(text).alias("word_count"),
        ),
    )


def with_criteria(docs: DataFrame, lex: Lexicon = DEFAULT) -> DataFrame:
    text, similarity = F.col("text"), F.col("plain_similarity")
    p = F.struct(F.col("text_skills").alias("skills"), F.col("profile_years").alias("experience_years"))
    signalled = docs.withColumns(C.signals(text, lex))
    found = {f"{key}_points": score for key, score in C.criterion_scores(text, F.col("ext"), p, similarity, lex).items()}
    points = {key: F.col(f"{key}_points") for key in CRITERION_KEYS}
    return (
        signalled.withColumns(found)
        .withColumn("criteria", F.struct(*[points[key].alias(key) for key in CRITERION_KEYS]))
        .withColumn("reasons", C.reasons(text, F.col("ext"), p, similarity, points, lex))
        .withColumn("weights", C.role_weights(F.col("title"), lex))
        .withColumn("score", C.weighted_score(F.col("criteria"), F.col("weights")))
        .drop(*found, "profile_years")
    )


def termed(docs: DataFrame, lex: Lexicon = DEFAULT) -> DataFrame:
    """Documents with texts, skills, tokens, bags and vectors."""
    return with_vectors(with_bags(with_tokens(with_skills(with_text(docs), lex), lex), lex))


def score_documents(docs: DataFrame, as_of_year: int, lex: Lexicon = DEFAULT) -> DataFrame:
    """Profile, criteria, reasons and total score of every document; needs no shuffle.

    ``docs`` holds ``doc_id, raw_text, ext, title, description`` and any further columns. Works on batches and
    on streams.
    """
    return score_termed(termed(docs, lex), as_of_year, lex)


def score_termed(docs: DataFrame, as_of_year: int, lex: Lexicon = DEFAULT, vectors: bool = False) -> DataFrame:
    compared = with_target_match(with_similarity(docs, lex, vectors))
    return with_criteria(with_profile(compared, as_of_year, lex), lex)


