"""The ten criteria of a document: a score from 0 to 10 and one sentence that explains it.

``text`` is always the normalized text, ``p`` the profile struct, ``similarity`` the plain cosine with the target
text (NULL without a target).
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from rolegauge.functions.columns import clip_percent, contained, contains_count, first, joined, let, listed_in
from rolegauge.functions.text import (
    SPACE, WORD_CHAR, alternatives, bullet_markers, compact, date_markers, has_contact, normalize, typo_count, year_markers,
)
from rolegauge.lexicon import (
    CRITERION_KEYS, DEFAULT, DEGREE_REASON_WORDS, DEGREE_WORDS, GPA_VALUES, PROFILE_LINKS, SUMMARY_MARKERS,
    SUMMARY_REASON_MARKERS, Lexicon,
)


def _sentence(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _any(text: Column, values: list[str]) -> Column:
    return contains_count(text, values) > 0


def impact_verbs(text: Column, lex: Lexicon = DEFAULT) -> Column:
    # Only places where a verb may begin are looked at further.
    letters = {verb[:1] for verb in lex.impact_verbs}
    ahead = f"(?=[{''.join(map(re.escape, sorted(letters)))}])" if all(letters) and letters else ""
    return F.regexp_count(text, F.lit(rf"{ahead}(?<!{WORD_CHAR})(?:{alternatives(lex.impact_verbs)})(?!{WORD_CHAR})"))


def spacing_issues(text: Column) -> Column:
    return F.regexp_count(text, F.lit(SPACE + "{2,}"))


def signals(text: Column, lex: Lexicon = DEFAULT) -> dict[str, Column]:
    """Counts and found words that criteria, or a score and its reason, share; put them in columns of their own before scoring."""
    return {
        "n_bullets": bullet_markers(text),
        "n_impact": impact_verbs(text, lex),
        "n_dates": date_markers(text),
        "n_typos": typo_count(text, lex),
        "n_spacing": spacing_issues(text),
        "contact_found": has_contact(text),
        "link_found": _any(text, PROFILE_LINKS),
        "held_summary": contained(text, SUMMARY_MARKERS),
        "held_degrees": contained(text, DEGREE_REASON_WORDS),
        "held_keywords": contained(text, lex.general_keywords),
    }


# ------------------------------------------------------------------------------------------------ scores


def contact_score() -> Column:
    return F.col("contact_found").cast("int") * 5 + F.col("link_found").cast("int") * 5


def summary_score() -> Column:
    return F.least(F.size("held_summary") * 2, F.lit(10))


def experience_score(text: Column, p: Column) -> Column:
    years, verbs, bullets = p["experience_years"], F.col("n_impact"), F.col("n_bullets")
    return (
        F.when((years >= 5) & (verbs >= 3), 10)
        .when((years >= 2) & (verbs >= 2), 8)
        .when((bullets >= 4) & (verbs >= 3), 10)
        .when((bullets >= 2) & (verbs >= 2), 8)
        .when((bullets >= 1) & (verbs >= 1), 6)
        .when(text.contains("experience"), 3)
        .otherwise(0)
    )


def education_score(text: Column) -> Column:
    years = F.least(year_markers(text), F.lit(2))
    base = F.least(F.size(listed_in(DEGREE_WORDS, F.col("held_degrees"))) * 2 + years * 2, F.lit(10))
    graded = text.contains("gpa") & _any(text, GPA_VALUES)
    return F.least(base + graded.cast("int") * 2, F.lit(10))


def skills_score(text: Column, p: Column, lex: Lexicon = DEFAULT) -> Column:
    """Texts with five skills have the full score; the listed ones are looked for in others only."""
    further = F.array_except(contained(text, lex.listed_skills), p["skills"])
    return F.when(F.size(p["skills"]) >= 5, 10).otherwise(F.least((F.size(p["skills"]) + F.size(further)) * 2, F.lit(10)))


def keywords_score() -> Column:
    return F.least(F.size("held_keywords") * 2, F.lit(10))


def consistency_score() -> Column:
    bullets = F.col("n_bullets")
    return F.when((bullets >= 3) & (F.col("n_dates") >= 2), 10).when(bullets >= 2, 6).otherwise(4)


def proofreading_score() -> Column:
    return F.lit(10) - F.least(F.col("n_typos") + F.col("n_spacing"), F.lit(6))


def file_format_score(ext: Column) -> Column:
    return F.when(F.lower(ext).isin("pdf", "docx"), 10).otherwise(7)


def relevance_score(text: Column, similarity: Column) -> Column:
    school = text.contains("high school")
    return (
        F.when(similarity.isNotNull(), clip_percent(similarity * 18, 10))
        .when(school & _any(text, ["bachelor", "master", "university", "college"]), 6)
        .when(school & ~text.contains("degree"), 4)
        .otherwise(10)
    )


def criterion_scores(text: Column, ext: Column, p: Column, similarity: Column, lex: Lexicon = DEFAULT) -> dict[str, Column]:
    """The ten scores by name in criterion order. Needs the ``signals`` columns; put them in columns of their own before explaining them, so
    that a query for one of them does not compute the others."""
    scores = {
        "contact": contact_score(),
        "summary": summary_score(),
        "experience": experience_score(text, p),
        "education": education_score(text),
        "skills": skills_score(text, p, lex),
        "keywords": keywords_score(),
        "consistency": consistency_score(),
        "proofreading": proofreading_score(),
        "file_format": file_format_score(ext),
        "relevance": relevance_score(text, similarity),
    }
    return {key: scores[key].cast("int") for key in CRITERION_KEYS}


# ------------------------------------------------------------------------------------------------ reasons


def contact_reason() -> Column:
    contact, link = F.col("contact_found"), F.col("link_found")
    return (
        F.when(contact & link, "Found direct contact details plus a portfolio, LinkedIn, or GitHub signal.")
        .when(contact, "Found email or phone details; add LinkedIn, GitHub, or portfolio when relevant.")
        .when(link, "Found a profile link, but no clear email or phone number was detected.")
        .otherwise("No clear email, phone, LinkedIn, GitHub, or portfolio signal was detected.")
    )


def summary_reason(score: Column) -> Column:
    found = listed_in(SUMMARY_REASON_MARKERS, F.col("held_summary"))
    return (
        F.when(score >= 7, _sentence("Detected summary-style signals: ", joined(first(found, 4)), "."))
        .when(
            F.size(found) > 0,
            _sentence("Found some summary signals (", joined(first(found, 3)), "), but the section could be clearer."),
        )
        .otherwise("No strong professional summary or objective section was detected.")
    )


def experience_reason(p: Column, score: Column) -> Column:
    bullets, verbs = F.col("n_bullets"), F.col("n_impact")
    return F.when(
        score >= 8,
        _sentence("Detected ", bullets, " bullet markers, ", verbs, " impact verbs, and about ", p["experience_years"],
                  " years of experience."),
    ).otherwise(
        _sentence("Only ", bullets, " bullet markers and ", verbs,
                  " impact verbs were detected; measurable experience bullets would help.")
    )


def education_reason() -> Column:
    found = F.col("held_degrees")
    return F.when(F.size(found) > 0, _sentence("Found education signals: ", joined(first(found, 5)), ".")).otherwise(
        "No clear degree, school, college, university, or diploma signal was detected."
    )


def skills_reason(p: Column) -> Column:
    return F.when(
        F.size(p["skills"]) > 0, _sentence("Detected explicit skills such as ", joined(first(p["skills"], 6)), ".")
    ).otherwise("No canonical skill names from the current skill dictionary were detected.")


def keywords_reason(lex: Lexicon = DEFAULT) -> Column:
    found = F.col("held_keywords")
    return F.when(
        F.size(found) > 0, _sentence(f"Matched {lex.system}-friendly terms: ", joined(first(found, 6)), ".")
    ).otherwise(f"Few general {lex.system}-friendly keywords were found in the resume text.")


def consistency_reason() -> Column:
    return _sentence("Detected ", F.col("n_bullets"), " bullet markers and ", F.col("n_dates"), " date markers.")


def proofreading_reason(text: Column, lex: Lexicon = DEFAULT) -> Column:
    spacing = F.col("n_spacing")

    def told(typos: Column) -> Column:
        issues = F.concat_ws(
            "; ",
            F.when(F.size(typos) > 0, _sentence("possible typos: ", joined(first(typos, 4)))),
            F.when(spacing > 0, _sentence(spacing, " spacing issue(s)")),
        )
        return F.when(
            (F.size(typos) == 0) & (spacing == 0),
            "No common typo or spacing issues from the local checker were detected.",
        ).otherwise(issues)

    return let(contained(text, lex.typos), told)


def file_format_reason(ext: Column, lex: Lexicon = DEFAULT) -> Column:
    preferred = F.when(F.lower(ext).isin("pdf", "docx"), f"a preferred {lex.system} format").otherwise(
        "accepted but less formatting-stable than PDF or DOCX"
    )
    return _sentence(F.upper(ext), " is ", preferred, ".")


def relevance_reason(similarity: Column) -> Column:
    return F.when(
        similarity.isNotNull(),
        _sentence("Target role similarity is ", F.rint(similarity * 100).cast("int"), "% using weighted term overlap."),
    ).otherwise(
        "No target job description was supplied, so relevance used general resume completeness signals."
    )


def reasons(text: Column, ext: Column, p: Column, similarity: Column, scores: dict[str, Column], lex: Lexicon = DEFAULT) -> Column:
    """The ten sentences as a struct in criterion order, each at most 150 characters. ``scores`` are columns by name."""
    sentences = {
        "contact": contact_reason(),
        "summary": summary_reason(scores["summary"]),
        "experience": experience_reason(p, scores["experience"]),
        "education": education_reason(),
        "skills": skills_reason(p),
        "keywords": keywords_reason(lex),
        "consistency": consistency_reason(),
        "proofreading": proofreading_reason(text, lex),
        "file_format": file_format_reason(ext, lex),
        "relevance": relevance_reason(similarity),
    }
    return F.struct(*[compact(sentences[key]).alias(key) for key in CRITERION_KEYS])


# ------------------------------------------------------------------------------------------------ totals


def role_weights(title: Column, lex: Lexicon = DEFAULT) -> Column:
    """Weights in criterion order for a target title: the first known role named in it decides."""
    name = normalize(F.coalesce(title, F.lit("")))
    choice = F.when(F.lit(False), _weights(lex))
    for role in lex.role_weights:
        choice = choice.when(name.contains(role), _weights(lex, role))
    return choice.otherwise(_weights(lex))


def _weights(lex: Lexicon, role: str | None = None) -> Column:
    return F.array(*[F.lit(w) for w in lex.normalized_weights(role)])


def weighted_score(scores: Column, weights: Column) -> Column:
    """Total from 0 to 100. The products are added in criterion order, so equal input gives equal doubles."""
    total = F.lit(0.0)
    for place, key in enumerate(CRITERION_KEYS):
        total = total + scores[key] * F.get(weights, F.lit(place))
    return clip_percent(total * 10, 100)


def default_score(scores: Column, lex: Lexicon = DEFAULT) -> Column:
    return weighted_score(scores, F.array(*[F.lit(lex.weights[key]) for key in CRITERION_KEYS]))


def extreme_labels(scores: Column, lex: Lexicon = DEFAULT) -> tuple[Column, Column]:
    """Labels of the strongest and the weakest criterion, the first one where scores are equal."""
    values = F.array(*[scores[key] for key in CRITERION_KEYS])
    labels = F.array(*[F.lit(label) for label in lex.labels()])

    def label_of(value: Column) -> Column:
        return F.get(labels, (F.array_position(values, value) - 1).cast("int"))

    return label_of(F.array_max(values)), label_of(F.array_min(values))
