"""What a document should change: missing keywords, suggestions and the steps of the analysis."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rolegauge.functions.columns import first, joined, let, nonempty
from rolegauge.functions.terms import ranked_terms
from rolegauge.lexicon import DEFAULT, Lexicon
from rolegauge.operators.criteria import extreme_labels


def most_missing(matches: Column) -> Column:
    """The five keywords missed most often by the three best matches; ties keep their first appearance."""
    return first(ranked_terms(F.flatten(F.transform(first(matches, 3), lambda m: m["missing"]))), 5)


def suggestions(scores: Column, matches: Column, p: Column, lex: Lexicon = DEFAULT) -> Column:
    """The first six suggestions that apply, in fixed order."""

    def listed(before: str, values: Column, after: str) -> Column:
        return F.concat(F.lit(before), joined(values), F.lit(after))

    def build(missing: Column) -> Column:
        weak_skills = scores["skills"] < 8
        target_missing = F.get(F.filter(matches, lambda m: m["source"] == "target"), F.lit(0))["missing"]
        slots = [
            F.when(
                scores["contact"] < 8, F.lit("Add a clear email/phone line and include LinkedIn or GitHub when relevant.")
            ),
            F.when(scores["summary"] < 7, F.lit("Add a 2-3 line professional summary tailored to the target role.")),
            F.when(
                scores["experience"] < 7,
                F.lit("Rewrite experience bullets with impact: action verb + task + measurable outcome."),
            ),
            F.when(
                weak_skills & (F.size(missing) > 0),
                listed("Consider adding relevant skills from matching jobs: ", missing, "."),
            ).when(weak_skills, F.lit("Add a dedicated skills section with tools, methods, and soft skills.")),
            F.when(
                F.size(p["weak_verbs"]) > 0,
                listed("Replace weak phrasing like ", first(p["weak_verbs"], 3), " with stronger action verbs."),
            ),
            F.when(
                F.size(p["action_verbs"]) < 4,
                F.lit("Use more accomplishment verbs such as built, improved, automated, delivered, or optimized."),
            ),
            F.when(
                p["word_count"] < 180,
                F.lit("The resume text is quite short; add project, role, education, and achievement detail."),
            ),
            F.when(F.size(p["skills"]) == 0, _skills_wanted(lex)),
            F.when(
                F.size(F.coalesce(target_missing, F.array().cast("array<string>"))) > 0,
                listed("Tailor this resume to the target role by adding evidence for: ", first(target_missing, 5), "."),
            ),
        ]
        return first(F.array_compact(F.array(*slots)), 6)

    return let(most_missing(matches), build)


def _skills_wanted(lex: Lexicon) -> Column:
    return F.lit(f"Add explicit skill names so {lex.system} systems can match your profile reliably.")


def analysis_steps(scores: Column, matches: Column, p: Column, title: Column, lex: Lexicon = DEFAULT) -> Column:
    strongest, weakest = extreme_labels(scores, lex)
    top_title = F.get(matches, F.lit(0))["title"]
    role = (
        F.when(nonempty(title), title).when(nonempty(top_title), top_title).otherwise(F.lit("the selected role"))
    )

    def step(label: str, detail: Column) -> Column:
        return F.struct(F.lit(label).alias("label"), detail.alias("detail"))

    return F.array(
        step(
            "Parsed Resume",
            F.concat(F.lit("Extracted "), p["word_count"].cast("string"), F.lit(" words and "),
                     F.size(p["skills"]).cast("string"), F.lit(" skill signal(s).")),
        ),
        step(
            f"Checked {lex.system} Signals",
            F.concat(F.lit("Strongest area: "), strongest, F.lit(". Weakest area: "), weakest, F.lit(".")),
        ),
        step(
            "Compared Target Role",
            F.concat(F.lit("Compared resume terms with "), role,
                     F.lit(" using role hints and weighted keyword overlap.")),
        ),
        step(
            "Generated Fixes",
            F.lit("Prioritized missing keywords, weak phrasing, measurable impact, and formatting signals."),
        ),
    )
