"""Terms of one text and the similarity of two texts, computed inside the row.

A term vector is ``ARRAY<STRUCT<term, weight>>`` sorted by term. It comes from a bag of words (an array with
repeats): a weight is the number of repeats, so a bonus of three is three more repeats. No shuffle is needed
for anything in this module.
"""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from rolegauge.functions.columns import first, let, words
from rolegauge.functions.text import TOKEN, WORD_CHAR, listed_terms, normalize, term_hits
from rolegauge.lexicon import DEFAULT, REQUIREMENT_PHRASES, Lexicon

# Fixed patterns and limits.
REQUIREMENT = rf"(?=[{''.join(sorted({p[0] for p in REQUIREMENT_PHRASES}))}])(?<!{WORD_CHAR})(?:{'|'.join(REQUIREMENT_PHRASES)})\s+([^.;:\n]+)"
SKILL_BONUS = 3
REQUIREMENT_BONUS = 2
TOP_TERMS = 18
# More shared terms than this are not looked up one by one.
MOST_LOOKUPS = 64


def skills(text: Column, lex: Lexicon = DEFAULT) -> Column:
    """Canonical skills with an alias in normalized ``text``, in dictionary order."""
    aliases = [alias for group in lex.skills.values() for alias in group]
    return let(
        term_hits(text, aliases),
        lambda hits: F.filter(_skill_table(lex), lambda s: F.arrays_overlap(s["aliases"], hits)),
    ).getField("name")


def _skill_table(lex: Lexicon) -> Column:
    """The dictionary as one constant: ``ARRAY<STRUCT<name, aliases>>``."""
    rows = json.dumps([{"name": name, "aliases": group} for name, group in lex.skills.items()])
    return F.from_json(F.lit(rows), "array<struct<name:string,aliases:array<string>>>")


def base_tokens(text: Column, lex: Lexicon = DEFAULT) -> Column:
    """Word-like tokens of normalized ``text`` without stop words."""
    return F.filter(F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0)), lambda t: ~t.isin(lex.stop_words))


def tokens(text: Column, found_skills: Column, lex: Lexicon = DEFAULT) -> Column:
    """Tokens, followed by the words of every skill found in the text."""
    return F.concat(base_tokens(text, lex), F.flatten(F.transform(found_skills, lambda s: F.split(s, " "))))


def weighted_bag(text: Column, found_skills: Column, plain_tokens: Column, lex: Lexicon = DEFAULT) -> Column:
    """Tokens plus the bonus for skills and for the words of requirement phrases."""
    bonus = F.flatten(F.transform(found_skills, lambda s: F.array_repeat(s, SKILL_BONUS)))
    phrases = F.regexp_extract_all(text, F.lit(REQUIREMENT), F.lit(1))

    def phrase_tokens(phrase: Column) -> Column:
        return let(
            F.trim(phrase),
            lambda p: F.flatten(F.array_repeat(tokens(p, skills(p, lex), lex), REQUIREMENT_BONUS)),
        )

    return F.concat(plain_tokens, bonus, F.flatten(F.transform(phrases, phrase_tokens)))


def _run_starts(ordered: Column, key) -> Column:
    """Positions where a new key starts in a sorted array."""
    places = F.when(F.size(ordered) > 0, F.sequence(F.lit(0), F.size(ordered) - 1)).when(ordered.isNotNull(), F.array().cast("array<int>"))
    return F.filter(places, lambda i: (i == 0) | (key(F.get(ordered, i)) != key(F.get(ordered, i - 1))))


def term_vector(bag: Column) -> Column:
    """Term weights of a bag of words."""

    def runs(ordered: Column) -> Column:
        return let(
            _run_starts(ordered, lambda x: x),
            lambda starts: F.transform(
                starts,
                lambda at, k: F.struct(
                    F.get(ordered, at).alias("term"),
                    (F.coalesce(F.get(starts, k + 1), F.size(ordered)) - at).cast("bigint").alias("weight"),
                ),
            ),
        )

    return let(F.sort_array(bag), runs)


def ranked_terms(bag: Column) -> Column:
    """Terms by weight, highest first; equal weights keep the order of first appearance."""
    placed = F.transform(bag, lambda t, i: F.struct(t.alias("term"), i.alias("at")))

    def runs(ordered: Column) -> Column:
        return let(
            _run_starts(ordered, lambda x: x["term"]),
            lambda starts: F.transform(
                starts,
                lambda at, k: F.struct(
                    (at - F.coalesce(F.get(starts, k + 1), F.size(ordered))).alias("negative_weight"),
                    F.get(ordered, at)["at"].alias("at"),
                    F.get(ordered, at)["term"].alias("term"),
                ),
            ),
        )

    return F.sort_array(let(F.sort_array(placed), runs)).getField("term")


def squared_norm(vector: Column) -> Column:
    return F.aggregate(vector, F.lit(0).cast("bigint"), lambda acc, t: acc + t["weight"] * t["weight"])


def shared_terms(left: Column, right: Column) -> Column:
    return F.array_intersect(left.getField("term"), right.getField("term"))


def dot_product(left: Column, right: Column) -> Column:
    """Both vectors in one sorted array: the two entries of a shared term become neighbours."""

    def neighbours(both: Column) -> Column:
        rest = F.size(both) - 1
        pairs = F.zip_with(
            F.slice(both, F.lit(1), F.greatest(rest, F.lit(0))), F.slice(both, F.lit(2), F.greatest(rest, F.lit(0))),
            lambda a, b: F.when(a["term"] == b["term"], a["weight"] * b["weight"]).otherwise(F.lit(0).cast("bigint")),
        )
        return F.aggregate(pairs, F.lit(0).cast("bigint"), lambda total, product: total + product)

    return let(F.sort_array(F.concat(left, right)), neighbours)


def cosine_of(dot: Column, left_squared: Column, right_squared: Column) -> Column:
    """Cosine from the dot product and the two squared norms, 0 when a side is empty."""
    return F.when((left_squared > 0) & (right_squared > 0), dot / (F.sqrt(left_squared) * F.sqrt(right_squared))).otherwise(
        F.lit(0.0)
    )


def cosine(left: Column, right: Column) -> Column:
    return let(
        squared_norm(left), lambda a: let(squared_norm(right), lambda b: cosine_of(dot_product(left, right), a, b))
    )


def bag_cosine(left: Column, right: Column, left_squared: Column | None = None) -> Column:
    """``cosine`` of the vectors of two bags of words, without building the vectors: only the counts of shared terms are looked up.
    ``left_squared`` is the squared norm of the left one, where it is known."""
    counted = let(left, lambda a: let(right, lambda b: _bag_dot(a, b)))
    known = bag_squared_norm(left) if left_squared is None else left_squared
    return let(known, lambda a: let(bag_squared_norm(right), lambda b: cosine_of(counted, a, b)))


def begun_squared_norm(bag: Column, longer: Column, longer_squared: Column) -> Column:
    """``bag_squared_norm`` of a bag that ``longer`` begins with, from the squared norm of ``longer``: the counts of the few terms behind it
    are put right. A bag with many such terms is counted itself."""

    def put_right(behind: Column, terms: Column) -> Column:
        def less(total: Column, term: Column) -> Column:
            return let(_count(behind, term), lambda n: total - (_count(longer, term) * 2 - n) * n)

        return F.when(F.size(terms) <= MOST_LOOKUPS, F.aggregate(terms, longer_squared, less)).otherwise(bag_squared_norm(bag))

    behind = F.slice(longer, F.size(bag) + 1, F.greatest(F.size(longer) - F.size(bag), F.lit(0)))
    return let(behind, lambda b: let(F.array_distinct(b), lambda terms: put_right(b, terms)))


def bag_squared_norm(bag: Column) -> Column:
    """``squared_norm`` of a bag's vector."""

    def total(ordered: Column) -> Column:
        zero = F.lit(0).cast("bigint")
        return let(
            _run_starts(ordered, lambda x: x),
            lambda starts: F.aggregate(
                F.transform(starts, lambda at, k: (F.coalesce(F.get(starts, k + 1), F.size(ordered)) - at).cast("bigint")),
                zero, lambda acc, count: acc + count * count,
            ),
        )

    return let(F.sort_array(bag), total)


def _count(bag: Column, term: Column) -> Column:
    return (F.size(bag) - F.size(F.array_remove(bag, term))).cast("bigint")


def _bag_dot(left: Column, right: Column) -> Column:
    return let(
        F.array_intersect(left, right),
        lambda shared: F.when(
            F.size(shared) <= MOST_LOOKUPS,
            F.aggregate(shared, F.lit(0).cast("bigint"), lambda acc, term: acc + _count(left, term) * _count(right, term)),
        ).otherwise(dot_product(term_vector(left), term_vector(right))),
    )


def role_hints(title: Column, lex: Lexicon = DEFAULT) -> Column:
    """Keywords of every known role named in the title, without repeats."""

    def hinted(name: Column) -> Column:
        return F.concat(*[F.when(name.contains(role), words(hints)).otherwise(words([])) for role, hints in lex.role_hints.items()])

    return F.array_distinct(let(normalize(title), hinted))


def top_terms(bag: Column, lex: Lexicon = DEFAULT) -> Column:
    """The 18 heaviest terms that say something about a role."""
    kept = F.filter(bag, lambda t: (F.length(t) > 2) & ~t.isin(lex.low_signal_words))
    return first(ranked_terms(kept), TOP_TERMS)


def present_terms(text: Column, found_skills: Column, candidates: Column, lex: Lexicon = DEFAULT) -> Column:
    """The candidates shown by a text: a skill by any of its aliases, every other term by itself."""
    names = words(lex.skills)
    plain = listed_terms(text, F.array_except(candidates, names))
    return F.array_intersect(candidates, F.concat(found_skills, plain))
