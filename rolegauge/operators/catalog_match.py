"""Documents against a whole role catalog.

A pair is kept for a keyword in the text, or for a similarity of LEAST_SIMILARITY or more. So a role is filed under its keywords and under a
prefix of its term vector: its terms from rare to common in the catalog, until the rest of the vector is shorter than
LEAST_SIMILARITY of the whole. A document that has no term of the prefix can reach no more than the rest, which is too little: no kept pair
is missed, and common terms bring no pairs. Only terms of at least one role in COMMON stand behind a prefix; there are at most COMMON times
the mean length of a vector of them, however large the catalog is. Every document is exploded into its other terms and keyword hits and
joined with the postings, which gives the pairs and the prefix part of their dot products; the common terms are added inside the row of
a pair found so.

`prepare` writes the postings once, for any number of batches. One plan serves any catalog: the joins carry no hint, Spark
broadcasts the written table while its size in bytes allows and shuffles both sides beyond that. Keywords are found by one
pattern per text while they have at most PATTERN_CHARS characters together, and by a join on their first characters beyond;
both find the same.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rolegauge.functions.columns import clip_percent, first, let, words
from rolegauge.functions.terms import cosine_of, skills, squared_norm, term_vector, tokens, weighted_bag
from rolegauge.functions.text import normalize, prefix_tree
from rolegauge.lexicon import DEFAULT, Lexicon
from rolegauge.sources.catalog import with_keywords
from rolegauge.storage import materialize

PATTERN_CHARS = 2_000_000
GRAM = 4
MASK_BITS = 62

# Fixed limits and weights of the match.
KEYWORD_SHARE, TERM_SHARE, THRESHOLD = 0.55, 0.45, 0.18
TOP_MATCHES, MOST_MISSING = 5, 5
LEAST_SIMILARITY = THRESHOLD / TERM_SHARE
#: The bound is lowered by this share, far more than the rounding of a similarity.
ROUNDING = 1e-9
COMMON = 20


def role_vectors(catalog: DataFrame, lex: Lexicon = DEFAULT) -> DataFrame:
    """Roles with their term vector and its squared norm."""
    roles = with_keywords(catalog)
    text = F.concat_ws(" ", "title", "description", F.array_join("keywords", " "))
    return (
        roles.withColumn("text", normalize(text))
        .withColumn("skills", skills(F.col("text"), lex))
        .withColumn("tokens", tokens(F.col("text"), F.col("skills"), lex))
        .withColumn("vector", term_vector(weighted_bag(F.col("text"), F.col("skills"), F.col("tokens"), lex)))
        .select("job_id", "title", "description", "keywords", "vector", squared_norm(F.col("vector")).alias("job_squared"))
    )


def keyword_postings(roles: DataFrame) -> DataFrame:
    """(keyword the pattern reports) -> role and place of every role keyword that the report implies.

    The pattern reports the longest keyword at a position; the shorter ones there are its prefixes.
    """
    placed = roles.select("job_id", F.posexplode("keywords").alias("place", "keyword"))
    known = placed.select(F.col("keyword").alias("term")).distinct()
    prefixes = known.select(
        "term",
        F.explode(
            F.transform(F.sequence(F.lit(1), F.length("term")), lambda n: F.substring("term", F.lit(1), n))
        ).alias("keyword"),
    )
    return prefixes.join(placed, "keyword").select("term", "job_id", "place")


def with_rest(roles: DataFrame) -> DataFrame:
    """Roles with ``prefix`` and ``rest``: the terms of which a similar document must share at least one, and the more common others."""
    entries = roles.select("job_id", "job_squared", F.explode("vector").alias("t")).select("job_id", "job_squared", "t.term", "t.weight")
    spread = entries.groupBy("term").agg(F.count("*").alias("n_roles"))
    common_first = Window.partitionBy("job_id").orderBy(F.desc("n_roles"), F.desc("term"))
    length = F.sum(F.col("weight") * F.col("weight")).over(common_first.rowsBetween(Window.unboundedPreceding, 0))
    bound = LEAST_SIMILARITY * LEAST_SIMILARITY * (1 - ROUNDING)
    enough = F.col("n_roles") * COMMON >= F.lit(roles.count())
    placed = entries.join(spread, "term").withColumn("behind", (length < F.col("job_squared") * bound) & enough)
    entry = F.struct("term", "weight")
    split = placed.groupBy("job_id").agg(
        F.collect_list(F.when(~F.col("behind"), entry)).alias("prefix"), F.collect_list(F.when(F.col("behind"), entry)).alias("rest")
    )
    none = F.array().cast("array<struct<term:string,weight:bigint>>")
    return roles.join(split, "job_id", "left").withColumns({name: F.coalesce(name, none) for name in ("prefix", "rest")})


def postings(roles: DataFrame, n_masks: int) -> DataFrame:
    """Prefix terms and keywords of the roles in one table; keyword places are bits of ``n_masks`` numbers."""
    by_term = roles.select("job_id", F.explode("prefix").alias("t")).select(
        F.lit(0).alias("kind"), F.col("t.term").alias("term"), "job_id", F.col("t.weight").alias("job_weight"),
        *[F.lit(0).cast("bigint").alias(f"mask{m}") for m in range(n_masks)],
    )
    place = F.col("place")
    by_keyword = keyword_postings(roles).select(
        F.lit(1).alias("kind"), "term", "job_id", F.lit(0).cast("bigint").alias("job_weight"),
        *[
            F.when(
                F.floor(place / MASK_BITS) == m, F.call_function("shiftleft", F.lit(1).cast("bigint"), place % MASK_BITS)
            )
            .otherwise(F.lit(0).cast("bigint"))
            .alias(f"mask{m}")
            for m in range(n_masks)
        ],
    )
    return by_term.unionByName(by_keyword)


@dataclass(frozen=True)
class Prepared:
    """A catalog ready to be matched: written roles and postings, and the pattern of all keywords if it is short enough."""

    roles: DataFrame
    postings: DataFrame
    common: list[str]
    n_masks: int
    pattern: str | None
    lex: Lexicon


def prepare(catalog: DataFrame, lex: Lexicon = DEFAULT) -> Prepared:
    roles = materialize(with_rest(materialize(role_vectors(catalog, lex), "role-vectors")), "roles")
    longest = roles.agg(F.coalesce(F.max(F.size("keywords")), F.lit(0))).first()[0]
    masks = max(1, math.ceil(longest / MASK_BITS))
    known = roles.select(F.explode("keywords").alias("keyword")).distinct()
    chars = known.agg(F.coalesce(F.sum(F.length("keyword")), F.lit(0))).first()[0]
    pattern = prefix_tree(row[0] for row in known.toLocalIterator()) if 0 < chars <= PATTERN_CHARS else None
    common = sorted(row[0] for row in roles.select(F.explode("rest.term").alias("term")).distinct().collect())
    return Prepared(roles, materialize(postings(roles, masks), "postings"), common, masks, pattern, lex)


def by_pattern(docs: DataFrame, pattern: str) -> DataFrame:
    """The longest keyword at every place of the text; the postings add those that begin it."""
    return docs.withColumn("hits", F.array_distinct(F.regexp_extract_all("text", F.lit(f"(?=({pattern}))"), F.lit(1))))


def by_first_signs(docs: DataFrame, roles: DataFrame) -> DataFrame:
    """All keywords in the text: those whose first GRAM signs the text has are candidates, then the text decides."""
    known = roles.select(F.explode("keywords").alias("keyword")).distinct()
    known = known.withColumn("gram", F.substring("keyword", 1, GRAM))
    places = F.sequence(F.lit(1), F.greatest(F.length("text"), F.lit(1)))

    def grams_of(size: int) -> Column:
        return F.transform(places, lambda at: F.substring(F.col("text"), at, F.lit(size)))

    grams = [grams_of(size) for size in range(1, GRAM + 1)]
    found = docs.select("doc_id", F.explode(F.array_distinct(F.concat(*grams))).alias("gram")).join(known, "gram")
    checked = found.select("doc_id", "keyword").distinct().join(docs.select("doc_id", "text"), "doc_id")
    hits = checked.filter(F.contains("text", "keyword")).groupBy("doc_id").agg(F.collect_set("keyword").alias("hits"))
    return docs.join(hits, "doc_id", "left").withColumn("hits", F.coalesce("hits", F.array().cast("array<string>")))


def candidates(docs: DataFrame, ready: Prepared) -> DataFrame:
    """``doc_id, doc_squared, job_id``, the dot product over prefix terms and the keyword masks of the pairs that share a keyword or a
    prefix term."""
    narrow = docs.select("doc_id", "text", "vector", "doc_squared")
    with_hits = by_pattern(narrow, ready.pattern) if ready.pattern else by_first_signs(narrow, ready.roles)

    def entry(kind: int, term: Column, weight: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), term.alias("term"), weight.alias("weight"))

    entries = F.concat(
        F.transform("vector", lambda t: entry(0, t["term"], t["weight"])),
        F.transform("hits", lambda h: entry(1, h, F.lit(0).cast("bigint"))),
    )
    return (
        with_hits.select("doc_id", "doc_squared", F.explode(entries).alias("e"))
        .select("doc_id", "doc_squared", "e.kind", "e.term", "e.weight")
        .join(ready.postings, ["kind", "term"])
        .groupBy("doc_id", "doc_squared", "job_id")
        .agg(F.sum(F.col("weight") * F.col("job_weight")).alias("dot"), *[F.bit_or(f"mask{m}").alias(f"mask{m}") for m in range(ready.n_masks)])
    )


def common_weights(docs: DataFrame, ready: Prepared) -> DataFrame:
    """``doc_id, common``: the document's weight of each common term, 0 where it has none."""
    own = F.filter("vector", lambda t: t["term"].isin(ready.common))
    zero = F.lit(0).cast("bigint")
    weights = let(F.map_from_entries(own), lambda m: F.transform(words(ready.common), lambda t: F.coalesce(F.try_element_at(m, t), zero)))
    return docs.select("doc_id", weights.alias("common"))


def catalog_scores(docs: DataFrame, ready: Prepared) -> DataFrame:
    """Scores of all kept (document, role) pairs; ``docs`` needs ``doc_id, text, vector, doc_squared``. It is read twice, so it should be a
    written table."""
    masks = [f"mask{m}" for m in range(ready.n_masks)]
    place = lambda t: (F.array_position(words(ready.common), t["term"]) - 1).cast("int").alias("place")
    behind = F.transform("rest", lambda t: F.struct(place(t), t["weight"].alias("weight")))
    sizes = ready.roles.select("job_id", behind.alias("rest"), "job_squared", F.size("keywords").alias("n_keywords"))
    n_matched = sum((F.bit_count(m) for m in masks), F.lit(0))
    ratio = F.col("n_matched") / F.greatest("n_keywords", F.lit(1))
    pairs = candidates(docs, ready).join(common_weights(docs, ready), "doc_id").join(sizes, "job_id")
    zero = F.lit(0).cast("bigint")
    behind = F.aggregate("rest", zero, lambda total, t: total + t["weight"] * F.get("common", t["place"]))
    # A generated column is computed once; a plain one would be computed again in the filter.
    whole = F.explode(F.array(F.col("dot") + behind))
    return (
        pairs.select("doc_id", "doc_squared", "job_id", "job_squared", "n_keywords", *masks, whole.alias("dot"))
        .withColumn("n_matched", n_matched)
        .withColumn("similarity", cosine_of(F.col("dot"), F.col("doc_squared"), F.col("job_squared")))
        .withColumn("combined", ratio * KEYWORD_SHARE + F.col("similarity") * TERM_SHARE)
        .filter((F.col("combined") >= THRESHOLD) | (F.col("n_matched") > 0))
        .select(
            "doc_id", "job_id", clip_percent(F.col("combined") * 100, 100).alias("match_score"), "n_matched",
            "similarity", "combined", F.array(*masks).alias("masks"),
        )
    )


def with_role_details(pairs: DataFrame, ready: Prepared) -> DataFrame:
    """Add the role's texts and its keywords split into matched and missing ones."""
    details = ready.roles.select("job_id", "title", "description", "keywords")

    def found(place: Column) -> Column:
        mask = F.get("masks", F.floor(place / MASK_BITS).cast("int"))
        return F.getbit(mask, (place % MASK_BITS).cast("int")) == 1

    return pairs.join(details, "job_id").select(
        "doc_id", "job_id", "title", "description", "match_score",
        F.filter("keywords", lambda k, at: found(at)).alias("matched"),
        first(F.filter("keywords", lambda k, at: ~found(at)), MOST_MISSING).alias("missing"),
    )


def best_roles(docs: DataFrame, ready: Prepared, top: int = TOP_MATCHES) -> DataFrame:
    """The best roles of every document with a ``place`` from 1; equal scores keep catalog order."""
    order = Window.partitionBy("doc_id").orderBy(F.desc("match_score"), "job_id")
    narrow = catalog_scores(docs, ready).select("doc_id", "job_id", "match_score", "masks")
    ranked = narrow.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= top)
    named = with_role_details(ranked.drop("place"), ready)
    return named.withColumn("place", F.row_number().over(order))
