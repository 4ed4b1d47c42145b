"""Rank the roles of a catalog for every document, the document's own target role first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rolegauge.lexicon import DEFAULT, Lexicon
from rolegauge.operators.catalog_match import TOP_MATCHES, Prepared, best_roles, prepare
from rolegauge.operators.target import MATCH_TYPE
from rolegauge.plans.documents import termed, with_similarity, with_target_match
from rolegauge.storage import materialize


def catalog_matches(docs: DataFrame, ready: Prepared) -> DataFrame:
    """``doc_id, roles``: up to five catalog roles per document in rank order, without a row where none fits.

    ``docs`` comes from ``termed``.
    """
    best = best_roles(docs, ready)
    role = F.struct(
        F.col("place").alias("rank"), F.lit("catalog").alias("source"), "job_id", "title", "description", "match_score",
        "matched", "missing",
    )
    return best.groupBy("doc_id").agg(F.sort_array(F.collect_list(role)).cast(f"array<{MATCH_TYPE}>").alias("roles"))


def merged(docs: DataFrame) -> DataFrame:
    """Add ``matches``: the target role first, then the catalog roles, at most five in total."""
    target = F.when(F.col("target_match").isNotNull(), F.array("target_match")).otherwise(F.array())
    both = F.concat(target.cast(f"array<{MATCH_TYPE}>"), F.coalesce("roles", F.array().cast(f"array<{MATCH_TYPE}>")))
    return docs.withColumn("matches", F.transform(F.slice(both, 1, TOP_MATCHES), lambda m, i: m.withField("rank", i + 1)))


def match_documents(docs: DataFrame, catalog: DataFrame | Prepared, lex: Lexicon = DEFAULT) -> DataFrame:
    """``doc_id, matches`` for every document; the list is empty where nothing fits.

    The documents are read, normalized and tokenized once; what both branches need is written to the shared folder.
    """
    ready = catalog if isinstance(catalog, Prepared) else prepare(catalog, lex)
    compared = with_target_match(with_similarity(termed(docs, lex), lex))
    local = materialize(compared.select("doc_id", "text", "vector", "doc_squared", "target_match"), "documents")
    return merged(local.select("doc_id", "target_match").join(catalog_matches(local, ready), "doc_id", "left")).select("doc_id", "matches")
