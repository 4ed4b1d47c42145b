"""Term vectors, similarity and role matching."""

from __future__ import annotations

from pyspark.sql import functions as F

from rolegauge.checks import corpus as X
from rolegauge.checks.plans import planned
from rolegauge.checks.sentences import AS_OF_YEAR
from rolegauge.functions import terms
from rolegauge.functions.columns import elements
from rolegauge.operators.advice import most_missing
from rolegauge.operators.catalog_match import catalog_scores, prepare, with_role_details
from rolegauge.operators.target import coverage, explanation
from rolegauge.plans import documents as D
from rolegauge.plans.matching import match_documents
from rolegauge.plans.scan import scan
from rolegauge.sources import reports as R
from rolegauge.storage import materialize


def bar(array):
    return F.array_join(array, "|")


@planned
def vectors(spark, folder):
    return D.termed(X.corpus(spark, folder))


@planned
def written_vectors(spark, folder):
    """What the catalog side needs, tokenized once: it reads the documents twice."""
    return materialize(vectors(spark, folder).select("doc_id", "text", "vector", "doc_squared"), "vectors")


@planned
def compared(spark, folder):
    return D.with_similarity(vectors(spark, folder)).filter(F.col("target") != "")


def term_freq(spark, folder):
    return elements(vectors(spark, folder), "plain_vector", ["doc_id"], ["at", "t"]).select("doc_id", "t.term", "t.weight")


def weighted_terms(spark, folder):
    return elements(vectors(spark, folder), "vector", ["doc_id"], ["at", "t"]).select("doc_id", "t.term", "t.weight")


def cosine_plain(spark, folder):
    return compared(spark, folder).select("doc_id", F.round("plain_similarity", 6).alias("similarity"))


def cosine_weighted(spark, folder):
    return compared(spark, folder).select("doc_id", F.round("role_similarity", 6).alias("similarity"))


def target_top_terms(spark, folder):
    return elements(compared(spark, folder), "candidates", ["doc_id"], ["at", "term"]).select(
        "doc_id", (F.col("at") + 1).alias("place"), "term"
    )


def keyword_presence(spark, folder):
    return elements(compared(spark, folder), "candidates", ["doc_id", "present"], ["at", "keyword"]).select(
        "doc_id", "keyword", F.array_contains("present", F.col("keyword")).alias("found")
    )


def keyword_coverage(spark, folder):
    docs = compared(spark, folder).withColumn("found", F.array_intersect("candidates", "present"))
    return docs.select(
        "doc_id", F.round(coverage(F.col("found"), F.col("candidates")), 6).alias("coverage"),
        explanation(F.col("found"), F.col("candidates")).alias("explanation"),
    )


def shared_terms(spark, folder):
    shared = F.sort_array(terms.shared_terms(F.col("vector"), F.col("role_vector")))
    return vectors(spark, folder).filter(F.col("target") != "").select(
        "doc_id", F.size(shared).alias("n_shared"), bar(shared).alias("shared")
    )


def target_match(spark, folder):
    m = F.col("target_match")
    return D.with_target_match(compared(spark, folder)).select(
        "doc_id", m["title"].alias("title"), m["description"].alias("description"), m["match_score"].alias("match_score"),
        bar(m["matched"]).alias("matched"), bar(m["missing"]).alias("missing"),
    )


def catalog_match(spark, folder):
    pairs = catalog_scores(written_vectors(spark, folder), prepare(X.catalog(spark, folder)))
    return pairs.select(
        "doc_id", "job_id", "match_score", F.col("n_matched").cast("int").alias("n_matched"),
        F.round("similarity", 6).alias("similarity"),
    )


def catalog_keywords_split(spark, folder):
    ready = prepare(X.catalog(spark, folder))
    named = with_role_details(catalog_scores(written_vectors(spark, folder), ready), ready)
    return named.select("doc_id", "job_id", bar(F.col("matched")).alias("matched"), bar(F.col("missing")).alias("missing"))


@planned
def matched(spark, folder):
    return match_documents(X.corpus(spark, folder), X.catalog(spark, folder))


def recommendations(spark, folder):
    return matched(spark, folder).select("doc_id", F.inline("matches")).select(
        "doc_id", "rank", "source", "job_id", "title", "match_score", bar(F.col("matched")).alias("matched"),
        bar(F.col("missing")).alias("missing"),
    )


def missing_top(spark, folder):
    return matched(spark, folder).select("doc_id", F.posexplode(most_missing(F.col("matches"))).alias("at", "keyword")).select(
        "doc_id", (F.col("at") + 1).alias("place"), "keyword"
    )


def report_build(spark, folder):
    docs = X.corpus(spark, folder)
    ids = R.report_ids(docs, "doc_id", X.reports(spark, folder))
    stored = scan(docs, X.catalog(spark, folder), AS_OF_YEAR).join(ids, "doc_id")
    analysis = F.col("analysis")
    return stored.select(
        "id", "user_id", "filename", R.timestamp_text(F.col("uploaded_at")).alias("uploaded_at"), "score",
        bar(F.transform("matched_jobs", lambda j: F.concat(j["title"], F.lit("="), j["match_score"].cast("string")))).alias("jobs"),
        bar(F.transform(F.map_values("criteria"), lambda v: v.cast("string"))).alias("criteria"),
        bar(F.col("suggestions")).alias("suggestions"),
        bar(F.map_values(analysis["score_details"])).alias("reasons"),
        bar(analysis["bullet_rewrites"]["after"]).alias("rewrites"),
        F.get(analysis["analysis_steps"]["detail"], F.lit(2)).alias("compared"),
        analysis["target_role"].alias("target_role"),
        analysis["target_description_provided"].alias("described"),
    )


ENTRIES = {
    "term_freq": (term_freq, "SELECT id AS doc_id, term, weight FROM k_plain WHERE src = 'doc'"),
    "weighted_terms": (weighted_terms, "SELECT id AS doc_id, term, weight FROM k_terms WHERE src = 'doc'"),
    "cosine_plain": (cosine_plain, "SELECT doc_id, round(plain_similarity, 6) AS similarity FROM k_similarity"),
    "cosine_weighted": (cosine_weighted, "SELECT doc_id, round(role_similarity, 6) AS similarity FROM k_similarity"),
    "target_top_terms": (target_top_terms, "SELECT doc_id, place::INTEGER AS place, term FROM k_candidates"),
    "keyword_presence": (keyword_presence, "SELECT doc_id, term AS keyword, found FROM k_presence"),
    "keyword_coverage": (
        keyword_coverage,
        """SELECT doc_id, round(n_found::DOUBLE / greatest(n_candidates, 1), 6) AS coverage,
        'Matched ' || n_found || ' of ' || n_candidates || ' high-signal target terms.' AS explanation FROM k_target""",
    ),
    "shared_terms": (
        shared_terms,
        """SELECT d.doc_id, count(b.term)::INTEGER AS n_shared, coalesce(string_agg(b.term, '|' ORDER BY b.term), '') AS shared
        FROM k_docs d LEFT JOIN (SELECT a.id, a.term FROM k_terms a JOIN k_terms r
          ON a.src = 'doc' AND r.src = 'role' AND a.id = r.id AND a.term = r.term) b ON b.id = d.doc_id
        WHERE d.target <> '' GROUP BY d.doc_id""",
    ),
    "target_match": (
        target_match,
        """SELECT doc_id, title, description, match_score, array_to_string(matched, '|') AS matched,
        array_to_string(missing, '|') AS missing FROM k_target""",
    ),
    "catalog_match": (
        catalog_match,
        """SELECT doc_id, job_id, match_score, n_matched::INTEGER AS n_matched, round(similarity, 6) AS similarity FROM k_kept""",
    ),
    "catalog_keywords_split": (
        catalog_keywords_split,
        """SELECT doc_id, job_id, array_to_string(matched, '|') AS matched, array_to_string(missing, '|') AS missing FROM k_kept""",
    ),
    "recommendations": (
        recommendations,
        """SELECT doc_id, rank::INTEGER AS rank, source, job_id, title, match_score, array_to_string(matched, '|') AS matched,
        array_to_string(missing, '|') AS missing FROM k_matches""",
    ),
    "missing_top": (missing_top, "SELECT doc_id, place::INTEGER AS place, keyword FROM k_missing"),
    "report_build": (
        report_build,
        """SELECT (SELECT max(event_id) FROM events) + row_number() OVER (ORDER BY s.doc_id) AS id, s.user_id, s.filename,
          strftime(make_timestamp(s.uploaded_s * 1000000), '%Y-%m-%dT%H:%M:%S') || '+00:00' AS uploaded_at, s.score,
          array_to_string(list_transform(s.matches, lambda m: m.title || '=' || m.score), '|') AS jobs,
          array_to_string(s.vals, '|') AS criteria, array_to_string(g.suggestions, '|') AS suggestions,
          e.reasons, coalesce(w.rewrites, '') AS rewrites, t.compared, coalesce(s.title, '') AS target_role,
          coalesce(s.description, '') <> '' AS described
        FROM k_advised s
        JOIN k_suggestions g USING (doc_id) JOIN k_steps t USING (doc_id)
        JOIN (SELECT doc_id, string_agg(reason, '|' ORDER BY place) AS reasons FROM k_reasons GROUP BY doc_id) e USING (doc_id)
        LEFT JOIN (SELECT doc_id, string_agg(after, '|' ORDER BY place) AS rewrites FROM k_rewrites GROUP BY doc_id) w USING (doc_id)""",
    ),
}
