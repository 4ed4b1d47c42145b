"""Scores and matching on texts written for these tests; whole results are compared with SQL in test_registry."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from rolegauge import lexicon as L
from rolegauge.functions import terms
from rolegauge.functions.text import prefix_tree
from rolegauge.operators import catalog_match as CM
from rolegauge.operators import criteria as C
from rolegauge.operators.advice import most_missing
from rolegauge.plans.documents import score_documents, termed
from rolegauge.plans.matching import match_documents
from rolegauge.plans.scan import scan

DOCS = [
    (0, "Ran a bakery, kept its books in excel and python, and taught sourdough courses.", "txt", "Pastry Chef", "sourdough ovens python menu planning"),
    (1, "Glazing, kiln work and museum tours; wrote docker files for the shop.", "pdf", "potter", ""),
    (2, "kiln kilns kilnwork", "docx", None, None),
    (3, "qqq", "txt", None, None),
    (4, "", "txt", "Product Manager", None),
]
ROLES = [
    (0, "Baker", "sourdough, books, ovens", "Bake bread"),
    (1, "Ceramist", "kiln, kilns, glaz, tours", "Fire pots"),
    (2, "Scribe", "parchment", None),
    (3, "Baker again", "sourdough, books, ovens", "Bake bread"),
    (4, "Wide", ", ".join(f"kw{n}" for n in range(70)) + ", museum", "many keywords"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id bigint, raw_text string, ext string, title string, description string").withColumns(
        {"user_id": F.lit(1).cast("bigint"), "filename": F.lit("a.txt"), "uploaded_at": F.timestamp_seconds(F.lit(0))}
    )


@pytest.fixture(scope="module")
def roles(spark):
    return spark.createDataFrame(ROLES, "job_id bigint, title string, keywords string, description string")


def test_catalog_matches(docs, roles):
    rows = {r["doc_id"]: r["matches"] for r in match_documents(docs, roles).collect()}
    assert set(rows) == {0, 1, 2, 3, 4} and rows[3] == []
    catalog = {n: {m["title"]: (list(m["matched"]), list(m["missing"])) for m in found if m["source"] == "catalog"} for n, found in rows.items()}
    assert catalog[0] == {"Baker": (["sourdough", "books"], ["ovens"]), "Baker again": (["sourdough", "books"], ["ovens"])}
    assert catalog[1]["Ceramist"] == (["kiln", "glaz", "tours"], ["kilns"])
    assert catalog[1]["Wide"] == (["museum"], ["kw0", "kw1", "kw2", "kw3", "kw4"])
    assert catalog[2]["Ceramist"][0] == ["kiln", "kilns"]
    assert [m["title"] for m in rows[0]][1:3] == ["Baker", "Baker again"]  # equal scores keep catalog order
    scores = [m["match_score"] for m in rows[1] if m["source"] == "catalog"]
    assert scores == sorted(scores, reverse=True)


def test_both_ways_of_finding_keywords_agree(docs, roles, monkeypatch):
    whole = {r["doc_id"]: r["matches"] for r in match_documents(docs, roles).collect()}
    monkeypatch.setattr(CM, "PATTERN_CHARS", 0)
    assert CM.prepare(roles).pattern is None
    assert {r["doc_id"]: r["matches"] for r in match_documents(docs, roles).collect()} == whole


def test_target_match(docs, roles):
    rows = {r["doc_id"]: r["matches"] for r in match_documents(docs, roles).collect()}
    chef = rows[0][0]
    assert (chef["source"], chef["title"], chef["rank"]) == ("target", "Pastry Chef", 1)
    assert {"sourdough", "python"} <= set(chef["matched"]) and "ovens" in chef["missing"] and 0 < chef["match_score"] < 100
    assert rows[4][0]["match_score"] == 0 and rows[4][0]["source"] == "target"


def test_prefix_tree():
    values = ["test", "testing", "contest", "c++", "c", "data analysis"]
    pattern = re.compile(f"(?=({prefix_tree(values)}))")
    assert pattern.findall("testing c++ contest c data analysis") == ["testing", "c++", "contest", "test", "c", "data analysis"]


def test_weighted_scores(spark):
    values = dict(zip(L.CRITERION_KEYS, [0, 10, 0, 0, 0, 0, 0, 0, 0, 0]))
    df = spark.createDataFrame([("",), ("Data Analyst",)], "title string").withColumn(
        "criteria", F.struct(*[F.lit(v).alias(k) for k, v in values.items()])
    )
    rows = df.select(C.default_score(F.col("criteria")), C.weighted_score(F.col("criteria"), C.role_weights(F.col("title")))).collect()
    share = L.DEFAULT.weights[L.CRITERION_KEYS[1]]
    assert rows[0][0] == rows[0][1] == round(100 * share / sum(L.DEFAULT.weights.values()))
    assert abs(sum(L.DEFAULT.normalized_weights("data analyst")) - 1) < 1e-9


def test_extremes_take_the_first_of_equals(spark):
    df = spark.range(1).withColumn("criteria", F.struct(*[F.lit(v).alias(k) for k, v in zip(L.CRITERION_KEYS, [5, 9, 0, 9, 0, 1, 1, 1, 1, 1])]))
    assert tuple(df.select(*C.extreme_labels(F.col("criteria"))).first()) == ("Professional Summary", "Work Experience")


def test_spacing_counts_on_raw_text(spark):
    df = spark.createDataFrame([("a  b   c teh",)], "t string")
    df = df.withColumns(C.signals(F.col("t")))
    row = df.select(C.proofreading_score(), C.proofreading_reason(F.col("t"))).first()
    assert tuple(row) == (7, "possible typos: teh; 2 spacing issue(s)")


def test_relevance_without_target(spark, docs):
    texts = ["high school and college", "high school", "high school degree", "other"]
    df = spark.createDataFrame(
        [(n, t, "txt", None, None) for n, t in enumerate(texts)],
        "doc_id bigint, raw_text string, ext string, title string, description string",
    )
    assert [r[0] for r in score_documents(df, 2026).orderBy("doc_id").select("criteria.relevance").collect()] == [6, 4, 10, 10]


def test_most_missing(spark):
    schema = "matches array<struct<missing:array<string>>>"
    df = spark.createDataFrame([([(["a", "b"],), (["b", "c"],), (["c", "b"],), (["d"],)],)], schema)
    assert df.select(most_missing(F.col("matches"))).first()[0] == ["b", "c", "a"]


def test_scan_rows(docs, roles):
    rows = {r["doc_id"]: r for r in scan(docs, roles, 2026).collect()}
    assert len(rows) == 5
    assert rows[3]["matched_jobs"] == [] and rows[3]["suggestions"]
    steps = rows[0]["analysis"]["analysis_steps"]
    assert len(steps) == 4 and "Pastry Chef" in steps[2]["detail"]
    assert "the selected role" in rows[3]["analysis"]["analysis_steps"][2]["detail"]
    assert scan(docs, roles, 2026).select(F.map_keys("criteria")).first()[0] == L.DEFAULT.labels()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_stay_in_the_jvm(docs, roles):
    plan = plan_of(scan(docs, roles, 2026))
    assert "Python" not in plan and "Arrow" not in plan
    assert "WindowGroupLimit" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_documents_are_read_once(spark, docs, roles):
    """An accumulator in the source counts how often its rows are computed."""
    seen = spark.sparkContext.accumulator(0)

    def count(row):
        seen.add(1)
        return row

    counted = spark.createDataFrame(docs.rdd.map(count), docs.schema)
    for job in (match_documents, lambda d, r: scan(d, r, 2026)):
        before = seen.value
        assert job(counted, CM.prepare(roles)).count() == len(DOCS)
        assert seen.value - before == len(DOCS)


def test_scoring_needs_no_shuffle(docs):
    assert "Exchange" not in plan_of(score_documents(docs, 2026).select("doc_id", "score"))


def test_cosine_of_empty_sides(spark, docs):
    rows = termed(docs).select("doc_id", terms.cosine(F.col("vector"), F.col("role_vector")).alias("c")).collect()
    by_id = {r["doc_id"]: r["c"] for r in rows}
    assert by_id[4] == 0.0 and by_id[3] == 0.0 and by_id[0] > 0


def test_prefix_postings_lose_no_pair(spark):
    """Random texts and roles over words of very different frequency, against the dot products of all pairs."""
    rng = random.Random(8)
    common, rare = [f"common{x}" for x in "abcdef"], [f"rare{x}{y}" for x in "abcdef" for y in "klmnopqrst"]
    text = lambda n, share: " ".join(rng.choice(common if rng.random() < share else rare) for _ in range(n))
    roles = [(n, f"title{n}", f"nokeyword{n}", text(rng.randint(1, 12), rng.choice([0.2, 0.6, 0.95]))) for n in range(60)]
    roles += [(n, f"title{n}", f"nokeyword{n}", " ".join([*rng.sample(rare, 25), *common])) for n in range(60, 160)]
    docs = [(n, text(rng.randint(0, 40), rng.choice([0.1, 0.6, 0.95])), "txt", None, None) for n in range(150)]
    ready = CM.prepare(spark.createDataFrame(roles, "job_id bigint, title string, keywords string, description string"))
    rows = termed(spark.createDataFrame(docs, "doc_id bigint, raw_text string, ext string, title string, description string"))
    rows = rows.select("doc_id", "text", "vector", "doc_squared").cache()
    wanted = {}
    of_role = {r.job_id: ({t.term: t.weight for t in r.vector}, r.job_squared) for r in ready.roles.collect()}
    met = 0
    for d in rows.collect():
        for job, (vector, squared) in of_role.items():
            dot = sum(t.weight * vector.get(t.term, 0) for t in d.vector)
            met += sum(t.term in vector for t in d.vector)
            similarity = dot / (math.sqrt(d.doc_squared) * math.sqrt(squared)) if d.doc_squared else 0.0
            if 0.45 * similarity >= 0.18:
                wanted[d.doc_id, job] = round(similarity, 9)
    found = {(r.doc_id, r.job_id): round(r.similarity, 9) for r in CM.catalog_scores(rows, ready).collect()}
    assert found == wanted and len(wanted) > 100
    joined = rows.select("doc_id", F.explode("vector.term").alias("term")).join(ready.postings.where("kind = 0"), "term").count()
    assert joined < 0.7 * met and len(ready.common) <= CM.COMMON * ready.roles.agg(F.avg(F.size("vector"))).first()[0]
