"""Work that grows with the tables is done once and dealt out; the rows are written for these tests."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from rolegauge.checks.registry import queries
from rolegauge.functions.columns import contained, elements
from rolegauge.functions.terms import MOST_LOOKUPS, bag_squared_norm, begun_squared_norm
from rolegauge.functions.text import MOST_BRANCHES, prefix_tree
from rolegauge.lexicon import DEFAULT
from rolegauge.operators import criteria as C
from rolegauge.schemas import STORED_REPORTS_DDL
from rolegauge.sources import reports as R


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    texts = ["Python and kiln work, 2015 - 2018 at a company", "", None, "summary: led a team, bachelor of arts"]
    docs = [(n, text, "en", "web", len(text or "")) for n, text in enumerate(texts)]
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(0, "kiln work and glazing"), (1, "python services")], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_elements(spark):
    rows = spark.createDataFrame([(1, ["a", None]), (2, []), (3, None)], "n int, list array<string>")
    assert [tuple(r) for r in elements(rows, "list", ["n"], ["at", "x"]).orderBy("at").collect()] == [(1, 0, "a"), (1, 1, None)]


@pytest.mark.parametrize("name", ["term_freq", "weighted_terms", "target_top_terms", "suggestions"])
def test_an_array_is_computed_once(spark, tables, name):
    """Spark's own test of the size of the array would compute it before the documents are dealt out."""
    assert "Filter ((size(" not in optimized(queries()[name](spark, tables))


@pytest.mark.parametrize("name", ["catalog_match", "catalog_keywords_split"])
def test_the_catalog_side_reads_written_documents(spark, tables, name):
    df = queries()[name](spark, tables)
    assert df.count() and not any("documents.parquet" in f for f in df.inputFiles())


@pytest.mark.parametrize("name", ["crit_summary", "crit_experience"])
def test_one_criterion_computes_no_other(spark, tables, name):
    df = queries()[name](spark, tables)
    assert df.count() == 4 and "plain_similarity" not in optimized(df)


@pytest.mark.parametrize("name", ["criteria", "score_default", "scan_scores", "score_role", "criteria_reasons", "crit_extremes"])
def test_scores_build_no_plain_vector(spark, tables, name):
    assert "plain_vector" not in optimized(queries()[name](spark, tables))


def test_a_day_of_reports_is_few_files(spark, tmp_path):
    start = datetime(2025, 1, 1)
    data = [(n, 1, f"f{n}.txt", start + timedelta(days=n % 3), 5, None, None, None, None) for n in range(60)]
    path = str(tmp_path / "reports")
    R.append_reports(spark.createDataFrame(data, STORED_REPORTS_DDL).repartition(20), path)
    stored = spark.read.parquet(path)
    assert stored.count() == 60 and len(stored.inputFiles()) <= 8


def test_many_branches_are_divided():
    values = [a + b for a in "abcdefghij-^" for b in ("x", "yy", " z")]
    pattern = prefix_tree(values)
    assert pattern.count("(?=[") >= 12 // MOST_BRANCHES


def test_divided_branches_find_the_same(spark):
    values = [a + b for a in "abcdefghij-^]" for b in ("x", "yy", " z", "")]
    text = "ax byy ^ z ]] --x ee zz"
    hits = spark.range(1).select(F.regexp_extract_all(F.lit(text), F.lit(f"(?=({prefix_tree(values)}))"), F.lit(1))).first()[0]
    longest = [max((v for v in values if text.startswith(v, at)), key=len, default=None) for at in range(len(text))]
    assert hits == [v for v in longest if v]


@pytest.mark.parametrize("name", ["score_role", "score_default", "criteria", "crit_experience"])
def test_scores_do_not_compute_the_lists_of_the_profile(spark, tables, name):
    """Only skills and years of the profile are read; its struct used to bring verbs, education and words along."""
    plan = optimized(queries()[name](spark, tables))
    assert "shipped" not in plan and "participated" not in plan and "word_count" not in plan


def test_skills_score_at_five(spark):
    """Five skills are the full score, and listed ones count on top of fewer."""
    rows = [("python sql excel tableau git", 10), ("python", None), (None, None)]
    df = spark.createDataFrame([(text,) for text, _ in rows], "t string")
    p = F.struct(F.split("t", " ").alias("skills"))
    score = C.skills_score(F.col("t"), p)
    plain = F.least((F.size(p["skills"]) + F.size(F.array_except(contained(F.col("t"), DEFAULT.listed_skills), p["skills"]))) * 2, F.lit(10))
    found = [tuple(r) for r in df.select(score, plain).collect()]
    assert found[0][0] == 10 and all(one == two for one, two in found)


def test_words_of_score_and_reason_are_looked_for_once(spark, tables):
    """`roadmap` is one of the general keywords and no skill; the score and its reason used to look for it each."""
    assert optimized(queries()["criteria_reasons"](spark, tables)).count("stakeholders,roadmap,testing") == 1


def test_plain_norm_from_the_weighted_one(spark):
    many = [f"t{n}" for n in range(MOST_LOOKUPS + 5)]
    rows = [(["a", "b", "a"], ["a", "c", "a", "b"]), (["a", "a"], []), ([], ["b", "b"]), ([], []), (["t1", "t1", "x"], many), (None, None)]
    df = spark.createDataFrame([(bag, None if bag is None else bag + more) for bag, more in rows], "bag array<string>, longer array<string>")
    found = df.select(begun_squared_norm(F.col("bag"), F.col("longer"), bag_squared_norm(F.col("longer"))), bag_squared_norm(F.col("bag"))).collect()
    assert [tuple(r) for r in found] == [(n, n) for n in (5, 4, 0, 0, 5, None)]
