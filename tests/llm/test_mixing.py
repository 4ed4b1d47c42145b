"""Raking against numpy, expected shares, sampling, and edge cases; the query's SQL is compared by the driver's check."""

import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from rolegauge.llm import mixing as M
from rolegauge.llm import mixing_sql

SCHEMA = "doc_id bigint, text string, lang string, source string, n_tokens string"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    out = [(i, "w " * rng.choice([5, 60, 150, 1200]) + rng.choice(["", "!!", "###"]), rng.choice(["en", "en", "en", "de", None]), rng.choice(["hot"] * 8 + ["a", "b", None]), "x") for i in range(500)]
    return out + [(1000, None, "en", "a", "x"), (1001, "", "xx", "empty", "x"), (None, "a b", "en", "a", "x"), (3, out[3][1], "en", "hot", "x")]


def test_statement_agrees(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    got = {str(tuple(r)) for r in M.mixture_weights(df).collect()}
    table = df.toPandas()
    db = duckdb.connect()
    db.register("frame", table)
    db.execute("CREATE VIEW documents AS SELECT CAST(doc_id AS BIGINT) AS doc_id, text, lang, source FROM frame")
    names = "doc_id, topic, n_tokens, cell_weight, probability, sampled"
    want = {str(r) for r in db.execute(f"SELECT {names} FROM ({mixing_sql.statement()})").fetchall()}
    assert got == want
    assert mixing_sql.POWERS == M.POWERS and mixing_sql.SWEEPS == M.SWEEPS


def test_margins_are_met(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    cells = M.cell_table(M.described(df))
    targets = M.power_targets(cells)
    fitted = M.rake(cells, targets, 25).toPandas()
    for margin, power in M.POWERS.items():
        want = fitted.groupby(margin).tokens.sum() ** power
        want = want / want.sum() * fitted.tokens.sum()
        assert np.allclose(fitted.groupby(margin).weight.sum(), want, rtol=1e-3, atol=1e-6)
    out = M.mixed(df).select("__tokens", "__probability", "__lang", "__drawn").toPandas()
    assert out["__probability"].max() == pytest.approx(1) and out["__probability"].min() >= 0
    drawn = out[out["__drawn"]]["__tokens"].sum()
    assert drawn == pytest.approx((out["__tokens"] * out["__probability"]).sum(), rel=0.25)


def test_own_targets_and_topic(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    target = lambda m, pairs: spark.createDataFrame(pairs, f"{m} string, share double")
    targets = {"source": target("source", [("hot", 1.0), ("a", 1.0), ("absent", 5.0)]), "lang": target("lang", [("en", 3.0), ("de", 1.0)])}
    out = M.mixed(df, F.lit("all"), targets).groupBy("__source").agg(F.sum(F.col("__tokens") * F.col("__probability")).alias("t")).toPandas().set_index("__source").t
    assert out["hot"] == pytest.approx(out["a"], rel=0.02) and out["b"] == 0 and out["empty"] == 0


def test_sample_keeps_columns(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    out = M.sample_mixture(df)
    assert out.columns == df.columns and 0 < out.count() < df.count()
    assert M.sample_mixture(df.where("false")).count() == 0 and M.mixture_weights(df.where("doc_id = 1001")).first().sampled is False


def test_a_small_cell_does_not_hold_the_others_down(spark):
    rng = random.Random(4)
    rows = [(i, "w " * rng.choice([50, 200]), rng.choice(["en", "en", "de"]), rng.choice("aab"), "x") for i in range(4000)]

    def kept(more, budget=None):
        out = M.mixed(spark.createDataFrame(rows + more, SCHEMA), budget=budget)
        return out.agg(F.sum(F.col("__tokens") * F.col("__probability")) / F.sum("__tokens"), F.max(F.when(F.col("__lang") == "zz", F.col("__probability")))).first()

    plain, small = kept([])[0], kept([(9000, "w " * 60, "zz", "a", "x")])
    assert plain > 0.5 and small[0] == pytest.approx(plain, rel=0.02) and small[1] == pytest.approx(1, rel=0.02)
    assert kept([], 0.3)[0] == pytest.approx(0.3, rel=0.02)


def test_the_query_shares_the_calibration(spark):
    """One tiny cell leaves the rate of all others as it is, in the registered query too."""
    rng = random.Random(4)
    rows = [(i, "w " * rng.choice([50, 200]), rng.choice(["en", "en", "de"]), rng.choice("aab"), "x") for i in range(2000)]

    def rates(more):
        out = M.mixture_weights(spark.createDataFrame(rows + more, SCHEMA))
        return {r.doc_id: r.probability for r in out.collect()}

    plain, small = rates([]), rates([(9000, "w " * 60, "zz", "a", "x")])
    assert small.pop(9000) > 0.95 and all(small[i] == pytest.approx(p, rel=0.05) for i, p in plain.items())


def test_few_jobs(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    spark.sparkContext.setJobGroup("mixing", "")
    M.mixture_weights(df).collect()
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("mixing")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= 30


def test_columns_with_the_names_of_working_columns_stay(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"__tokens": F.lit("mine"), "__source": F.col("doc_id"), "__row": F.lit(3)})
    out = M.sample_mixture(df)
    assert out.columns == df.columns and {(r["__tokens"], r["__source"] == r.doc_id, r["__row"]) for r in out.where("doc_id is not null").collect()} == {("mine", True, 3)}


def test_cells_in_several_partitions_and_long_texts(spark, rows, monkeypatch):
    df = spark.createDataFrame([*rows, (2000, "w " * 300_000, "en", "hot", "x")], SCHEMA)
    one = {(r.doc_id, r.probability) for r in M.mixture_weights(df).collect()}
    monkeypatch.setattr(M, "CELLS_AT_ONCE", 5)
    assert {(r.doc_id, r.probability) for r in M.mixture_weights(df).collect()} == one
