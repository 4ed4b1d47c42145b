"""Held-out accuracy on the smallest tables, and edge cases."""

from rolegauge.llm.language import identify_languages

SCHEMA = "doc_id bigint, text string, lang string, score string"


def test_held_out_accuracy(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = {r.doc_id: r for r in identify_languages(docs).collect()}
    rows = docs.collect()
    assert len(found) == len(rows)
    asked = [(found[r.doc_id].lang_pred, r.lang) for r in rows if found[r.doc_id].held_out and r.lang]
    assert len(asked) > 30 and sum(a == b for a, b in asked) / len(asked) >= 0.9
    assert all(0 <= r.score <= 1 for r in found.values())


def test_edges(spark):
    en, tr = "the house and the garden of this", "bir ev ve bahçe için çok güzel"
    rows = [(i, [en, tr][i % 2] * 3, ["en", "tr"][i % 2]) for i in range(40)]
    rows += [(100, None, "en"), (101, "", None), (102, "12 ² !?", "en"), (103, en * 20_000, None), (None, tr, None), (1, tr, None)]
    found = identify_languages(spark.createDataFrame([(*r, "k") for r in rows], SCHEMA)).collect()
    assert len(found) == len(rows)
    by = {r.doc_id: (r.lang_pred, r.score) for r in found}
    assert [by[i] for i in (100, 101, 102)] == [("und", 0.0)] * 3
    assert by[103][0] == "en" and by[None][0] == "tr"
    none = identify_languages(spark.createDataFrame([(1, en, None, "k")], SCHEMA)).collect()
    assert [r.lang_pred for r in none] == ["und"]
    one = identify_languages(spark.createDataFrame([(i, en, "en", "k") for i in range(8)], SCHEMA)).collect()
    assert {r.lang_pred for r in one} == {"en"}
    assert identify_languages(spark.createDataFrame([], SCHEMA)).collect() == []
