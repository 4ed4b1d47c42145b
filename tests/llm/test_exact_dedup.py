import hashlib

import pytest
from pyspark.sql import functions as F

from rolegauge.llm.exact_dedup import exact_groups, without_copies

SCHEMA = "doc_id bigint, text string"
TABLE = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, pick):
    """doc_id -> expected columns, by comparing all texts."""
    bodies = [(i, (t or "").translate(TABLE)) for i, t in rows]
    out = []
    for i, body in bodies:
        same = [j for j, other in bodies if other == body]
        ids = [j for j in same if j is not None]
        keep = pick(ids) if ids else None
        out.append((i, keep, len(same), i == keep, hashlib.sha256(body.encode()).hexdigest()))
    return sorted(out, key=repr)


ROWS = [
    (5, "Same Text"), (3, "same text"), (9, "SAME TEXT"), (4, "same  text"), (1, None), (2, ""), (7, "ÄRGER"), (8, "ärger"), (6, "Ärger"),
    (11, "x" * 300_000), (10, "X" * 300_000), (12, "twice"), (12, "twice"), (None, "no id"), (None, "no id"), (None, "twice"), (13, " "),
]


@pytest.mark.parametrize(("keep", "pick"), [("largest", max), ("smallest", min)])
def test_groups_equal_plain_comparison(spark, keep, pick):
    docs = spark.createDataFrame(ROWS, SCHEMA).repartition(5)
    found = sorted(map(tuple, exact_groups(docs, keep=keep).collect()), key=repr)
    assert found == plain(ROWS, pick)


def test_collisions_of_the_hash_are_told_apart(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    weak = lambda body: F.unhex(F.md5(F.substring(body, 1, 1)))
    found = sorted(map(tuple, exact_groups(docs, keep="largest", hashed=weak).collect()), key=repr)
    assert found == plain(ROWS, max)


def test_empty_table_and_clashing_columns(spark):
    assert exact_groups(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = spark.createDataFrame([(1, "a", "h", 7, True), (2, "A", "h", 8, None)], "doc_id bigint, text string, hash string, n int, kept boolean")
    assert sorted((r.doc_id, r.kept) for r in exact_groups(rows).collect()) == [(1, True), (2, False)]
    left = without_copies(rows)
    assert left.columns == rows.columns and left.collect() == [rows.first()]


def test_without_copies_leaves_one_row_of_each_text(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    left = without_copies(docs, keep="largest").collect()
    bodies = [(r.text or "").translate(TABLE) for r in left]
    assert len(bodies) == len(set(bodies)) == len({(t or "").translate(TABLE) for _, t in ROWS})
    assert {r.doc_id for r in left} == {9, 4, 2, 7, 8, 11, 12, None, 13}


def test_hot_group_is_combined_before_the_shuffle(spark):
    docs = spark.range(0, 20_000, 1, 8).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("text"))
    found = exact_groups(docs, keep="largest")
    assert found.where("not kept").count() == 6666
    assert {r.keep_id for r in found.where("group_size > 1").select("keep_id").distinct().collect()} == {19_998}
