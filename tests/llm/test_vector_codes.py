import hashlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from rolegauge.llm.gnat import Gnat
from rolegauge.llm.vector_codes import fit_codebooks, restored, usable_rows, vector_codes
from rolegauge.llm.vector_codes_sql import statement

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def plain(rows, parts=16, entries=64, rounds=2):
    """The same by comparing each part with every entry, in Python integers."""
    kept = [(i, [int(np.floor(np.float64(np.float32(x)) * 256)) for x in v], lab) for i, v, lab in rows if v and all(x is not None and np.isfinite(x) for x in v)]
    width = len(kept[0][1]) // parts
    cut = lambda v: [v[p * width : (p + 1) * width] for p in range(parts)]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[cut(v)[p] for _, v, _ in first] for p in range(parts)]
    gap = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    near = lambda p, y: min((gap(y, e), i) for i, e in enumerate(books[p]))
    for _ in range(rounds):
        held = {}
        for _, v, _ in kept:
            for p, y in enumerate(cut(v)):
                held.setdefault((p, near(p, y)[1]), []).append(y)
        for (p, e), ys in held.items():
            books[p][e] = [sum(c) // len(ys) for c in zip(*ys, strict=True)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    found = [(i, [near(p, y) for p, y in enumerate(cut(v))], lab) for i, v, lab in kept]
    total = {}
    for _, f, lab in found:
        total[lab] = total.get(lab, 0) + sum(d for d, _ in f)
    return sorted(((i, "".join(f"{e:02x}" for _, e in f), min((1 << 63) - 1, sum(d for d, _ in f)), min((1 << 63) - 1, total[lab]), digest) for i, f, lab in found), key=repr)


def rows_of(seed, n, width, spread=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(9, width))
    return [(int(i), [float(np.float32(x)) for x in centres[i % 9] * spread + rng.normal(size=width) * 0.3], [None, 3, 5][i % 3]) for i in rng.permutation(n)]


@pytest.mark.parametrize("dims", [1, 2, 4, 9])
@pytest.mark.parametrize("steps", [3, 40, 100_000])
def test_tree_equals_comparing_all(dims, steps):
    rng = np.random.default_rng(dims * steps)
    entries, queries = rng.integers(-steps, steps, (64, dims)), rng.integers(-steps, steps, (3000, dims))
    gaps = ((queries[:, None].astype(object) - entries[None].astype(object)) ** 2).sum(axis=2)
    tree = Gnat(entries)
    index, best = tree.nearest(queries)
    assert (best == gaps.min(axis=1)).all()
    assert (index == [row.tolist().index(min(row)) for row in gaps]).all()


def test_tree_leaves_out_subtrees():
    rng = np.random.default_rng(1)
    entries, queries = rng.integers(-1000, 1000, (64, 2)), rng.integers(-1000, 1000, (2000, 2))
    tree = Gnat(entries)
    tree.nearest(queries)
    assert tree.computed < 0.5 * 64 * 2000


def test_equal_entries_and_huge_numbers():
    entries = np.array([[5, 5], [1, 1], [5, 5], [1, 1]] * 8)
    assert Gnat(entries).nearest(np.array([[5, 5], [2, 1], [3, 3]]))[0].tolist() == [0, 1, 0]
    huge = np.array([[10**40], [-(10**40)], [7]], object)
    index, best = Gnat(huge).nearest(np.array([[10**40 + 3], [0]], object))
    assert index.tolist() == [0, 2] and best.tolist() == [9, 49]


@pytest.mark.parametrize(("n", "width"), [(400, 32), (40, 16), (1, 64)])
def test_codes_equal_plain_assignment(spark, n, width):
    rows = rows_of(n, n, width)
    found = vector_codes(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert sorted(map(tuple, found.collect()), key=repr) == plain(rows)


def test_odd_rows(spark):
    rows = rows_of(5, 90, 16)
    bad = [(1000, None, 1), (1001, [float("nan")] * 16, 1), (1002, [1.0] * 15 + [None], 1), (-5, [float("inf")] + [0.0] * 15, 1), (1003, [], 3)]
    again = [rows[0], rows[0], (None, rows[1][1], None), (rows[2][0], rows[3][1], 5), (2000, [3e38] * 16, 5)]
    short = [(3000, [1.0] * 32, 3)]
    found = vector_codes(spark.createDataFrame(rows + bad + again + short, SCHEMA).repartition(4))
    assert sorted(map(tuple, found.collect()), key=repr) == plain(rows + bad + again)


def test_empty_tables_and_clashing_columns(spark):
    empty = vector_codes(spark.createDataFrame([], SCHEMA))
    assert empty.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"] and empty.count() == 0
    assert vector_codes(spark.createDataFrame([(1, None, 2)], SCHEMA)).count() == 0
    assert vector_codes(spark.createDataFrame([(1, [1.0] * 17, 2)], SCHEMA)).count() == 0
    rows = rows_of(6, 70, 16)
    named = spark.createDataFrame(rows, SCHEMA).withColumn("id", F.lit("x")).withColumn("vector", F.lit(1)).withColumn("code", F.lit(2))
    assert sorted(map(tuple, vector_codes(named).collect()), key=repr) == plain(rows)


def test_restored_vectors_have_the_stated_error(spark):
    table = spark.createDataFrame(rows_of(7, 200, 32), SCHEMA)
    books = fit_codebooks(usable_rows(table, "embedding", "vec_id", "label", 16))
    codes = vector_codes(table)
    both = restored(codes, books).join(codes, "vec_id").join(table, "vec_id").collect()
    for row in both:
        whole = np.floor(np.array(row.embedding, np.float64) * 256)
        assert int(((whole - np.array(row.vector) * 256) ** 2).sum()) == row.error


def test_statement_gives_the_same(spark, folder):
    table = spark.read.parquet(f"{folder}/embeddings.parquet")
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
        wanted = db.execute(f"SELECT vec_id, code, error, label_error, codebooks_sha256 FROM ({statement()})").fetchall()
    assert sorted(map(tuple, vector_codes(table).collect())) == sorted(wanted)
