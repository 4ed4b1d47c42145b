import random
import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from rolegauge.llm import phrases
from rolegauge.llm.phrases import mine_phrases
from rolegauge.llm.phrases_sql import statement

SCHEMA = "doc_id bigint, text string, lang string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, top, least):
    """Everything counted, in Python."""
    count, total = {}, Counter()
    for _, text, lang in rows:
        own = count.setdefault(lang or "und", Counter())
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            total[lang or "und"] += len(words)
            own.update(tuple(words[i : i + n]) for n in range(1, 5) for i in range(len(words) - n + 1))
    out = []
    for lang, f in count.items():
        chosen = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = lambda p, q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
        alive = []
        for p, a in chosen.items():
            if any(len(q) > len(p) and 100 * b >= 80 * a and inside(p, q) for q, b in chosen.items()):
                continue
            score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            alive.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, name, l, r) in enumerate(sorted(alive)[:top], 1):
            out.append((lang, rank, name.decode(), -a, l, r, total[lang], -score))
    return sorted(out)


def corpus(seed, n, vocabulary):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)] + ["É", "é", "Zz", "a-b", "x y", "中"]
    stock = [" ".join(rng.choices(words, k=rng.randint(2, 6))) for _ in range(12)]
    rows = []
    for i in range(n):
        parts = [rng.choice(stock) if rng.random() < 0.4 else rng.choice(words) for _ in range(rng.randint(0, 40))]
        text = "".join(p + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n"]) for p in parts)
        rows.append((i, text.upper() if rng.random() < 0.2 else text, rng.choice(["en", "en", "de", None, "und"])))
    return rows


@pytest.mark.parametrize(("seed", "n", "vocabulary", "top", "least"), [(1, 150, 8, 5, 4), (2, 300, 30, 12, 3), (3, 60, 3, 2000, 30), (4, 200, 15, 1, 2)])
def test_equals_counting_everything(spark, seed, n, vocabulary, top, least):
    rows = corpus(seed, n, vocabulary)
    found = mine_phrases(spark.createDataFrame(rows, SCHEMA).repartition(5), top, least)
    assert sorted(map(tuple, found.collect())) == plain(rows, top, least)


def test_growth_leaves_out_hopeless_phrases(spark, monkeypatch):
    """The frontier of a corpus with many weak pairs is small, and the result is the same."""
    rng = random.Random(9)
    rows = [(i, " ".join(f"v{min(int(rng.expovariate(0.15)), 40)}" for _ in range(60)) + ". in spite of it. as well as", "en") for i in range(300)]
    seen = []
    real = phrases.counted

    def spy(documents, frequent=None, frontier=None):
        out = real(documents, frequent, frontier)
        if frontier and frontier.get(1, 1) is not None:
            seen.append(out.count())
        return out

    monkeypatch.setattr(phrases, "counted", spy)
    found = mine_phrases(spark.createDataFrame(rows, SCHEMA), 3, 10)
    assert sorted(map(tuple, found.collect())) == plain(rows, 3, 10)
    triples = len({(tuple(w[i : i + 3])) for _, t, _ in rows for p in t.split(". ") for w in [p.split()] for i in range(len(w) - 2)})
    assert seen and seen[0] < 0.6 * triples


def test_full_filters_change_nothing(spark, monkeypatch):
    """With filters so small that nearly all phrases pass, more is counted and the result is the same."""
    monkeypatch.setattr(phrases, "FILTER_BITS", 1 << 15)
    rows = corpus(5, 150, 20)
    wide = lambda frame: phrases.np.full((1 << 15) // 8, 255, phrases.np.uint8)
    monkeypatch.setattr(phrases, "filter_bits", wide)
    monkeypatch.setattr(phrases, "places", lambda hashes: [phrases.np.zeros(len(hashes), phrases.np.int64)])
    assert sorted(map(tuple, mine_phrases(spark.createDataFrame(rows, SCHEMA), 6, 3).collect())) == plain(rows, 6, 3)


def test_nulls_empty_and_clashing_columns(spark):
    assert mine_phrases(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(1, None, "en"), (2, "", None), (3, ".,;", "fr"), (4, "one two one two", "en"), (4, "one two one two", "en")]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("phrase", F.lit(1)).withColumn("n", F.lit("x")).withColumn("a", F.lit(2))
    assert sorted(map(tuple, mine_phrases(docs, 10, 2).collect())) == plain(rows, 10, 2)


def test_a_very_long_text_is_read_whole(spark):
    rows = [(1, "alpha beta " * 400_000 + "gamma delta. " * 40, "en")]
    assert sorted(map(tuple, mine_phrases(spark.createDataFrame(rows, SCHEMA), 10, 30).collect())) == plain(rows, 10, 30)


def test_statement_gives_the_same(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
        wanted = db.execute(f"SELECT lang, rank, phrase, a, l, r, n, score FROM ({statement()})").fetchall()
    assert sorted(map(tuple, mine_phrases(docs).collect())) == sorted(wanted) and wanted
