"""Leaks against a plain comparison of all pairs, by both ways of the lookup."""

import random

import pytest

from rolegauge.llm.decontaminate import find_leaks, without_leaks
from rolegauge.llm.shingles import words_of


def grams(text):
    words = words_of(text or "")
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def plain(docs, items, threshold=0.8):
    found = {}
    for d, text, *_ in docs:
        for i, item in items:
            asked = grams(item)
            if d is not None and i is not None and asked and len(asked & grams(text)) / len(asked) >= threshold:
                share = len(asked & grams(text)) / len(asked)
                found[d, i] = max(found.get((d, i), 0), share)
    return found


@pytest.fixture(scope="module")
def data():
    rng = random.Random(8)
    text = lambda n: " ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") + rng.choice("aeiou") for _ in range(n))
    items = [(i, text(rng.randrange(3, 60))) for i in range(60)] + [(60, None), (61, ""), (None, text(20)), (3, "another text for item three of the table")]
    docs = []
    for d in range(150):
        body = text(rng.randrange(1, 400)).split()
        if d % 2:
            part = rng.choice(items)[1] or ""
            words = part.split()
            for _ in range(rng.randrange(3)):
                if words:
                    words[rng.randrange(len(words))] = "changed"
            place = rng.randrange(len(body))
            body[place:place] = words
        docs.append((d, " ".join(body).upper() if d % 3 == 0 else ", ".join(body), "k"))
    docs += [(500, None, "k"), (501, "", "k"), (None, items[10][1], "k"), (1, docs[1][1], "k"), (502, text(30_000) + " " + items[5][1], "k")]
    docs += [(600 + i, items[7][1], "k") for i in range(40)]
    return docs, items


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_all_pairs(spark, data, limit):
    docs, items = data
    df = spark.createDataFrame(docs, "doc_id bigint, text string, item_id string")
    found = find_leaks(df, spark.createDataFrame(items, "item_id bigint, text string"), broadcast_hashes=limit).collect()
    assert {(r.doc_id, r.item_id): r.containment for r in found} == plain(docs, items) and len(found) == len(plain(docs, items))
    assert len(found) > 60


def test_documents_kept(spark, data):
    docs, items = data
    df = spark.createDataFrame(docs, "doc_id bigint, text string, item_id string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    kept = without_leaks(df, bench)
    leaking = {d for d, _ in plain(docs, items)}
    assert kept.columns == df.columns and sorted(map(str, kept.collect())) == sorted(str(r) for r in df.collect() if r.doc_id not in leaking)
    assert without_leaks(df, bench.where("false")).count() == len(docs) and find_leaks(df.where("false"), bench).count() == 0


def test_repeated_item_with_unusable_texts(spark):
    text = "one two three four five six seven"
    items = [(1, text), (1, None), (1, ""), (1, "only four words here"), (2, None)]
    df = spark.createDataFrame([(10, f"before {text} after"), (11, "nothing of it at all")], "doc_id bigint, text string")
    found = find_leaks(df, spark.createDataFrame(items, "item_id bigint, text string")).collect()
    assert list(map(tuple, found)) == [(10, 1, 3, 3, 1.0)]
