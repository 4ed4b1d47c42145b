"""Links, classes and groups against a comparison of all pairs; the pruning bound; groups and hot blocks."""

import random

import numpy as np
import pytest

from rolegauge.llm import jaccard_join as J
from rolegauge.llm.components import components
from rolegauge.llm.shingles import words_of


def grams(text):
    words = words_of(text or "")
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)] if words else [])


def plain(rows):
    sets = [(i, grams(t)) for i, t, *_ in rows]
    classes = {}
    for i, s in sets:
        if s:
            classes.setdefault(s, []).append(i)
    links = {s: [o for o in classes if o != s and len(s & o) / len(s | o) >= 0.8] for s in classes}
    group, seen = {}, set()
    for s in classes:
        if s in seen:
            continue
        stack, part = [s], []
        while stack:
            x = stack.pop()
            if x not in seen:
                seen.add(x)
                part.append(x)
                stack += links[x]
        low = min(min(classes[x]) for x in part)
        group |= {x: low for x in part}
    return sorted(
        (i, min(classes[s]), len(classes[s]), len(links[s]), group[s]) if s else (i, i, 1, 0, i) for i, s in sets
    )


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(12)
    fresh = lambda n: [f"w{rng.randrange(3000)}" for _ in range(n)]
    out, i = [], 0
    for _ in range(40):
        base = fresh(rng.randrange(20, 200))
        for _ in range(rng.randrange(1, 6)):
            out.append((i, edited(rng, base, rng.randrange(4))))
            i += 1
    hot = fresh(140)
    for _ in range(90):
        out.append((i, edited(rng, hot, rng.randrange(3))))
        i += 1
    out += [(i + k, "Equal, text of a few words!") for k in range(30)]
    out += [(900, None), (901, ""), (902, "..."), (903, "two words"), (904, "Two words."), (5, out[5][1]), (905, " ".join(fresh(9000)))]
    rng.shuffle(out)
    return [(*r, "x") for r in out]


@pytest.mark.parametrize("block", [512, 16])
def test_against_all_pairs(spark, rows, monkeypatch, block):
    monkeypatch.setattr(J, "BLOCK", block)
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n_links string")
    assert sorted(map(tuple, J.jaccard_join(df).collect())) == plain(rows)


def test_one_of_each_group_stays(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n_links string")
    kept = J.keep_one_of_each_group(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({r[4] for r in plain(rows)})


def test_empty_and_null_ids(spark):
    schema = "doc_id bigint, text string"
    assert J.jaccard_join(spark.createDataFrame([], schema)).collect() == []
    df = spark.createDataFrame([(None, "one two three four five six"), (None, None), (3, "one two three four five six")], schema)
    assert sorted(map(str, map(tuple, J.jaccard_join(df).collect()))) == ["(3, 3, 2, 0, 3)", "(None, 3, 2, 0, 3)", "(None, None, 1, 0, None)"]
    assert J.keep_one_of_each_group(df).count() == 3


def test_rows_that_share_an_id_lose_no_text(spark):
    """Texts A and B under id 1, B under id 2 too, a near copy of A under 3: A and one B stay."""
    rng = random.Random(3)
    a, b = ([f"{x}{rng.randrange(10**6)}" for _ in range(60)] for x in "ab")
    near = " ".join([*a[:-1], "other"])
    rows = [(1, " ".join(a), 1), (1, " ".join(b), 2), (2, " ".join(b), 3), (3, near, 4), (1, " ".join(a), 5), (4, None, 6), (4, "", 7), (4, " ".join(b), 8), (None, " ".join(a), 9)]
    kept = J.keep_one_of_each_group(spark.createDataFrame(rows, "doc_id bigint, text string, digest int"))
    got = sorted((str(r.doc_id), r.text or "") for r in kept.collect())
    assert got == sorted([("1", " ".join(a)), ("1", " ".join(b)), ("4", ""), ("None", " ".join(a))])
    found = {(r.doc_id, r.class_id, r.group_id) for r in J.jaccard_join(spark.createDataFrame(rows, "doc_id bigint, text string, digest int")).collect()}
    assert (3, 3, 1) in found and (2, 1, 1) in found


def test_pruning_bound():
    least = J.least_equal(0.8, 1e-6, 16, 96)
    assert least == sorted(least) and 0 < least[0] < 16 * 0.8
    grid = np.linspace(0, 1, 200_001)
    for n, m in zip(range(16, 97, 16), least, strict=True):
        density = grid**m * (1 - grid) ** (n - m)
        assert density[grid >= 0.8].sum() / density.sum() >= 1e-6
        density = grid ** (m - 1) * (1 - grid) ** (n - m + 1)
        assert density[grid >= 0.8].sum() / density.sum() < 1.01e-6


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 200)] + [(300, x) for x in range(301, 400)] + [(rng.randrange(500, 900), rng.randrange(500, 900)) for _ in range(300)]
    edges += [(7, 7), (None, 3), (1, 0)]
    root = list(range(1000))
    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in edges:
        if a is not None:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    nodes = {x for e in edges if None not in e and e[0] != e[1] for x in e}
    got = components(spark.createDataFrame(edges, "a bigint, b bigint"), "a", "b").collect()
    assert sorted(map(tuple, got)) == sorted((x, find(x)) for x in nodes)
