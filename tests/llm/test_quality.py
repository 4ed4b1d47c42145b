"""Document statistics against a plain count, the trees' constraints, and the rules on edge cases."""

import random
import re

import numpy as np

from rolegauge.llm.boosted_trees import fit
from rolegauge.llm.quality import keep_good, quality_rules
from rolegauge.llm.text_stats import statistics


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, lines = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            lines += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + s for i, w in enumerate(windows) if windows.count(w) > 1 for s in range(3)}
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), lines, len(covered)]


def test_statistics():
    rng = random.Random(2)
    for _ in range(400):
        text = "".join(rng.choice(["a", "b", "é", " ", " ", "\n", "\t", "#", " ", "\x1c", "\r"]) for _ in range(rng.randrange(60)))
        base, features = statistics(text)
        assert base == plain(text), repr(text)
        assert np.isfinite(features).all()


def test_constraints_and_fit():
    rng = np.random.default_rng(1)
    rows = rng.random((2000, 3))
    label = (rows[:, 0] + 0.4 * np.sin(9 * rows[:, 1]) + 0.1 * rng.standard_normal(2000) > 0.5).astype(float)
    model = fit(rows, label, np.array([1, 0, -1]))
    assert ((model.probability(rows) > 0.5) == label).mean() > 0.9
    for f, sign in ((0, 1), (2, -1)):
        grid = np.repeat(rng.random((50, 3)), 40, axis=0).reshape(50, 40, 3)
        grid[:, :, f] = np.linspace(0, 1, 40)
        steps = np.diff(model.raw(grid.reshape(-1, 3)).reshape(50, 40), axis=1)
        assert (sign * steps >= -1e-12).all()


def test_rules(spark):
    rng = random.Random(4)
    vocabulary = ["w%d" % i for i in range(400)]
    good = lambda: " ".join(rng.choice(vocabulary) for _ in range(120)) + "."
    bad = lambda: " ".join(rng.choice(vocabulary) + "###" for _ in range(120))
    rows = [(i, good() if i % 2 else bad()) for i in range(400)]
    special = [(1000, None), (1001, ""), (1002, "a b c " * 100), (1003, "x" * 200_000), (None, good()), (1, rows[1][1])]
    docs = spark.createDataFrame([(*r, "k") for r in rows + special], "doc_id bigint, text string, kept string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(300)] + [(None, 1, 0), (5, None, 0)], "doc_id bigint, quality int, toxic int")
    found = quality_rules(docs, labels).collect()
    assert len(found) == len(rows) + len(special)
    by = {r.doc_id: r for r in found}
    assert [by[i].base_failed for i in (1000, 1001, 1002, 1003)] == [True] * 4 and by[None].kept
    assert np.mean([by[i].kept == bool(i % 2) for i in range(300, 400)]) > 0.97
    kept = keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in found)
    nothing = labels.where("false")
    assert {r.doc_id for r in quality_rules(docs, nothing).collect() if not r.kept} == {1000, 1001, 1002, 1003}
    assert quality_rules(docs.where("false"), labels).collect() == []
