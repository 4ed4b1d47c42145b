"""Slopes against differences, held-out detection, and edge cases."""

import random

import numpy as np

from rolegauge.llm.gru import Words, forward, new_params, slopes_of
from rolegauge.llm.toxicity import WINDOW, Texts, fit, score_toxicity


def test_slopes():
    rng = np.random.default_rng(2)
    words = Words(["", "one", "two", "three", "longer", "é"])
    params = {k: v.astype(np.float64) for k, v in new_params(5).items()}
    windows, mask = rng.integers(0, 6, (4, 5)), np.ones((4, 5), np.float32)
    mask[1, 3:] = 0
    label, share = np.array([1.0, 0, 1, 0]), np.full(4, 0.25)
    _, slopes = slopes_of(params, words, windows, mask, label, share)
    for name, slope in slopes.items():
        at = np.unravel_index(np.argmax(np.abs(slope)), slope.shape)
        step, values = 1e-3, []
        for sign in (1, -1):
            params[name][at] += sign * step
            values.append(slopes_of(params, words, windows, mask, label, share)[0])
            params[name][at] -= sign * step
        assert abs((values[0] - values[1]) / (2 * step) - slope[at]) < 2e-3 * max(1, abs(slope[at])), name


def test_padding_does_not_matter():
    params, words = new_params(1), Words(["", "a", "b"])
    inputs = words.inputs(params)
    short = forward(params, inputs, np.array([[1, 2]]), np.ones((1, 2), np.float32))
    padded = forward(params, inputs, np.array([[1, 2, 0, 0]]), np.array([[1, 1, 0, 0]], np.float32))
    assert np.allclose(short, padded, atol=1e-5)


def test_windows_cover_every_word():
    for n in range(0, 200):
        found = Texts([" ".join(f"w{i}" for i in range(n))])
        assert len(np.unique(found.windows[found.mask > 0])) == n


def samples(rng, n, offset=0):
    plain = [f"{a}{b}" for a in "ba de fo gi ku la mo ne".split() for b in "ran tel sip wor".split()]
    rows = []
    for i in range(n):
        words = [rng.choice(plain) for _ in range(rng.randrange(5, 150))]
        bad = i % 3 == 0
        if bad:
            for _ in range(rng.randrange(1, 4)):
                words.insert(rng.randrange(len(words) + 1), rng.choice(["vile", "scumbag", "nastyx" + rng.choice("abcdefg")]))
        rows.append((offset + i, " ".join(words), int(bad)))
    return rows


def test_learns(spark):
    rng = random.Random(3)
    rows = samples(rng, 900)
    special = [(5000, None, None), (5001, "", None), (5002, "...", None), (None, "vile", None), (5003, "ran " * 40_000 + "vile scumbag", None), (0, rows[0][1], 1)]
    docs = spark.createDataFrame([(i, t, "k") for i, t, _ in rows + special], "doc_id bigint, text string, score string")
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows] + [(None, 1, 1), (3, 1, None)], "doc_id bigint, quality int, toxic int")
    found = score_toxicity(docs, labels).collect()
    assert len(found) == len(rows) + len(special)
    by = {r.doc_id: r for r in found}
    asked = [(by[i].predicted, y) for i, _, y in rows if by[i].held_out]
    assert len(asked) > 150 and np.mean([p == y for p, y in asked]) > 0.97
    assert [by[i].score for i in (5000, 5001, 5002)] == [0.0] * 3 and by[5003].predicted == 1
    assert score_toxicity(docs.where("false"), labels).collect() == []
    assert {r.score for r in score_toxicity(docs, labels.where("false")).collect()} == {0.0}


def test_one_class():
    model = fit(["a b", "c"], np.array([0.0, 0.0]))
    assert model.scores(["a", ""]).tolist() == [0.0, 0.0] and WINDOW > 0
