"""A bidirectional gated recurrent network with attention pooling, in numpy, over word and character inputs.

A word's input is the embedding of its hash next to the mean embedding of its hashed character triples and quadruples. Both directions
read a window of words; attention weighs their states; the weighted state gives one log-odds per window.
"""

from __future__ import annotations

import numpy as np

from rolegauge.llm.shingles import HASHES

BUCKETS, EMBED, HIDDEN = 1 << 14, 8, 8
MASK = np.uint64(BUCKETS - 1)
GRAM = np.uint32(0x9E3779B1)


class Words:
    """Distinct words as hashed inputs: the word's bucket, and buckets and owners of its character grams."""

    def __init__(self, words: list[str]):
        hashes = np.fromiter(map(HASHES.__getitem__, words), np.uint64, len(words))
        self.word = (hashes & MASK).astype(np.int64)
        joined = "\x02" + "\x03\x02".join(words) + "\x03"
        signs = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        owner = np.cumsum(signs == 2) - 1
        grams, owners = [], []
        total = signs * GRAM
        rolled = (total[:-1] ^ (total[:-1] >> np.uint32(15))) * np.uint32(31) + total[1:]
        for width in (3, 4):
            rolled = (rolled[:-1] ^ (rolled[:-1] >> np.uint32(13))) * np.uint32(31) + total[width - 1 :]
            inside = owner[: len(rolled)] == owner[width - 1 :]
            grams.append(((rolled[inside] * GRAM) >> np.uint32(18)).astype(np.int32))
            owners.append(owner[: len(rolled)][inside].astype(np.int32))
        self.grams, self.owners = np.concatenate(grams), np.concatenate(owners)
        self.count = np.maximum(np.bincount(self.owners, minlength=len(words)), 1).astype(np.float32)

    def mean_of_grams(self, values: np.ndarray) -> np.ndarray:
        """Mean of `values[gram]` over the grams of each word; `values` has one row per bucket."""
        size = len(self.word)
        sums = [np.bincount(self.owners, values[self.grams, d], size) for d in range(values.shape[1])]
        return (np.stack(sums, axis=1) / self.count[:, None]).astype(np.float32)

    def inputs(self, params: dict) -> np.ndarray:
        return np.hstack([params["word"][self.word], self.mean_of_grams(params["gram"])])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def new_params(seed: int = 11) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    draw = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
    params = {"word": draw(BUCKETS, EMBED, scale=0.02), "gram": draw(BUCKETS, EMBED, scale=0.02)}
    for side in ("fore", "back"):
        params[f"{side}.x"] = draw(2 * EMBED, 3 * HIDDEN, scale=0.3)
        params[f"{side}.h"] = draw(HIDDEN, 3 * HIDDEN, scale=0.3)
        params[f"{side}.b"] = np.zeros(3 * HIDDEN, np.float32)
    params |= {"attend": draw(2 * HIDDEN, HIDDEN, scale=0.3), "attend.b": np.zeros(HIDDEN, np.float32), "attend.v": draw(HIDDEN, scale=0.3)}
    return params | {"out": draw(2 * HIDDEN, scale=0.3), "out.b": np.zeros(1, np.float32)}


def gru(projected: np.ndarray, windows: np.ndarray, mask: np.ndarray, recurrent: np.ndarray, keep: list | None) -> np.ndarray:
    """States (steps, windows, hidden). `projected` holds the input part of the gates for each distinct word; `windows` (windows, steps)
    names the words; masked steps keep the state. With `keep`, what the backward pass needs is added to it."""
    count, steps = windows.shape
    state, states = np.zeros((count, HIDDEN), np.float32), np.empty((steps, count, HIDDEN), np.float32)
    for t in range(steps):
        x, h = projected[windows[:, t]], state @ recurrent
        gates = sigmoid(x[:, : 2 * HIDDEN] + h[:, : 2 * HIDDEN])
        reset, update = gates[:, :HIDDEN], gates[:, HIDDEN:]
        fresh = np.tanh(x[:, 2 * HIDDEN :] + reset * h[:, 2 * HIDDEN :])
        on = mask[:, t, None]
        after = state + on * (1 - update) * (fresh - state)
        if keep is not None:
            keep.append((state, gates, fresh, h[:, 2 * HIDDEN :], on))
        states[t] = state = after
    return states


def gru_backward(slopes: np.ndarray, keep: list, recurrent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slopes of the gates' input part (steps, windows, 3 hidden) and of the recurrent weights."""
    steps, count, _ = slopes.shape
    of_x, of_w = np.empty((steps, count, 3 * HIDDEN), np.float32), np.zeros_like(recurrent)
    carried = np.zeros((count, HIDDEN), np.float32)
    for t in range(steps - 1, -1, -1):
        state, gates, fresh, inner, on = keep[t]
        reset, update = gates[:, :HIDDEN], gates[:, HIDDEN:]
        slope = slopes[t] + carried
        moved = on * slope
        of_fresh = moved * (1 - update) * (1 - fresh**2)
        of_update = -moved * (fresh - state) * update * (1 - update)
        of_reset = of_fresh * inner * reset * (1 - reset)
        of_x[t] = np.hstack([of_reset, of_update, of_fresh])
        of_h = np.hstack([of_reset, of_update, of_fresh * reset])
        of_w += state.T @ of_h
        carried = slope - moved * (1 - update) + of_h @ recurrent.T
    return of_x, of_w


def forward(params: dict, inputs: np.ndarray, windows: np.ndarray, mask: np.ndarray, keep: dict | None = None) -> np.ndarray:
    """Log-odds of each window. `inputs` has a row per distinct word."""
    states = []
    for side, turn in (("fore", slice(None)), ("back", slice(None, None, -1))):
        projected = inputs @ params[f"{side}.x"] + params[f"{side}.b"]
        tape = [] if keep is not None else None
        states.append(gru(projected, windows[:, turn], mask[:, turn], params[f"{side}.h"], tape)[turn])
        if keep is not None:
            keep[side] = tape
    both = np.concatenate(states, axis=2)
    hidden = np.tanh(both @ params["attend"] + params["attend.b"])
    weight = np.where(mask.T > 0, hidden @ params["attend.v"], -1e9)
    weight = np.exp(weight - weight.max(axis=0))
    weight /= weight.sum(axis=0)
    pooled = (weight[:, :, None] * both).sum(axis=0)
    if keep is not None:
        keep |= {"both": both, "hidden": hidden, "weight": weight, "pooled": pooled}
    return pooled @ params["out"] + params["out.b"][0]


def slopes_of(params: dict, words: Words, windows: np.ndarray, mask: np.ndarray, label: np.ndarray, share: np.ndarray) -> tuple[float, dict]:
    """Logistic loss of the windows, weighted by `share`, and its slopes."""
    inputs, keep = words.inputs(params), {}
    odds = forward(params, inputs, windows, mask, keep)
    p = sigmoid(odds)
    loss = -float((share * np.where(label > 0, np.log(p + 1e-9), np.log(1 - p + 1e-9))).sum())
    of_odds = (share * (p - label)).astype(np.float32)
    found = {"out": keep["pooled"].T @ of_odds, "out.b": of_odds.sum(keepdims=True)}
    of_pooled = of_odds[:, None] * params["out"]
    both, hidden, weight = keep["both"], keep["hidden"], keep["weight"]
    of_weight = (both * of_pooled).sum(axis=2)
    of_both = weight[:, :, None] * of_pooled
    of_score = weight * (of_weight - (weight * of_weight).sum(axis=0))
    found["attend.v"] = np.tensordot(of_score, hidden, axes=([0, 1], [0, 1]))
    of_hidden = of_score[:, :, None] * params["attend.v"] * (1 - hidden**2)
    found["attend"] = np.tensordot(both, of_hidden, axes=([0, 1], [0, 1]))
    found["attend.b"] = of_hidden.sum(axis=(0, 1))
    of_both = of_both + of_hidden @ params["attend"].T
    of_inputs = np.zeros_like(inputs)
    for side, turn, part in (("fore", slice(None), slice(0, HIDDEN)), ("back", slice(None, None, -1), slice(HIDDEN, None))):
        of_x, found[f"{side}.h"] = gru_backward(of_both[turn, :, part], keep[side], params[f"{side}.h"])
        of_words = np.zeros((len(inputs), 3 * HIDDEN), np.float32)
        np.add.at(of_words, windows[:, turn].T, of_x)
        found[f"{side}.x"], found[f"{side}.b"] = inputs.T @ of_words, of_words.sum(axis=0)
        of_inputs += of_words @ params[f"{side}.x"].T
    found["word"], found["gram"] = np.zeros_like(params["word"]), np.zeros_like(params["gram"])
    np.add.at(found["word"], words.word, of_inputs[:, :EMBED])
    np.add.at(found["gram"], words.grams, (of_inputs[:, EMBED:] / words.count[:, None])[words.owners])
    return loss, found


class Adam:
    def __init__(self, params: dict, rate: float):
        self.params, self.rate, self.step = params, rate, 0
        self.mean = {k: np.zeros_like(v) for k, v in params.items()}
        self.square = {k: np.zeros_like(v) for k, v in params.items()}

    def update(self, slopes: dict) -> None:
        self.step += 1
        rate = self.rate * np.sqrt(1 - 0.999**self.step) / (1 - 0.9**self.step)
        for k, slope in slopes.items():
            self.mean[k] += 0.1 * (slope - self.mean[k])
            self.square[k] += 0.001 * (slope**2 - self.square[k])
            self.params[k] -= (rate * self.mean[k] / (np.sqrt(self.square[k]) + 1e-8)).astype(np.float32)
