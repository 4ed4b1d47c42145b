"""Toxicity of whole texts: the recurrent network of `gru` scores all overlapping windows; the largest window counts.

Learning: at most TRAIN_TOXIC labelled documents of class 1 and TRAIN_OTHER of class 0, with up to TRAIN_CHARS characters, chosen by a
hash of the id among the rows that are not held out. A label belongs to the document, not to a window, so training takes the windows that look worst: at first by
smoothed log-odds of words and character grams (these also start the embeddings' first column), then by the network itself. A logistic
fit of the documents' largest log-odds gives scores between 0 and 1.

Scoring reads every word of every text: windows of WINDOW words that start every STRIDE words. A text without words (null, empty) scores
0. Without labels of both classes every text scores the share of toxic labels (0 if there are none). Repeated rows are scored one by one;
extra columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rolegauge.llm.batches import map_texts
from rolegauge.llm.gru import BUCKETS, Adam, Words, forward, new_params, sigmoid, slopes_of
from rolegauge.llm.shingles import HASHES, words_of
from rolegauge.llm.splits import held_out, learnable, sample_of_each

TRAIN_TOXIC, TRAIN_OTHER, TRAIN_CHARS = 1200, 3600, 12_000
WINDOW, STRIDE = 32, 16
PREDICT_FROM = 0.3
WINDOWS_AT_ONCE, BATCH = 4096, 192
PASSES, RATE = (3, 3), 0.01
PRIOR = 4.0


class Texts:
    """Texts as windows of distinct words. Word 0 is the empty word that fills up a text's last window."""

    def __init__(self, texts: list[str]):
        known: dict[str, int] = {"": 0}
        rows = [np.array([known.setdefault(w, len(known)) for w in words_of(text)], np.int64) for text in texts]
        self.words = Words(list(known))
        starts = [np.arange(0, max(len(r) - STRIDE, 1), STRIDE) if len(r) else np.zeros(0, np.int64) for r in rows]
        self.owner = np.repeat(np.arange(len(texts)), [len(s) for s in starts])
        count = len(self.owner)
        self.windows, self.mask = np.zeros((count, WINDOW), np.int64), np.zeros((count, WINDOW), np.float32)
        padded = [np.concatenate([r, np.zeros(WINDOW, np.int64)]) for r in rows]
        at = 0
        for row, begins, full in zip(rows, starts, padded, strict=True):
            span = begins[:, None] + np.arange(WINDOW)
            self.windows[at : at + len(begins)] = full[np.minimum(span, len(full) - 1)]
            self.mask[at : at + len(begins)] = span < len(row)
            at += len(begins)
        self.windows[self.mask == 0] = 0

    def odds(self, params: dict) -> np.ndarray:
        """Log-odds of every window."""
        inputs = self.words.inputs(params)
        parts = [slice(i, i + WINDOWS_AT_ONCE) for i in range(0, len(self.windows), WINDOWS_AT_ONCE)]
        return np.concatenate([forward(params, inputs, self.windows[p], self.mask[p]) for p in parts] or [np.zeros(0, np.float32)])

    def largest(self, values: np.ndarray, count: int) -> np.ndarray:
        """The largest value among each text's windows; minus infinity for a text without words."""
        best = np.full(count, -np.inf)
        np.maximum.at(best, self.owner, values)
        return best


@dataclass(frozen=True)
class ToxicityModel:
    params: dict | None
    slope: float
    offset: float
    share: float

    def scores(self, texts: list[str]) -> np.ndarray:
        if self.params is None:
            return np.full(len(texts), self.share)
        found = Texts(texts)
        best = found.largest(found.odds(self.params), len(texts))
        return np.where(np.isfinite(best), sigmoid(self.slope * np.maximum(best, -50) + self.offset), 0.0)


def log_odds(found: np.ndarray, share: float) -> np.ndarray:
    """Smoothed log-odds of class 1 for each bucket, from the numbers of documents of class 0 and 1 that have it."""
    return np.log((found[1] + PRIOR * share) / (found[0] + PRIOR * (1 - share))) - np.log(share / (1 - share))


def start_embeddings(params: dict, texts: Texts, vocabulary: WordSubset, label: np.ndarray) -> np.ndarray:
    """Put the log-odds in the first column of both embeddings; a first value for each distinct word."""
    by_word, by_gram = np.zeros((2, BUCKETS)), np.zeros((2, BUCKETS))
    ends = np.searchsorted(texts.owner, np.arange(len(label) + 1))
    for doc, (begin, end) in enumerate(zip(ends[:-1], ends[1:], strict=True)):
        own = vocabulary.take(np.unique(texts.windows[begin:end]))
        by_word[int(label[doc]), np.unique(own.word)] += 1
        by_gram[int(label[doc]), np.unique(own.grams)] += 1
    share = float(label.mean())
    params["word"][:, 0], params["gram"][:, 0] = log_odds(by_word, share), log_odds(by_gram, share)
    return params["word"][texts.words.word, 0] + texts.words.mean_of_grams(params["gram"][:, :1])[:, 0]


def worst_windows(texts: Texts, values: np.ndarray, label: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """The window with the largest value of each text, one more random one of each text of class 0."""
    order = np.lexsort([values, texts.owner])
    last = np.append(texts.owner[order][1:] != texts.owner[order][:-1], True)
    mixed = rng.permutation(len(values))
    first = np.unique(texts.owner[mixed], return_index=True)[1]
    other = mixed[first]
    return np.concatenate([order[last], other[label[texts.owner[other]] == 0]])


def learn(params: dict, texts: Texts, vocabulary: WordSubset, label: np.ndarray, chosen: np.ndarray, passes: int, adam: Adam, rng: np.random.Generator) -> None:
    goal = label[texts.owner[chosen]].astype(np.float32)
    weight = np.where(goal > 0, 0.5 / max(1, goal.sum()), 0.5 / max(1, (1 - goal).sum())) * len(goal)
    for _ in range(passes):
        order = rng.permutation(len(chosen))
        for begin in range(0, len(order), BATCH):
            at = order[begin : begin + BATCH]
            rows = texts.windows[chosen[at]]
            used, local = np.unique(rows, return_inverse=True)
            _, slopes = slopes_of(params, vocabulary.take(used), local.reshape(rows.shape), texts.mask[chosen[at]], goal[at], weight[at] / len(at))
            adam.update(slopes)


class WordSubset:
    """Chosen words of a vocabulary, with their grams."""

    def __init__(self, words: Words):
        order = np.argsort(words.owners, kind="stable")
        self.words, self.grams = words, words.grams[order]
        self.size = np.bincount(words.owners, minlength=len(words.word))
        self.first = np.cumsum(self.size) - self.size

    def take(self, used: np.ndarray) -> Words:
        part = Words.__new__(Words)
        count = self.size[used]
        part.word, part.count = self.words.word[used], self.words.count[used]
        part.owners = np.repeat(np.arange(len(used)), count)
        part.grams = self.grams[np.repeat(self.first[used] - np.cumsum(count) + count, count) + np.arange(count.sum())]
        return part


def logistic(x: np.ndarray, label: np.ndarray, ridge: float = 1e-2) -> tuple[float, float]:
    """Slope and offset of a one-dimensional logistic fit, by Newton steps."""
    w = np.array([1.0, 0.0])
    rows = np.stack([x, np.ones(len(x))], axis=1)
    for _ in range(25):
        p = sigmoid(rows @ w)
        slope = rows.T @ (p - label) + ridge * (w - [1.0, 0.0])
        curve = (rows * (p * (1 - p))[:, None]).T @ rows + ridge * np.eye(2)
        w = w - np.clip(np.linalg.solve(curve, slope), -1, 1)
    return max(float(w[0]), 1e-3), float(w[1])


def fit(texts: list[str], label: np.ndarray, seed: int = 11) -> ToxicityModel:
    share = float(label.mean()) if len(label) else 0.0
    if share in (0.0, 1.0):
        return ToxicityModel(None, 1.0, 0.0, share)
    rng, params, found = np.random.default_rng(seed), new_params(seed), Texts(texts)
    if not len(found.windows):
        return ToxicityModel(None, 1.0, 0.0, share)
    vocabulary = WordSubset(found.words)
    first = start_embeddings(params, found, vocabulary, label)
    adam = Adam(params, RATE)
    values = first[found.windows].max(axis=1, where=found.mask > 0, initial=-50)
    for passes in PASSES:
        learn(params, found, vocabulary, label, worst_windows(found, values, label, rng), passes, adam, rng)
        values = found.odds(params)
    HASHES.clear()
    best = found.largest(values, len(texts))
    full = np.isfinite(best)
    return ToxicityModel(params, *logistic(np.clip(best[full], -20, 20), label[full]), share)


def train(documents: DataFrame, labels: DataFrame, most: tuple[int, int] = (TRAIN_OTHER, TRAIN_TOXIC)) -> ToxicityModel:
    """Fit on the sample: at most `most` texts of class 0 and 1, of TRAIN_CHARS characters each, reach the driver."""
    known = labels.select(F.col("doc_id").alias("__id"), F.col("toxic").cast("int").alias("toxic")).where(learnable("__id") & F.col("toxic").isin(0, 1))
    texts = documents.select("doc_id", "text").where(learnable() & (F.length("text") <= TRAIN_CHARS))
    # Chosen before texts are joined: twice as many ids as needed, since some belong to longer texts or to none.
    found = []
    for toxic, count in enumerate(most):
        ids = F.broadcast(sample_of_each(known.where(F.col("toxic") == toxic).distinct(), "toxic", 2 * count, "__id"))
        rows = texts.join(ids, F.col("doc_id") == F.col("__id")).select("doc_id", "text", "toxic")
        chosen = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(count)  # of 2 x count rows at most
        found += [(r.doc_id, r.toxic, r.text) for r in chosen.toLocalIterator()]
    found.sort()
    return fit([text for _, _, text in found], np.array([toxic for _, toxic, _ in found], float))


def score(documents: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, held_out, score, predicted for each row."""

    def work(carried: list[list], texts: list[str]) -> list:
        scores = model.scores(texts).astype(float)
        return [*carried, scores, (scores >= PREDICT_FROM).astype(np.int32)]

    rows = documents.select("doc_id", "text", held_out().alias("held_out"))
    return map_texts(rows, "doc_id bigint, held_out boolean, score double, predicted int", work, ["doc_id", "held_out"])


def score_toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    return score(documents, train(documents, labels))
