"""Language of whole texts by hierarchical discrimination: first the family, then one-versus-one linear support vector machines between
the languages of that family.

Features are hashed counts of character pairs and triples, square-rooted and of unit length. The models learn from at most
TRAIN_PER_LANGUAGE documents of each language, chosen by a hash of the id among the rows that are not held out; the languages are the
(at most MOST_GROUPS, see `splits`) most frequent values there. Nothing but the text enters a prediction.

A null text, or one without a letter, is `und` with score 0. Without a learnable row everything is `und`; with one language all texts
with a letter get it. A language that the family table does not name is a family of its own. Ties go to the language first in
alphabetical order. Repeated rows are judged one by one; extra columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rolegauge.llm.batches import map_texts
from rolegauge.llm.splits import held_out, learnable, sample_of_each

TRAIN_PER_LANGUAGE = 600
LEAST_ROWS = 2
BUCKETS = 4096
PART_CHARS = 1 << 20
ROWS_AT_ONCE = 256

# Languages of each family.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk bg sr hr sl mk",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz",
    "indic": "hi bn mr ne ur pa gu",
}
FAMILY_OF = {language: family for family, languages in FAMILIES.items() for language in languages.split()}

PLAIN = np.arange(128, dtype=np.uint32)
PLAIN[[c for c in range(128) if not chr(c).isalpha()]] = 32
PAIR, TRIPLE = np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B)
SHIFT = np.uint32(32 - BUCKETS.bit_length() + 1)


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def gram_counts(text: str) -> np.ndarray:
    """Hashed counts of the pairs and triples of the whole text, worked through in parts."""
    total = np.zeros(BUCKETS)
    for begin in range(0, len(text), PART_CHARS):
        part = text[begin : begin + PART_CHARS + 2].lower()
        signs = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
        signs = np.where(signs < 128, PLAIN[np.minimum(signs, 127)], signs)
        pairs = (signs[:-1] * PAIR) ^ (signs[1:] * TRIPLE)
        triples = (pairs[:-1] * TRIPLE) ^ (signs[2:] * PAIR)
        for grams in (pairs[:PART_CHARS], triples[:PART_CHARS]):
            total += np.bincount((grams * PAIR) >> SHIFT, minlength=BUCKETS)
    return total


def features(texts: list[str]) -> np.ndarray:
    rows = np.sqrt(np.stack([gram_counts(text) for text in texts])).astype(np.float32)
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)


def linear_svm(rows: np.ndarray, positive: np.ndarray, ridge: float = 1e-4, steps: int = 120) -> np.ndarray:
    """Weights (the last is the offset) of a linear machine with squared hinge loss; both classes weigh the same."""
    x = np.hstack([rows, np.ones((len(rows), 1), np.float32)])
    sign = np.where(positive, 1, -1).astype(np.float32)
    share = np.where(positive, 0.5 / max(1, positive.sum()), 0.5 / max(1, (~positive).sum())).astype(np.float32)
    now = before = np.zeros(x.shape[1], np.float32)
    rate = 0.25  # rows have a norm of sqrt(2) at most
    for step in range(steps):
        ahead = now + (step / (step + 3)) * (now - before)
        slack = np.maximum(0, 1 - sign * (x @ ahead))
        gradient = ridge * ahead - 2 * x.T @ (share * sign * slack)
        before, now = now, ahead - rate * gradient
    return now


@dataclass(frozen=True)
class LanguageModel:
    families: list[str]
    family_weights: np.ndarray  # buckets + 1, families
    languages: dict[str, list[str]]
    pair_weights: dict[str, np.ndarray]  # of each family: buckets + 1, pairs

    def predict(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Language and score (0 to 1) of each row."""
        n = len(rows)
        family, sure = np.zeros(n, np.int64), np.ones(n)
        if len(self.families) > 1:
            margins = rows @ self.family_weights[:-1] + self.family_weights[-1]
            family = margins.argmax(axis=1)
            two = np.sort(margins, axis=1)[:, -2:]
            sure = 1 / (1 + np.exp(-3 * (two[:, 1] - two[:, 0]).astype(float)))
        found = np.empty(n, object)
        for f, name in enumerate(self.families):
            at = np.nonzero(family == f)[0]
            languages = self.languages[name]
            best, pair_sure = np.zeros(len(at), np.int64), np.ones(len(at))
            if len(languages) > 1 and len(at):
                margins = rows[at] @ self.pair_weights[name][:-1] + self.pair_weights[name][-1]
                votes = np.zeros((len(at), len(languages)))
                for p, (a, b) in enumerate(combinations(range(len(languages)), 2)):
                    share = 1 / (1 + np.exp(-3 * margins[:, p].astype(float)))
                    votes[:, a] += share + (share >= 0.5)
                    votes[:, b] += 1 - share + (share < 0.5)
                best = votes.argmax(axis=1)
                pair_sure = votes.max(axis=1) / (2 * (len(languages) - 1))
            found[at] = np.array(languages, object)[best]
            sure[at] *= pair_sure
        return found, np.clip(sure, 0, 1)


def train(documents: DataFrame, most: int = TRAIN_PER_LANGUAGE) -> LanguageModel | None:
    """Fit on the sample: `most` rows of hashed counts per language reach the driver, two bytes each. None without a learnable row."""
    rows = documents.where(learnable()).select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    chosen = sample_of_each(rows.where("lang is not null and text is not null"), "lang", most)

    def work(carried: list[list], texts: list[str]) -> list:
        kept = [i for i, text in enumerate(texts) if has_letter(text)]
        return [[carried[0][i] for i in kept], [features([texts[i]]).astype(np.float16).tobytes() for i in kept]]

    found = sorted((r.lang, bytes(r.counts)) for r in map_texts(chosen, "lang string, counts binary", work, ["lang"]).toLocalIterator())
    if not found:
        return None
    x = np.stack([np.frombuffer(c, np.float16) for _, c in found]).astype(np.float32)
    language = np.array([name for name, _ in found])
    family = np.array([FAMILY_OF.get(name, name) for name in language])
    families = sorted(set(family))
    family_weights = np.stack([linear_svm(x, family == f) for f in families], axis=1) if len(families) > 1 else np.zeros((BUCKETS + 1, 1))
    languages = {f: sorted(set(language[family == f])) for f in families}
    pairs = {}
    for f in families:
        machines = [linear_svm(x[part], language[part] == a) for a, b in combinations(languages[f], 2) for part in [(language == a) | (language == b)]]
        pairs[f] = np.stack(machines, axis=1) if machines else np.zeros((BUCKETS + 1, 0))
    return LanguageModel(families, family_weights, languages, pairs)


def predict(documents: DataFrame, model: LanguageModel | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score for each row."""

    def work(carried: list[list], texts: list[str]) -> list:
        names, scores = np.full(len(texts), "und", object), np.zeros(len(texts))
        asked = [i for i, text in enumerate(texts) if model and has_letter(text)]
        for begin in range(0, len(asked), ROWS_AT_ONCE):
            at = asked[begin : begin + ROWS_AT_ONCE]
            names[at], scores[at] = model.predict(features([texts[i] for i in at]))
        return [*carried, names, scores]

    rows = documents.select("doc_id", "text", held_out().alias("held_out"))
    return map_texts(rows, "doc_id bigint, held_out boolean, lang_pred string, score double", work, ["doc_id", "held_out"])


def identify_languages(documents: DataFrame) -> DataFrame:
    return predict(documents, train(documents))
