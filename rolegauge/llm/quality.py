"""Quality rules: fixed base rules, then boosted trees over document statistics.

The trees learn from `labels.quality` (1: good) on a bounded sample of labelled documents, at most TRAIN_DOCUMENTS, those with the
smallest hash of their id. Statistics cover whole texts of all documents. More symbols, duplicate lines, repeated words and one-sign
words never raise the verdict (monotonic constraints). Without usable labels (empty table, nulls, one class) the model is constant at
the share of good documents and the base rules decide alone.

A null text has no words and fails the base rules. Repeated rows are judged one by one; a document with several labels is used once for
each. Columns besides doc_id and text are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rolegauge.llm.batches import map_texts
from rolegauge.llm.boosted_trees import Trees, constant, fit
from rolegauge.llm.splits import sample_of_each
from rolegauge.llm.text_stats import FEATURES, statistics

TRAIN_DOCUMENTS = 12_000
KEEP_FROM = 0.5
LEAST_WORDS, MOST_REPEATED = 50, 50
NEVER_RAISE = ("symbols_per_word", "duplicate_lines", "repeated_words", "one_sign_words", "top_word")
DIRECTION = np.array([-1 if name in NEVER_RAISE else 0 for name in FEATURES])
BASE = "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"


def labelled_sample(documents: DataFrame, labels: DataFrame, most: int = TRAIN_DOCUMENTS) -> DataFrame:
    """At most `most` rows (doc_id, text, quality), chosen by a hash of the id."""
    known = labels.select(F.col("doc_id").alias("__id"), F.col("quality").cast("int").alias("quality"), F.lit(1).alias("__all"))
    chosen = sample_of_each(known.where("quality in (0, 1) and __id is not null"), "__all", most, "__id").drop("__all")
    return documents.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("__id")).select("doc_id", "text", "quality")


def train(documents: DataFrame, labels: DataFrame, most: int = TRAIN_DOCUMENTS) -> Trees:
    """Fit on the statistics of the sample: `most` short rows of numbers reach the driver."""

    def work(carried: list[list], texts: list[str]) -> list:
        return [carried[0], [statistics(text)[1] for text in texts]]

    sample = labelled_sample(documents, labels, most)
    found = map_texts(sample, "quality int, features array<double>", work, ["quality"]).toPandas()
    if found.empty:
        return constant(0.0)
    order = np.lexsort(np.stack([*np.stack(found["features"]).T, found["quality"]]))  # row order must not matter
    rows, label = np.stack(found["features"])[order], found["quality"].to_numpy(float)[order]
    return fit(rows, label, DIRECTION)


def judge(documents: DataFrame, model: Trees, keep_from: float = KEEP_FROM) -> DataFrame:
    """One row per document: base values, base_failed, kept, and the model's probability."""

    def work(carried: list[list], texts: list[str]) -> list:
        found = [statistics(text) for text in texts]
        base = np.array([b for b, _ in found], np.int64)
        good = model.probability(np.array([f for _, f in found]))
        failed = (base[:, 0] < LEAST_WORDS) | (100 * base[:, 4] > MOST_REPEATED * base[:, 0])
        return [carried[0], *base.T, failed, ~failed & (good >= keep_from), good]

    return map_texts(documents, BASE + ", base_failed boolean, kept boolean, quality_score double", work, ["doc_id"])


def quality_rules(documents: DataFrame, labels: DataFrame) -> DataFrame:
    return judge(documents, train(documents, labels))


def keep_good(documents: DataFrame, labels: DataFrame, keep_from: float = KEEP_FROM) -> DataFrame:
    """The documents that are kept, with all their columns, in one pass and without a shuffle."""
    from collections.abc import Iterator

    import pyarrow as pa

    from rolegauge.llm.batches import forget_pieces, pieces

    model = train(documents, labels)
    place = documents.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_pieces()
        for batch in batches:
            texts = [t or "" for t in batch.column(place).to_pylist()]
            for begin, end in pieces(texts):
                found = [statistics(text) for text in texts[begin:end]]
                base = np.array([b for b, _ in found], np.int64)
                passed = (base[:, 0] >= LEAST_WORDS) & (100 * base[:, 4] <= MOST_REPEATED * base[:, 0])
                passed &= model.probability(np.array([f for _, f in found])) >= keep_from
                yield batch.slice(begin, end - begin).filter(pa.array(passed))

    return documents.mapInArrow(run, documents.schema)
