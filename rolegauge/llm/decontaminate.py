"""Benchmark decontamination: size-partitioned MinHash containment search, then exact shingle containment.

Containment of an item in a document is the share of the item's distinct five-word shingles that the document has; THRESHOLD or more is a
leak. Comparing whole-text MinHash signatures cannot find 40 shingles among 20,000, so the sketch is taken on the item's side alone: the
k smallest hashes of the item, looked up in the document's whole set (containment MinHash). Items are partitioned by size, each
partition has its own k. At most `q - ceil(THRESHOLD q)` of q shingles may be missing, so at least k minus that many of the sketch must
be found; with k above that number no leak can be missed, at any document length. Candidates are then verified on real word tuples.

Matches are looked up in the tasks while the sketches are at most BROADCAST_HASHES values (16 bytes each); beyond that the documents'
shingles are joined with the sketch table by a shuffle, with the same result.

Null and empty texts, and items of fewer than five words, have no shingles and match nothing. Repeated rows repeat their pairs once: the
result has one row per (doc_id, item_id), with the largest containment among rows of the same id. Extra columns are not read.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rolegauge.llm.batches import map_texts
from rolegauge.llm.shingles import WIDTH, window_hashes, word_hashes, words_of
from rolegauge.storage import materialize

THRESHOLD = 0.8
SKETCH_HITS = 3
BROADCAST_HASHES = 1_000_000
PAIRS = "doc_id bigint, item_id bigint, n_shingles bigint, n_shared bigint, containment double"


def allowed_misses(size: int, threshold: float) -> int:
    return size - math.ceil(threshold * size - 1e-9)


def sketch_size(size: int, threshold: float) -> int:
    """k of the size partition (powers of two): the misses its largest item may have, and SKETCH_HITS more."""
    largest = 1 << max(0, size - 1).bit_length()
    return allowed_misses(largest, threshold) + SKETCH_HITS


def sketches(items: DataFrame, threshold: float) -> DataFrame:
    """(item_id, n_shingles, needed, hash): the sketch of each item that has shingles."""

    def work(carried: list[list], texts: list[str]) -> list:
        rows = []
        for item, text in zip(carried[0], texts, strict=True):
            words = words_of(text)
            if len(words) >= WIDTH:
                values = np.unique(window_hashes(word_hashes(words)))
                k = min(len(values), sketch_size(len(values), threshold))
                needed = max(1, k - allowed_misses(len(values), threshold))
                rows += [(item, len(values), needed, int(v)) for v in values[:k].view(np.int64)]
        return [list(c) for c in zip(*rows, strict=True)] if rows else [[], [], [], []]

    return map_texts(items, "item_id bigint, n_shingles bigint, needed bigint, hash bigint", work, ["item_id"])


def document_hashes(documents: DataFrame, wanted: np.ndarray | None) -> DataFrame:
    """(doc_id, hash) of the documents' distinct shingles, those in the sorted array `wanted` only if it is given."""
    shared = documents.sparkSession.sparkContext.broadcast(wanted) if wanted is not None else None

    def work(carried: list[list], texts: list[str]) -> list:
        ids, values = [], []
        among = shared.value if shared else None
        bits = None
        if among is not None:
            bits = np.zeros(1 << 22, bool)  # most shingles are sent away by one look
            bits[among >> np.uint64(42)] = True
        for doc, text in zip(carried[0], texts, strict=True):
            words = words_of(text)
            if len(words) < WIDTH:
                continue
            found = window_hashes(word_hashes(words))
            if among is not None:
                found = found[bits[found >> np.uint64(42)]]
                found = found[among[np.minimum(np.searchsorted(among, found), len(among) - 1)] == found]
            found = np.unique(found)
            ids += [doc] * len(found)
            values.append(found)
        return [ids, np.concatenate(values).view(np.int64) if values else []]

    return map_texts(documents, "doc_id bigint, hash bigint", work, ["doc_id"])


def candidates(documents: DataFrame, items: DataFrame, threshold: float, broadcast_hashes: int) -> DataFrame:
    """(doc_id, item_id) pairs that have enough of the item's sketch."""
    sketch = materialize(sketches(items.where("item_id is not null"), threshold).distinct(), "sketches")
    distinct = sketch.select("hash").distinct()
    wanted = None
    if distinct.count() <= broadcast_hashes:  # 8 bytes each: at most 8 MB reach the driver and go out again
        wanted = np.sort(np.array([r.hash for r in distinct.toLocalIterator()], np.int64).view(np.uint64))
        if not len(wanted):
            return documents.sparkSession.createDataFrame([], "doc_id bigint, item_id bigint")
    hits = document_hashes(documents.where("doc_id is not null"), wanted)
    if wanted is not None:
        # At most `broadcast_hashes` hashes, but an item's hash may belong to several items: no hint, Spark knows the file's size.
        hits = hits.join(sketch, "hash")
    else:
        hits = hits.join(sketch.withColumnRenamed("hash", "__hash"), F.col("hash") == F.col("__hash")).drop("__hash")
    found = hits.groupBy("doc_id", "item_id", "n_shingles").agg(F.count_distinct("hash").alias("n"), F.min("needed").alias("needed"))
    return found.where("n >= needed").select("doc_id", "item_id").distinct()


def verified(documents: DataFrame, items: DataFrame, pairs: DataFrame, threshold: float) -> DataFrame:
    """Exact containment of the candidate pairs. A document meets its candidate items only, as one array of ids and texts."""
    texts = items.where("item_id is not null").groupBy("item_id").agg(F.collect_set(F.coalesce("text", F.lit(""))).alias("variants"))
    per_item = pairs.join(texts, "item_id").select("doc_id", "item_id", F.explode("variants").alias("item_text"))
    per_doc = per_item.groupBy("doc_id").agg(F.collect_list(F.struct("item_id", "item_text")).alias("__items"))
    docs = documents.select(F.col("doc_id"), F.coalesce("text", F.lit("")).alias("text")).join(per_doc, "doc_id")

    def tuples(text: str) -> set[tuple[str, ...]]:
        words = words_of(text)
        return set(zip(*(words[i:] for i in range(WIDTH)), strict=False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = defaultdict(list)
            for doc, text, item_rows in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = tuples(text)
                for item in item_rows:
                    asked = tuples(item["item_text"])
                    if not asked:  # a variant of a repeated id without shingles
                        continue
                    shared = len(asked & own)
                    if shared >= math.ceil(threshold * len(asked) - 1e-9):
                        for name, value in (("doc_id", doc), ("item_id", item["item_id"]), ("n_shingles", len(asked)), ("n_shared", shared),
                                            ("containment", shared / len(asked))):
                            rows[name].append(value)
            if rows:
                yield pa.RecordBatch.from_pydict(dict(rows))

    found = docs.mapInArrow(run, PAIRS)
    best = F.max(F.struct("containment", "n_shared", "n_shingles"))
    return found.groupBy("doc_id", "item_id").agg(best.alias("b")).select("doc_id", "item_id", "b.n_shingles", "b.n_shared", "b.containment")


def find_leaks(documents: DataFrame, items: DataFrame, threshold: float = THRESHOLD, broadcast_hashes: int = BROADCAST_HASHES) -> DataFrame:
    """One row per leak: doc_id, item_id, n_shingles (of the item), n_shared, containment."""
    pairs = materialize(candidates(documents, items, threshold, broadcast_hashes), "leak-candidates")
    return verified(documents, items, pairs, threshold)


def without_leaks(documents: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that contain no item. A null doc_id cannot be named by a leak and stays."""
    leaks = materialize(find_leaks(documents, items, threshold).select(F.col("doc_id").alias("__id")).distinct(), "leaks")
    return documents.join(leaks, F.col("doc_id") == F.col("__id"), "left_anti")
