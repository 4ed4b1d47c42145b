"""N-gram Jaccard join with Bayesian candidate pruning.

1. One pass computes, for each document, the digest of its set of five-word shingles, a MinHash signature and band keys.
2. Documents with equal sets form a class; only the class's representative (smallest doc_id) goes on.
3. Representatives that share a band key are candidates. Buckets with the same members as one of an earlier band are left out. A bucket is split into blocks of BLOCK members, and a task gets two blocks at a
   time: no bucket is one task's work, and no pair is a row.
4. In the task, a pair is looked at in the first band it shares. Its signatures are compared STEP values at a time. With a uniform prior
   the similarity after m equal values of n follows Beta(m + 1, n - m + 1); the pair is dropped as soon as the probability of reaching
   the threshold falls below TOLERANCE. What is left is verified by the exact Jaccard similarity of the whole sets.
5. A task returns per member its number of verified links and one link that ties it to its block's root: the output is linear in the
   members, while every link is counted and every component is complete.

Result: one row per document with class_id (the smallest doc_id with the same set), n_copies of that class, n_links (representatives of
other classes with similarity of THRESHOLD or more) and group_id (smallest doc_id connected through links).

BANDS x ROWS gives a pair at the threshold a chance of 3e-5 to share no band, and TOLERANCE adds 1e-6; both fall quickly above the
threshold. A null or empty text has no shingles: it is a class of its own and links to nothing. Texts of one to four words have one
shingle. Repeated rows are copies and repeat in the result. A null doc_id takes part with an id of null. Extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rolegauge.llm.batches import forget_pieces, map_texts
from rolegauge.llm.buckets import Forest, dealt, different_buckets, in_units, units
from rolegauge.llm.components import components
from rolegauge.llm.shingles import MinHasher, band_keys, shingles
from rolegauge.storage import materialize

THRESHOLD = 0.8
BANDS, ROWS, HASHES = 20, 4, 96
STEP, TOLERANCE = 16, 1e-6
BLOCK = 512
HASHER = MinHasher(HASHES)
FOUND = "rep binary, root binary, n_links bigint"


def set_digest(values: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(values.tobytes())


def tail(equal: int, of: int, threshold: float) -> float:
    """P(similarity >= threshold) after `equal` of `of` values agreed, uniform prior: a binomial sum, since both counts are whole."""
    n = of + 1
    return sum(math.comb(n, k) * threshold**k * (1 - threshold) ** (n - k) for k in range(equal + 1))


def least_equal(threshold: float, tolerance: float, step: int, hashes: int) -> list[int]:
    """For each prefix of the signature, the fewest equal values with which a pair stays."""
    return [next(m for m in range(n + 1) if tail(m, n, threshold) >= tolerance) for n in range(step, hashes + 1, step)]


def described(documents: DataFrame) -> DataFrame:
    """(doc_id, digest, keys): digest and keys are null for texts without words."""

    def work(carried: list[list], texts: list[str]) -> list:
        sets = [shingles(text) for text in texts]
        full = [i for i, s in enumerate(sets) if len(s)]
        digests: list = [None] * len(texts)
        keys: list = [None] * len(texts)
        if full:
            ends = np.cumsum([len(sets[i]) for i in full])
            signatures = HASHER.signatures(np.concatenate([sets[i] for i in full]), np.concatenate([[0], ends[:-1]]))
            for i, row in zip(full, band_keys(signatures, BANDS, ROWS), strict=True):
                digests[i], keys[i] = set_digest(sets[i]), row
        return [carried[0], digests, keys]

    return map_texts(documents, "doc_id bigint, digest binary, keys array<bigint>", work, ["doc_id"])


def block_members(reps: DataFrame) -> DataFrame:
    """(key, low, high, rep): for each bucket of two or more, its members dealt to pairs of blocks. The first band that a pair shares is
    among the bands whose buckets are kept: a bucket goes only if an earlier band has the same members."""
    rows = reps.select(F.col("digest").alias("rep"), F.posexplode("keys").alias("band", "key"))
    return dealt(rows, "rep", BLOCK, different_buckets(rows, "rep", "band"))


def with_sets(documents: DataFrame, reps: DataFrame) -> DataFrame:
    """(rep, shingles, signature) of the representatives, computed again from their texts only."""
    wanted = reps.select(F.col("rep_id").alias("__id"), F.col("rep").alias("__rep"))
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(wanted, F.col("doc_id").eqNullSafe(F.col("__id")))

    def work(carried: list[list], found: list[str]) -> list:
        rows = []
        for rep, text in zip(carried[0], found, strict=True):
            values = shingles(text)
            if set_digest(values) == rep:  # rows that repeat an id may have other texts
                rows.append((rep, values.tobytes(), HASHER.signatures(values, np.zeros(1, np.int64)).tobytes()))
        return [[r[i] for r in rows] for i in range(3)]

    return map_texts(texts, "rep binary, shingles binary, signature binary", work, ["__rep"])


class Block:
    """The members of one pair of blocks, as arrays."""

    def __init__(self, rows: list[tuple[bytes, int, bytes, bytes]]):
        rows = sorted({row[0]: row for row in rows}.values())
        self.reps = [row[0] for row in rows]
        self.sides = np.array([row[1] for row in rows])
        self.sets = [np.frombuffer(row[2], np.uint64) for row in rows]
        self.signatures = np.stack([np.frombuffer(row[3], np.uint32) for row in rows])
        self.keys = band_keys(self.signatures, BANDS, ROWS)

    def candidate_pairs(self, key: int, low: int, high: int, least: list[int]) -> Iterator[tuple[int, np.ndarray]]:
        """For each member, the later members that outlast the pruning."""
        band = int(np.argmax((self.keys == key).all(axis=0)))
        for i in range(len(self.reps) - 1):
            others = np.arange(i + 1, len(self.reps))
            if low != high:
                others = others[self.sides[others] != self.sides[i]]
            if band:  # seen before, in an earlier band that both share
                others = others[~(self.keys[others, :band] == self.keys[i, :band]).any(axis=1)]
            equal = np.zeros(len(others), np.int64)
            for part, needed in enumerate(least):
                if not len(others):
                    break
                span = slice(part * STEP, (part + 1) * STEP)
                equal += (self.signatures[others, span] == self.signatures[i, span]).sum(axis=1)
                stays = equal >= needed
                others, equal = others[stays], equal[stays]
            if len(others):
                yield i, others

    def links(self, key: int, low: int, high: int, threshold: float, least: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Number of verified links of each member, and its root."""
        count, forest = np.zeros(len(self.reps), np.int64), Forest(len(self.reps))
        for i, others in self.candidate_pairs(key, low, high, least):
            own = self.sets[i]
            for j in others.tolist():
                sizes = len(own) + len(self.sets[j])
                both = np.concatenate([own, self.sets[j]])
                both.sort(kind="stable")
                shared = int((both[1:] == both[:-1]).sum())
                if shared >= threshold * (sizes - shared) - 1e-9:
                    count[[i, j]] += 1
                    forest.unite(i, j)
        return count, np.array([forest.find(i) for i in range(len(self.reps))])


def linked(members: DataFrame, threshold: float) -> DataFrame:
    """(rep, root, n_links) for members of blocks that have a verified link there. Rows arrive sorted by block."""
    least = least_equal(threshold, TOLERANCE, STEP, HASHES)

    def settle(name: tuple, rows: list[tuple]) -> list[tuple]:
        block = Block(rows)
        if len(block.reps) < 2:
            return []
        count, root = block.links(*name, threshold, least)
        return [(block.reps[i], block.reps[root[i]], int(count[i])) for i in np.nonzero(count)[0]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, rows in units(batches):
            if found := settle(name, rows):
                columns = zip(zip(*found, strict=True), (pa.binary(), pa.binary(), pa.int64()), strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], ["rep", "root", "n_links"])

    return in_units(members).select("key", "low", "high", "rep", "own", "shingles", "signature").mapInArrow(run, FOUND)


def found_classes(documents: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(doc_id, digest) of the rows, and for each class (__d, its digest): class_id, n_copies, n_links, group_id, and keeper, which is true for
    one class of each group. Groups are those of digests: rows that share an id and have other texts tie nothing together."""
    known = materialize(described(documents), "signatures")
    full = known.where("digest is not null")
    classes = full.groupBy("digest").agg(F.min("doc_id").alias("rep_id"), F.count("*").alias("n_copies"))
    classes = materialize(classes, "classes")
    # Any row of the class has its keys; those of equal rows (same id and set) are one.
    reps = full.join(classes.withColumnRenamed("digest", "__d"), (F.col("digest") == F.col("__d")) & F.col("doc_id").eqNullSafe(F.col("rep_id")))
    reps = reps.select("digest", "keys").dropDuplicates(["digest"])
    members = materialize(block_members(reps), "blocks")
    involved = members.select("rep").distinct().join(classes.select(F.col("digest").alias("rep"), "rep_id"), "rep")
    sets = materialize(with_sets(documents, involved), "sets").dropDuplicates(["rep"])
    ties = materialize(linked(members.join(sets, "rep"), threshold), "links")
    counts = ties.groupBy("rep").agg(F.sum("n_links").alias("n_links"))
    groups = components(ties.select("rep", "root"), "rep", "root").withColumnRenamed("node", "digest")
    named = groups.join(classes, "digest").groupBy("component").agg(
        F.min("rep_id").alias("least_id"), F.min_by("digest", F.struct(F.col("rep_id").isNull(), "rep_id", "digest")).alias("kept")
    )
    out = classes.join(counts.withColumnRenamed("rep", "digest"), "digest", "left").join(groups, "digest", "left").join(named, "component", "left")
    out = out.select(
        F.col("digest").alias("__d"), F.col("rep_id").alias("class_id"), "n_copies", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("least_id", "rep_id").alias("group_id"), (F.coalesce("kept", "digest") == F.col("digest")).alias("keeper"),
    )
    return known.select("doc_id", "digest"), out


def jaccard_join(documents: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, class_id, n_copies, n_links, group_id."""
    known, classes = found_classes(documents, threshold)
    rows = known.join(classes, F.col("digest") == F.col("__d"), "left")
    return rows.select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_copies", F.lit(1)).cast("bigint").alias("n_copies"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), F.coalesce("group_id", "doc_id").alias("group_id"),
    )


def with_digests(documents: DataFrame) -> DataFrame:
    """The documents with the column __digest, null for texts without words."""
    place, types = documents.columns.index("text"), T.StructType([*documents.schema.fields, T.StructField("__digest", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_pieces()
        for batch in batches:
            sets = [shingles(text or "") for text in batch.column(place).to_pylist()]
            digests = pa.array([set_digest(s) if len(s) else None for s in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, digests], names=[*batch.schema.names, "__digest"])

    return documents.mapInArrow(run, types)


def keep_one_of_each_group(documents: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents without those that have another one in their group: the row with the smallest id stays. Of rows that repeat the id and the
    shingles of the row that stays, one does; rows that share its id and have other shingles are judged by their own group. Texts without
    words stay (one row for each id), and so do rows without an id."""
    known, classes = found_classes(documents, threshold)
    rows = known.where("doc_id is not null").join(classes, F.col("digest") == F.col("__d"), "left")
    rows = rows.withColumn("stays", F.coalesce(F.col("keeper") & (F.col("doc_id") == F.col("class_id")), F.col("digest").isNull()))
    stays = materialize(rows.where("stays").select("doc_id", F.coalesce("digest", F.lit(b"")).alias("digest")), "kept")
    # Rows whose id stands there once need no digest of their own.
    ids = rows.groupBy("doc_id").agg(F.count("*").alias("n"), F.max("stays").alias("any")).where("any")
    ids = materialize(ids.select(F.col("doc_id").alias("__id"), (F.col("n") == 1).alias("__once")), "kept-ids")
    columns = [documents[c] for c in documents.columns]
    named = documents.join(ids, documents["doc_id"] == F.col("__id"))
    single = named.where("__once").select(*columns)
    pairs = stays.select(F.col("doc_id").alias("__kept_id"), F.col("digest").alias("__kept")).distinct()
    several = with_digests(named.where(~F.col("__once")).select(*columns, "__id"))
    several = several.join(pairs, (F.col("__id") == F.col("__kept_id")) & (F.coalesce("__digest", F.lit(b"")) == F.col("__kept")), "left_semi")
    several = several.dropDuplicates(["__id", "__digest"]).select(*documents.columns)
    return single.unionByName(several).unionByName(documents.where("doc_id is null"))
