"""Buckets of candidates, dealt to pairs of blocks so that no bucket is one task's work and no pair is a row."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def different_buckets(rows: DataFrame, member: str, band: str) -> DataFrame:
    """(key, n) of the buckets with two or more members, without those that have the same members as a bucket of an earlier band: near copies
    meet in most bands, and one meeting is enough. Member sets are told apart by their size and 128 bits."""
    marks = [F.bit_xor(F.xxhash64(member, F.lit(seed))).alias(f"mark{seed}") for seed in range(2)]
    sizes = rows.groupBy("key").agg(F.count("*").alias("n"), F.min(band).alias("band"), *marks).where("n > 1")
    return sizes.groupBy("n", "mark0", "mark1").agg(F.min_by("key", F.struct("band", "key")).alias("key")).select("key", "n")


def dealt(rows: DataFrame, member: str, block: int, sizes: DataFrame | None = None) -> DataFrame:
    """(key, low, high, member, own): the members of every bucket `key` with two or more rows, or of those in `sizes` (key, n). A bucket of n
    members has ceil(n / block) blocks; each pair of blocks, and each block with itself, is a unit (key, low, high). `own` is the member's
    block."""
    sizes = rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1") if sizes is None else sizes
    blocks = rows.join(sizes, "key").select("key", member, F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64(member), F.col("blocks")).cast("int")
    blocks = blocks.select("key", member, own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    return blocks.select("key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), member, "own")


def units(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[tuple]]]:
    """((key, low, high), rows of the other columns) of each unit; the rows must arrive sorted by the first three columns."""
    name, rows = None, []
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for at, row in zip(zip(*columns[:3], strict=True), zip(*columns[3:], strict=True), strict=True):
            if at != name:
                if rows:
                    yield name, rows
                name, rows = at, []
            rows.append(row)
    if rows:
        yield name, rows


def in_units(members: DataFrame) -> DataFrame:
    """The rows spread by unit and sorted for `units`."""
    return members.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")


class Forest:
    """Union-find over the places of a list; the root of a set is its smallest place."""

    def __init__(self, size: int):
        self.root = list(range(size))

    def find(self, x: int) -> int:
        while self.root[x] != x:
            self.root[x] = self.root[self.root[x]]
            x = self.root[x]
        return x

    def unite(self, x: int, y: int) -> None:
        x, y = self.find(x), self.find(y)
        self.root[max(x, y)] = min(x, y)
