"""Vector code compression: each part of a vector is replaced by the index of the nearest entry of a small codebook.

1. Components x become integers floor(SCALE * x); vectors are cut into PARTS equal consecutive parts. Rows whose vector is null, empty or
   holds null or non-finite components are dropped, and so are vectors with another number of components than the row with the smallest
   id has, or a number that PARTS does not divide.
2. The codebook of a part position starts as that part of the ENTRIES rows with the smallest ids. In each of ROUNDS rounds the parts of all rows
   are assigned to the nearest entry; tasks add up their own parts, Spark adds the tasks' sums (one row per task, part and entry), and an
   entry becomes the componentwise floor of sum / count. Entries without parts stay.
3. The parts are assigned once more, which gives the codes and errors.

The nearest entry is found with a tree over the entries (`gnat.Gnat`), whose results equal those of comparing all entries. Codebooks are
PARTS x ENTRIES entries whatever the number of rows: the only thing the driver gets.

Ties: equal distances go to the lower index; rows with equal ids are ordered by their vector; null ids come last. Fewer than ENTRIES rows make
smaller codebooks; an empty table gives no rows. Repeated rows count and are returned as often as they stand there. Errors are exact; one
that 64 bits cannot hold is given as the largest number of 64 bits. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rolegauge.llm.gnat import PLAIN, Gnat
from rolegauge.storage import materialize

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
MOST = (1 << 63) - 1
LIMB = 96
ROWS_AT_ONCE = 8192


def usable(vector: Column) -> Column:
    """The vector has components, and all are finite."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, finite), F.lit(False))


def whole(vectors: np.ndarray) -> np.ndarray:
    """floor(SCALE * x), exact: the product with a power of two has no rounding. Huge components become Python integers."""
    scaled = np.floor(vectors * SCALE)
    if scaled.size and np.abs(scaled).max() > PLAIN:
        return np.array([int(x) for x in scaled.ravel().tolist()], object).reshape(scaled.shape)
    return scaled.astype(np.int64)


class Codebooks:
    """(parts, entries, components) integers, with a tree for each part position."""

    def __init__(self, entries: np.ndarray):
        small = max((abs(int(x)) for x in entries.ravel().tolist()), default=0) <= PLAIN
        self.entries = entries.astype(np.int64 if small else object)
        self.trees = [Gnat(part) for part in self.entries]

    def assign(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows, parts) indices, and the squared distances of each row added up."""
        parts = vectors.reshape(len(vectors), len(self.trees), -1)
        found = [tree.nearest(parts[:, i]) for i, tree in enumerate(self.trees)]
        return np.stack([index for index, _ in found], axis=1), sum(gap for _, gap in found)

    def moved(self, sums: dict[tuple[int, int], tuple[int, list[int]]]) -> Codebooks:
        """The codebooks of the next round; sums: (part, entry) -> count and componentwise sums."""
        after = self.entries.astype(object)
        for (part, entry), (count, total) in sums.items():
            after[part, entry] = [x // count for x in total]
        return Codebooks(after)

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def vectors_of(batches: Iterator[pa.RecordBatch], place: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of bounded size with their integer vectors, all of one length."""
    for batch in batches:
        for begin in range(0, batch.num_rows, ROWS_AT_ONCE):
            part = batch.slice(begin, ROWS_AT_ONCE)
            yield part, whole(part.column(place).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1))


def limbs(value: int) -> list[Decimal]:
    """Digits of a whole number in base 2^LIMB, lowest first; the last one has the sign. Sums of each place give the sum of the numbers."""
    out = []
    while not -(1 << LIMB) < value < 1 << LIMB:
        value, digit = divmod(value, 1 << LIMB)
        out.append(Decimal(digit))
    return [*out, Decimal(value)]


def part_sums(rows: DataFrame, books: Codebooks) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """Count and componentwise sums of the parts of each entry."""
    parts, entries, width = books.entries.shape
    schema = pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.list_(pa.decimal128(38, 0))))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros((parts, entries), np.int64)
        total = np.zeros((parts, entries, width), object)
        for _, vectors in vectors_of(batches, 0):
            index, _ = books.assign(vectors)
            pieces = vectors.reshape(len(vectors), parts, width)
            for part in range(parts):
                add = np.zeros((entries, width), pieces.dtype)
                np.add.at(add, index[:, part], pieces[:, part])
                total[part] += add.astype(object)
                count[part] += np.bincount(index[:, part], minlength=entries)
        if count.any():
            at = [(int(p), int(e)) for p, e in np.argwhere(count)]
            columns = [[p for p, _ in at], [e for _, e in at], [int(count[x]) for x in at], [[limbs(int(v)) for v in total[x]] for x in at]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    found = rows.select("vector").mapInArrow(run, "part int, entry int, n bigint, sums array<array<decimal(38,0)>>")
    places = found.select("part", "entry", "n", F.posexplode("sums").alias("pos", "digits")).select("part", "entry", "n", "pos", F.posexplode("digits").alias("place", "x"))
    summed = places.groupBy("part", "entry", "pos", "place").agg(F.sum("n").alias("n"), F.sum("x").alias("x"))
    out: dict[tuple[int, int], tuple[int, list[int]]] = {}
    for row in sorted(summed.collect()):  # parts x entries x components rows, whatever the number of vectors
        total = out.setdefault((row.part, row.entry), (row.n, [0] * width))[1]
        total[row.pos] += int(row.x) << LIMB * row.place
    return out


def first_codebooks(rows: DataFrame, parts: int, entries: int) -> Codebooks | None:
    """The parts of the rows with the smallest ids; None for a table without usable vectors."""
    first = rows.select("id", "vector").orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).collect()
    if not first:
        return None
    table = whole(np.array([r.vector for r in first], np.float64))
    return Codebooks(np.swapaxes(table.reshape(len(first), parts, -1), 0, 1))


def usable_rows(table: DataFrame, vector: str, vec_id: str, label: str, parts: int) -> DataFrame | None:
    """(id, vector, label) of the rows that can be coded; None if there are none."""
    rows = table.select(table[vec_id].alias("id"), table[vector].cast("array<double>").alias("vector"), table[label].alias("label")).where(usable(F.col("vector")))
    top = rows.orderBy(F.col("id").asc_nulls_last(), "vector").limit(1).select(F.size("vector").alias("n")).collect()
    if not top or top[0].n % parts:
        return None
    return rows.where(F.size("vector") == top[0].n)


def fit_codebooks(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    books = first_codebooks(rows, parts, entries)
    for _ in range(rounds):
        books = books.moved(part_sums(rows, books))
    return books


def coded(rows: DataFrame, books: Codebooks) -> DataFrame:
    """id, label, code, error of each row."""
    digits = [f"{i:02x}" for i in range(books.entries.shape[1])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, vectors in vectors_of(batches, 2):
            index, far = books.assign(vectors)
            codes = ["".join(map(digits.__getitem__, row)) for row in index.tolist()]
            error = pa.array([min(MOST, x) for x in far.tolist()], pa.int64())
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(codes, pa.string()), error], ["id", "label", "code", "error"])

    kind = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.select("id", "label", "vector").mapInArrow(run, f"id {kind['id']}, label {kind['label']}, code string, error bigint")


def restored(codes: DataFrame, books: Codebooks) -> DataFrame:
    """vec_id and the approximate vector that its code stands for."""
    parts, _, width = books.entries.shape
    values = books.entries.astype(np.float64) / SCALE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                index = np.frombuffer(bytes.fromhex("".join(batch.column(1).to_pylist())), np.uint8).reshape(-1, parts)
                vectors = values[np.arange(parts), index].reshape(-1)
                offsets = np.arange(batch.num_rows + 1, dtype=np.int32) * (parts * width)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, vectors)], ["vec_id", "vector"])

    return codes.select("vec_id", "code").mapInArrow(run, f"vec_id {dict(codes.dtypes)['vec_id']}, vector array<double>")


def vector_codes(
    table: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> DataFrame:
    """One row per usable vector: vec_id, code, error, label_error, codebooks_sha256."""
    rows = usable_rows(table, vector, vec_id, label, parts)
    if rows is None:
        text, number = F.lit("").alias, F.lit(0).cast("bigint").alias
        return table.select(table[vec_id].alias("vec_id"), text("code"), number("error"), number("label_error"), text("codebooks_sha256")).limit(0)
    books = fit_codebooks(rows, parts, entries, rounds)
    found = materialize(coded(rows, books), "vector-codes")
    total = F.least(F.sum(F.col("error").cast("decimal(20,0)")), F.lit(Decimal(MOST))).cast("bigint")
    per_label = found.groupBy(F.col("label").alias("__label")).agg(total.alias("label_error"))
    out = found.join(per_label, F.col("label").eqNullSafe(F.col("__label")))
    return out.select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))
