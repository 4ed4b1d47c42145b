"""Token ids in Huffman-coded files, and back.

Writing: (1) a range shuffle puts the texts in ascending doc_id order; each task encodes its range into a raw file of ids and reports the
number of ids and the counts per id. (2) The counts are summed by Spark; one row per id of the vocabulary reaches the driver, which makes
one canonical code for all files. (3) Each raw file is coded into a file of its own, which knows how many ids come before it.

A file is: MAGIC; header length (u32) and header, JSON with `start` (ids before this file) and the code (symbols, lengths), compressed;
blocks; a zero length. A block is: length of its body (u32), CRC-32 of the body (u32), body. A body is: ids n (u32), documents that end
here d (u32), checkpoints c (u32), bytes of the code b (u32); d document ids (i64), d flags (u8, 0 for a null id), d sizes (u64);
c bit offsets (u64), one for every CHECKPOINT-th id; the code. A block is decoded alone. A document may span blocks: it is listed where
it ends. All numbers are little-endian.

Files are written under new names in every attempt, and only those that successful tasks report are read. Null and empty texts have the
end id alone. Null ids come first; rows that repeat an id are ordered by text and all written. Extra columns are not read. An empty table
gives no files.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from base64 import b64decode, b64encode
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rolegauge.llm.batches import pieces
from rolegauge.llm.huffman import CHECKPOINT, MAX_BITS, Codebook, code_lengths
from rolegauge.llm.tokenizing import piece_encoder
from rolegauge.storage import materialize, new_folder

TOKENIZER, END_ID = "byte_bpe_50k.json", 2
BLOCK_IDS = 1 << 20
TEXT_PIECE = 8_000_000
MAGIC = b"IDCODE01"
RAW = "part int, path string, n_ids bigint, ids array<int>, counts array<bigint>"
MANIFEST = "part int, path string, start bigint, n_ids bigint, n_bytes bigint"
ROWS_AT_ONCE = 2048


def opened(folder: str, name: str):
    files, root = pyarrow.fs.FileSystem.from_uri(folder)
    files.create_dir(root, recursive=True)
    return files.open_output_stream(f"{root}/{name}", compression=None)


def source(path: str):
    files, at = pyarrow.fs.FileSystem.from_uri(path)
    return files.open_input_stream(at, compression=None)


def write_raw(documents: DataFrame, folder: str, tokenizer_path: str) -> DataFrame:
    """Step 1. A raw file is a run of packed records (ids u32, doc_id i64 or null, size)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        encoder, stream, path, total = piece_encoder(tokenizer_path, END_ID), None, "", 0
        counts = np.zeros(0, np.int64)
        for batch in batches:
            ids_of, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            for begin, end in pieces(texts, TEXT_PIECE):
                ids, sizes = encoder.encode(texts[begin:end])
                if stream is None:
                    name = f"raw-{uuid.uuid4().hex}"
                    stream, path = opened(folder, name), f"{folder}/{name}"
                seen = np.bincount(ids)
                if len(seen) > len(counts):
                    counts = np.concatenate([counts, np.zeros(len(seen) - len(counts), np.int64)])
                counts[: len(seen)] += seen
                total += len(ids)
                narrow = "<u2" if len(seen) <= 1 << 16 else "<u4"
                head = json.dumps({"docs": ids_of[begin:end], "sizes": sizes.tolist(), "type": narrow}).encode()
                body = packer.compress(struct.pack("<I", len(head)) + head + ids.astype(narrow).tobytes())
                stream.write(struct.pack("<I", len(body)) + body)
        if stream is not None:
            stream.close()
            used = np.nonzero(counts)[0]
            yield pa.RecordBatch.from_pylist(
                [{"part": TaskContext.get().partitionId(), "path": path, "n_ids": total, "ids": used.tolist(), "counts": counts[used].tolist()}],
                schema=pa.schema([("part", pa.int32()), ("path", pa.string()), ("n_ids", pa.int64()), ("ids", pa.list_(pa.int32())), ("counts", pa.list_(pa.int64()))]),
            )

    # Equal ids may go to several tasks: the text's hash and the row's place in the input split them.
    rows = documents.select("doc_id", "text", F.xxhash64("text").alias("__hash"), F.monotonically_increasing_id().alias("__place"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("__hash"), F.col("__place")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    return materialize(ordered.mapInArrow(run, RAW), "raw-ids")


def plus(total: np.ndarray, ids: list[int], counts: list[int]) -> np.ndarray:
    """The counts per id, with those of some ids added; the array grows to the largest id."""
    if ids and max(ids) >= len(total):
        total = np.concatenate([total, np.zeros(max(ids) + 1 - len(total), np.int64)])
    total[ids] += np.array(counts, np.int64)
    return total


def summed_counts(raw: DataFrame) -> np.ndarray:
    """Counts of all files by id. Each task that reads reports adds them up; the driver gets one array per task, of the size of the
    vocabulary."""
    out = "ids array<int>, counts array<bigint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for ids, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total = plus(total, ids, counts)
        used = np.nonzero(total)[0]
        arrays = [pa.array([used.astype(np.int32)], pa.list_(pa.int32())), pa.array([total[used]], pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(arrays, ["ids", "counts"])

    total = np.zeros(0, np.int64)
    for row in raw.select("ids", "counts").mapInArrow(run, out).toLocalIterator():
        total = plus(total, row.ids, row.counts)
    return total


def raw_records(path: str) -> Iterator[tuple[list, list[int], np.ndarray]]:
    with source(path) as stream:
        while head := stream.read(4):
            body = zstandard.ZstdDecompressor().decompress(stream.read(struct.unpack("<I", head)[0]))
            size = struct.unpack_from("<I", body)[0]
            about = json.loads(body[4 : 4 + size])
            yield about["docs"], about["sizes"], np.frombuffer(body, about["type"], offset=4 + size)


def block_bytes(book: Codebook, ids: np.ndarray, docs: list[tuple[int | None, int]]) -> bytes:
    packed, checkpoints = book.encode(ids)
    body = struct.pack("<IIII", len(ids), len(docs), len(checkpoints), len(packed))
    body += np.array([d or 0 for d, _ in docs], "<i8").tobytes() + bytes(d is not None for d, _ in docs)
    body += np.array([s for _, s in docs], "<u8").tobytes() + checkpoints.astype("<u8").tobytes() + packed
    return struct.pack("<II", len(body), zlib.crc32(body)) + body


def coded(book: Codebook, records: Iterator[tuple[list, list[int], np.ndarray]], limit: int) -> Iterator[bytes]:
    """The blocks of a file, each with `limit` ids but the last."""
    held: list[np.ndarray] = []
    docs: list[tuple[int | None, int, int]] = []  # with the place after the last id, from the first held id
    count = 0

    def blocks(least: int) -> Iterator[bytes]:
        nonlocal held, docs, count
        ids = np.concatenate(held) if held else np.zeros(0, np.uint32)
        at = 0
        while len(ids) - at >= least and at < len(ids):
            end = min(at + limit, len(ids))
            yield block_bytes(book, ids[at:end], [(d, s) for d, s, e in docs if at < e <= end])
            at = end
        held, docs, count = [ids[at:]], [(d, s, e - at) for d, s, e in docs if e > at], len(ids) - at

    for ids_of, sizes, ids in records:
        docs += zip(ids_of, sizes, (count + np.cumsum(sizes)).tolist(), strict=True)
        held.append(ids)
        count += len(ids)
        if count >= limit:
            yield from blocks(limit)
    yield from blocks(1)


def write_token_files(documents: DataFrame, tokenizer_path: str | None = None, limit: int = BLOCK_IDS) -> DataFrame:
    """Write the ids of doc_id, text; the manifest (part, path, start, n_ids, n_bytes) of the files."""
    spark = documents.sparkSession
    folder = new_folder(spark, "token-files")
    raw = write_raw(documents, folder, tokenizer_path or public_tokenizers.path(TOKENIZER))
    counts = summed_counts(raw)
    symbols = np.nonzero(counts)[0].astype(np.uint32)
    lengths = code_lengths(counts[symbols], max(MAX_BITS, len(symbols).bit_length()))
    begun, parts = 0, []
    for row in sorted(raw.select("part", "path", "n_ids").toLocalIterator()):  # one row per file
        parts.append((row.part, row.path, begun, row.n_ids))
        begun += row.n_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = Codebook(symbols, lengths)
        code = {"symbols": b64encode(zlib.compress(symbols.astype("<u4").tobytes())).decode(), "lengths": b64encode(zlib.compress(lengths.tobytes())).decode()}
        for batch in batches:
            for row in batch.to_pylist():
                name = f"part-{row['part']:06d}-{uuid.uuid4().hex}.ids"
                head = json.dumps({"start": row["start"], **code}).encode()
                size = len(MAGIC) + 8 + len(head)
                with opened(folder, name) as stream:
                    stream.write(MAGIC + struct.pack("<I", len(head)) + head)
                    for block in coded(book, raw_records(row["path"]), limit):
                        stream.write(block)
                        size += len(block)
                    stream.write(struct.pack("<I", 0))
                yield pa.RecordBatch.from_pylist([row | {"path": f"{folder}/{name}", "n_bytes": size}], schema=pa.schema(
                    [("part", pa.int32()), ("path", pa.string()), ("start", pa.int64()), ("n_ids", pa.int64()), ("n_bytes", pa.int64())]))

    todo = spark.createDataFrame(parts, "part int, path string, start bigint, n_ids bigint").repartition(max(1, len(parts)))
    manifest = materialize(todo.mapInArrow(run, MANIFEST), "token-manifest")
    for _, path, _, _ in parts:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, False)
    return manifest


def documents_in(path: str) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """(doc_id, start, ids) of each document in a file. Raises ValueError for a damaged file."""
    with source(path) as stream:
        if stream.read(len(MAGIC)) != MAGIC:
            raise ValueError(f"{path}: not a token file")
        head = json.loads(stream.read(struct.unpack("<I", stream.read(4))[0]))
        unpack = lambda name, kind: np.frombuffer(zlib.decompress(b64decode(head[name])), kind)
        book, start = Codebook(unpack("symbols", "<u4"), unpack("lengths", np.uint8)), head["start"]
        rest: list[np.ndarray] = []
        while size := struct.unpack("<I", stream.read(4))[0]:
            check, body = struct.unpack("<I", stream.read(4))[0], stream.read(size)
            if len(body) != size or zlib.crc32(body) != check:
                raise ValueError(f"{path}: damaged block")
            n, d, c, b = struct.unpack_from("<IIII", body)
            read = lambda kind, count, at: np.frombuffer(body, kind, count, at)  # noqa: E731, B023
            docs, flags, sizes = read("<i8", d, 16), read(np.uint8, d, 16 + 8 * d), read("<u8", d, 16 + 9 * d)
            at = 16 + 17 * d
            ids = book.decode(body[at + 8 * c : at + 8 * c + b], n, read("<u8", c, at))
            begin = 0
            for doc, known, count in zip(docs.tolist(), flags.tolist(), sizes.tolist(), strict=True):
                end = begin + count - sum(map(len, rest))
                own = np.concatenate([*rest, ids[begin:end]]) if rest else ids[begin:end]
                rest, begin = [], end
                yield doc if known else None, start, own
                start += count
            if begin < len(ids):
                rest.append(ids[begin:])


def read_token_files(manifest: DataFrame, with_ids: bool = True) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ids) of each document in the files that the column `path` names."""
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
    schema = pa.schema(fields + [("ids", pa.list_(pa.int32()))] * with_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, held = [], 0
                for doc, start, ids in documents_in(path):
                    rows.append((doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), *([ids.astype(np.int32)] * with_ids)))
                    held += len(ids) * with_ids
                    if len(rows) >= ROWS_AT_ONCE or held >= BLOCK_IDS:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    files = manifest.count()
    out = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids
    return manifest.select("path").repartition(max(1, files)).mapInArrow(run, out)
