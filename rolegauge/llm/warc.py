"""WARC archives with Zstandard: one frame per record, the dictionary in a leading skippable frame.

Writer: each Spark task writes whole archives of its own into the shared folder, through the file system that the folder's URI names.
File names are new in every attempt; the manifest, written by Spark, names only files of successful tasks. A task that runs again leaves
an orphan at worst, never a doubled record. Only the first records of an archive (at most DICTIONARY_RECORDS) train its dictionary.

Reader: one frame is decoded at a time. A record is checked for its version line, required fields, Content-Length against the bytes
there, closing line ends, and both digests. What fails becomes a row with `error`; damage inside a frame ends that archive with an
error row, since the next frame's place is then unknown.

Deduplication: of equal payloads of at least DEDUP_BYTES the one with the largest page_id is stored, others become revisit records. A
null page_id is never the stored one while another exists. Rows that repeat that page_id are all stored. A null html is an empty payload;
a null url becomes a urn. Extra columns are not read. An empty table gives no archive and no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rolegauge.storage import materialize, new_folder

DEDUP_BYTES = 1000
ARCHIVE_BYTES = 64 << 20
DICTIONARY_BYTES, DICTIONARY_RECORDS, DICTIONARY_SAMPLE = 32 << 10, 400, 4 << 20
READ_BYTES = 1 << 20
ROWS_BYTES = 8 << 20

# Fixed values of the formats.
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE_FIRST, SKIPPABLE_LAST = 0x184D2A50, 0x184D2A5F
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
REQUIRED = ("warc-record-id", "content-length", "warc-date", "warc-type")

MANIFEST = "path string, n_records bigint, n_bytes bigint"
RECORDS = (
    "path string, place bigint, page_id bigint, record_type string, record_id string, target_uri string, date string, "
    "payload_digest string, payload_bytes bigint, refers_to bigint, payload binary, error string"
)
RECORD_SCHEMA = pa.schema(
    [("path", pa.string()), ("place", pa.int64()), ("page_id", pa.int64()), ("record_type", pa.string()), ("record_id", pa.string()),
     ("target_uri", pa.string()), ("date", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()),
     ("refers_to", pa.int64()), ("payload", pa.binary()), ("error", pa.string())]
)


def digest_field(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def digest_hex(field: str) -> str | None:
    """The hexadecimal form of a sha1 field in base 32 or base 16; None if it is neither."""
    text = field.removeprefix("sha1:")
    try:
        return base64.b32decode(text).hex() if len(text) == 32 else bytes.fromhex(text).hex() if len(text) == 40 else None
    except ValueError:
        return None


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'page {page_id}')}>"


def record_bytes(page_id, url, digest, size, kind, refers_to, payload, date: str) -> bytes:
    """One record. A revisit holds the HTTP head only; its digest and length are those of the full payload."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    block = head + (payload if kind == "response" else b"")
    target = quote(url, safe="!#$%&'()*+,/:;=?@[]~") if url else f"urn:page:{page_id}"
    fields = [
        ("WARC-Type", kind), ("WARC-Record-ID", record_id(page_id)), ("WARC-Date", date), ("WARC-Target-URI", target),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()), ("WARC-Block-Digest", digest_field(block)),
        ("Content-Type", "application/http; msgtype=response"), ("X-Payload-Length", str(size)),
    ]
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    if kind == "revisit":
        fields += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", record_id(refers_to)), ("X-Refers-To-Page-ID", str(refers_to)),
        ]
    fields.append(("Content-Length", str(len(block))))
    lines = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in fields) + "\r\n"
    return lines.encode() + block + b"\r\n\r\n"


def trained(samples: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """A dictionary, or None where there is too little to train on."""
    if len(samples) < 16 or sum(map(len, samples)) < 8 * DICTIONARY_BYTES:
        return None
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=256, d=8)
    except zstandard.ZstdError:
        return None


class Archive:
    """One file being written."""

    def __init__(self, folder: str, samples: list[bytes]):
        files, root = pyarrow.fs.FileSystem.from_uri(folder)
        files.create_dir(root, recursive=True)
        name = f"records-{uuid.uuid4().hex}.warc.zst"
        self.path, self.records, self.size = f"{folder}/{name}", 0, 0
        self.stream = files.open_output_stream(f"{root}/{name}", compression=None)
        dictionary = trained(samples)
        if dictionary:
            body = zstandard.ZstdCompressor(level=9).compress(dictionary.as_bytes())
            self.put(struct.pack("<II", DICTIONARY_MAGIC, len(body)) + body)
        self.frames = zstandard.ZstdCompressor(level=3, dict_data=dictionary, write_checksum=True, write_content_size=True)

    def put(self, data: bytes) -> None:
        self.stream.write(data)
        self.size += len(data)

    def add(self, record: bytes) -> None:
        self.put(self.frames.compress(record))
        self.records += 1

    def close(self) -> tuple[str, int, int]:
        self.stream.close()
        return self.path, self.records, self.size


def archives(records: Iterator[bytes], folder: str, limit: int) -> Iterator[tuple[str, int, int]]:
    """Write the records, a new file whenever one is full; (path, records, bytes) of each."""
    waiting: list[bytes] = []
    held, archive = 0, None
    for record in records:
        if archive is None:
            waiting.append(record)
            held += len(record)
            if len(waiting) < DICTIONARY_RECORDS and held < DICTIONARY_SAMPLE:
                continue
            archive = Archive(folder, waiting)
            for one in waiting:
                archive.add(one)
            waiting, held = [], 0
        else:
            archive.add(record)
        if archive.size >= limit:
            yield archive.close()
            archive = None
    if waiting:
        archive = Archive(folder, waiting)
        for one in waiting:
            archive.add(one)
    if archive:
        yield archive.close()


def with_revisits(pages: DataFrame) -> DataFrame:
    """page_id, url, digest, size, kind, refers_to, payload (null for a revisit). One shuffle by digest; the pages' side is a plain left
    side, so a digest that many pages share is split by adaptive execution."""
    rows = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    rows = rows.select("page_id", "url", F.sha1("payload").alias("digest"), F.octet_length("payload").cast("bigint").alias("size"), "payload")
    stored = rows.where(F.col("size") >= DEDUP_BYTES).groupBy("digest").agg(F.max("page_id").alias("stored_id"))
    again = F.col("page_id").isNull() | (F.col("page_id") != F.col("stored_id"))
    revisit = F.col("stored_id").isNotNull() & again
    return rows.join(stored, "digest", "left").select(
        "page_id", "url", "digest", "size",
        F.when(revisit, "revisit").otherwise("response").alias("kind"),
        F.when(revisit, F.col("stored_id")).alias("refers_to"),
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def write_archives(pages: DataFrame, date: str = "2000-01-01T00:00:00Z", limit: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record per row of pages (page_id, url, html); the manifest of the archives."""
    folder = new_folder(pages.sparkSession, "warc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records = (record_bytes(*row.values(), date) for batch in batches for row in batch.to_pylist())
        for path, count, size in archives(records, folder, limit):
            yield pa.RecordBatch.from_pylist([{"path": path, "n_records": count, "n_bytes": size}])

    return materialize(with_revisits(pages).mapInArrow(run, MANIFEST), "warc-manifest")


def frames(stream) -> Iterator[tuple[int, bytes | None, str]]:
    """(place of the frame, its content or None, error) for each frame of an archive."""
    data, place = stream.read(READ_BYTES), 0

    def fill(least: int) -> bool:
        nonlocal data
        while len(data) < least and (more := stream.read(READ_BYTES)):
            data += more
        return len(data) >= least

    decoder = zstandard.ZstdDecompressor()
    while fill(1):
        if not fill(4):
            yield place, None, "truncated frame"
            return
        magic = struct.unpack_from("<I", data)[0]
        if SKIPPABLE_FIRST <= magic <= SKIPPABLE_LAST:
            size = struct.unpack_from("<I", data, 4)[0] if fill(8) else -1
            if size < 0 or not fill(8 + size):
                yield place, None, "truncated skippable frame"
                return
            if magic == DICTIONARY_MAGIC and place == 0:
                body = data[8 : 8 + size]
                try:
                    raw = zstandard.ZstdDecompressor().decompress(body, max_output_size=64 << 20) if body[:4] == FRAME_MAGIC else body
                    decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw))
                except zstandard.ZstdError as error:
                    yield place, None, f"dictionary: {error}"
                    return
            data, place = data[8 + size :], place + 8 + size
            continue
        one, content, used = decoder.decompressobj(), [], 0
        try:
            while True:
                content.append(one.decompress(data))
                used += len(data) - len(one.unused_data)
                if one.eof:
                    break
                data = stream.read(READ_BYTES)
                if not data:
                    yield place, None, "truncated frame"
                    return
        except zstandard.ZstdError as error:
            yield place, None, f"frame: {error}"
            return
        data = one.unused_data
        yield place, b"".join(content), ""
        place += used


def parsed(record: bytes) -> dict:
    """The checked fields of one record; `error` names the first fault."""
    head, gap, rest = record.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not gap or not re.fullmatch(r"WARC/1\.[01]", lines[0]):
        return {"error": "no version line"}
    if any(":" not in line for line in lines[1:]):
        return {"error": "bad field line"}
    fields = {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines[1:])}
    missing = [name for name in REQUIRED if name not in fields]
    if missing:
        return {"error": f"no {missing[0]}"}
    number = lambda name: int(fields[name]) if re.fullmatch(r"-?[0-9]{1,18}", fields.get(name, "")) else None
    found = {
        "page_id": number("x-page-id"), "record_type": fields["warc-type"], "record_id": fields["warc-record-id"], "date": fields["warc-date"],
        "target_uri": fields.get("warc-target-uri"), "refers_to": number("x-refers-to-page-id"), "payload_bytes": number("x-payload-length"),
        "payload_digest": digest_hex(fields.get("warc-payload-digest", "")),
    }
    length = number("content-length")
    if length is None or length < 0 or len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        return found | {"error": "content length"}
    block = rest[:length]
    if (said := fields.get("warc-block-digest")) and digest_hex(said) != hashlib.sha1(block).hexdigest():
        return found | {"error": "block digest"}
    if fields["warc-type"] == "response":
        payload = block.partition(b"\r\n\r\n")[2] if fields.get("content-type", "").startswith("application/http") else block
        own = hashlib.sha1(payload).hexdigest()
        if found["payload_digest"] not in (None, own):
            return found | {"error": "payload digest"}
        if found["payload_bytes"] not in (None, len(payload)):
            return found | {"error": "payload length"}
        found |= {"payload": payload, "payload_digest": own, "payload_bytes": len(payload)}
    return found


def records_of(path: str) -> Iterator[dict]:
    files, at = pyarrow.fs.FileSystem.from_uri(path)
    with files.open_input_stream(at, compression=None) as stream:
        for place, content, error in frames(stream):
            yield {"path": path, "place": place} | (parsed(content) if content is not None else {"error": error})


def read_archives(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """A row for each record of the archives that the column `path` names; faults have `error`. An archive is one task's work."""
    files = manifest.count()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, held = [], 0
                for row in records_of(path):
                    held += len(row.get("payload") or b"") + 500
                    if not payloads:
                        row.pop("payload", None)
                    rows.append(row)
                    if held >= ROWS_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema=RECORD_SCHEMA)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=RECORD_SCHEMA)

    return manifest.select("path").repartition(max(1, files)).mapInArrow(run, RECORDS)
