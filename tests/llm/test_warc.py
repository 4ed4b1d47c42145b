"""Archives: round trip, revisit rule, dictionary frame, and damaged records."""

import hashlib
import random
import struct

import pyarrow.fs
import pytest
import zstandard

from rolegauge.llm.warc import DICTIONARY_MAGIC, parsed, read_archives, record_bytes, records_of, write_archives

WORDS = "<p> the of and thereof </p> <div> page is one".split()


def page(rng, words):
    return "".join(f"<a>{rng.choice(WORDS)}{rng.random()}</a>" for _ in range(words))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    same, small = page(rng, 80), "tiny"
    rows = [(i, f"http://x/{i}", page(rng, 60)) for i in range(150)]
    rows += [(200 + i, "http://y/\r\nz é", same) for i in range(30)] + [(300, None, small), (301, "u", small), (302, "u", None), (303, "u", "")]
    return rows + [(229, "http://y", same), (None, "n", same), (None, "n", small), (400, "u", "é" * 500)]


def expected(rows):
    best = {}
    for i, _, html in rows:
        if i is not None and len((html or "").encode()) >= 1000:
            best[html] = max(best.get(html, i), i)
    for i, _, html in rows:
        body = (html or "").encode()
        again = html in best and best[html] != i
        yield i, len(body), hashlib.sha1(body).hexdigest(), "revisit" if again else "response", best[html] if again else None


def test_round_trip(spark, rows):
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id bigint, url string, html string, payload string")
    manifest = write_archives(df.coalesce(2), limit=20_000)
    found = read_archives(manifest).collect()
    assert len({r.path for r in found}) == manifest.count() and not [r for r in found if r.error]
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found]
    assert sorted(got, key=str) == sorted(expected(rows), key=str)
    bodies = {(i, (h or "").encode()) for i, _, h in rows}
    assert all((r.page_id, r.payload) in bodies for r in found if r.record_type == "response")


def test_dictionary_comes_first(spark, rows):
    df = spark.createDataFrame(rows * 2, "page_id bigint, url string, html string").coalesce(1)
    starts = []
    for path in [r.path for r in write_archives(df).collect()]:
        files, at = pyarrow.fs.FileSystem.from_uri(path)
        starts.append(files.open_input_stream(at, compression=None).read(4))
    assert struct.pack("<I", DICTIONARY_MAGIC) in starts


def test_empty_table(spark):
    df = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert read_archives(write_archives(df)).collect() == []


def test_faults(tmp_path):
    body = b"x" * 1200
    good = record_bytes(1, "http://a", hashlib.sha1(body).hexdigest(), len(body), "response", None, body, "2000-01-01T00:00:00Z")
    assert "error" not in parsed(good)
    assert parsed(good[:-4])["error"] == "content length"
    assert parsed(good.replace(b"WARC/1.1", b"HTTP/1.1", 1))["error"] == "no version line"
    assert parsed(good.replace(b"WARC-Date", b"WARC-Dat_", 1))["error"] == "no warc-date"
    assert parsed(good.replace(b"x" * 1200, b"y" * 1200))["error"] == "block digest"
    frame = zstandard.ZstdCompressor(write_checksum=True).compress(good)
    (tmp_path / "a.warc.zst").write_bytes(struct.pack("<II", 0x184D2A53, 3) + b"abc" + frame + frame[:-9])
    rows = list(records_of(f"file://{tmp_path}/a.warc.zst"))
    assert [r.get("error") for r in rows] == [None, "truncated frame"] and rows[0]["place"] == 11
    (tmp_path / "b.warc.zst").write_bytes(frame + b"junk" + frame)
    assert [bool(r.get("error")) for r in records_of(f"file://{tmp_path}/b.warc.zst")] == [False, True]
