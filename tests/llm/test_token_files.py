"""Codes, pieces against whole-text encoding, and the files' round trip."""

import heapq
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from rolegauge.llm import tokenizing
from rolegauge.llm import token_files as T
from rolegauge.llm.huffman import CHECKPOINT, Codebook, code_lengths
from rolegauge.llm.tokenizing import PieceEncoder, cut

PATH = public_tokenizers.path(T.TOKENIZER)


def optimal_cost(counts):
    heap, cost = list(counts), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        cost += both
        heapq.heappush(heap, both)
    return cost


def test_lengths():
    rng = np.random.default_rng(3)
    for n in (2, 3, 10, 500):
        counts = (rng.pareto(0.7, n) * 20 + 1).astype(np.int64)
        free = code_lengths(counts, 40).astype(int)
        assert (counts * free).sum() == optimal_cost(counts.tolist())
        tight = code_lengths(counts, max(1, int(np.ceil(np.log2(n))) + 1)).astype(int)
        assert tight.max() <= np.ceil(np.log2(n)) + 1 and (0.5**tight).sum() <= 1 and (counts * tight).sum() >= (counts * free).sum()
    assert code_lengths(np.array([5])).tolist() == [1] and len(code_lengths(np.array([], np.int64))) == 0


def test_codebook_round_trip():
    rng = np.random.default_rng(4)
    symbols = np.unique(rng.integers(0, 50_000, 3000))
    ids = symbols[np.minimum((rng.pareto(0.8, 30_001) * 5).astype(int), len(symbols) - 1)]
    book = Codebook(symbols, code_lengths(np.bincount(np.searchsorted(symbols, ids), minlength=len(symbols)) + 1))
    for count in (0, 1, CHECKPOINT, CHECKPOINT + 1, len(ids)):
        packed, checkpoints = book.encode(ids[:count])
        assert (book.decode(packed, count, checkpoints) == ids[:count]).all()
    assert len(packed) < 2 * len(ids)
    with pytest.raises(ValueError):
        book.decode(packed[: len(packed) // 2], len(ids), checkpoints)
    with pytest.raises(ValueError):
        book.decode(packed, len(ids), checkpoints + np.uint64(1))


def test_pieces_equal_whole_texts():
    rng = random.Random(6)
    whole = Tokenizer.from_file(PATH)
    parts = ["word", "Über", " ", " ", "  ", "\n", "\t", "'s", "don't", "123", "!?", "é", " ", " ", "漢字", "\x1c", "<|endoftext|>", "🙂", "a b", "_", "one two\nthree", "\n"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(800)] + ["", " ", "a", " a ", "x" * 5000]
    assert all("".join(cut(t)) == t for t in texts)
    encoder = PieceEncoder(PATH, 2)
    for begin in range(0, len(texts), 200):
        ids, sizes = encoder.encode(texts[begin : begin + 200])
        at = 0
        for text, size in zip(texts[begin : begin + 200], sizes, strict=True):
            assert ids[at : at + size].tolist() == [*whole.encode(text, add_special_tokens=False).ids, 2], repr(text)
            at += size
        assert at == len(ids)


@pytest.mark.parametrize("limit", [T.BLOCK_IDS, 700])
def test_files(spark, folder, limit):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    rows = [(r.doc_id * 3 - 100, r.text) for r in docs] + [(7_000, None), (7_001, ""), (2, "again"), (2, "again"), (None, "no id"), (9_000, "x y " * 3000)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame([(*r, "k") for r in rows], "doc_id bigint, text string, start string").repartition(5)
    manifest = T.write_token_files(df, limit=limit)
    found = T.read_token_files(manifest).collect()
    whole = Tokenizer.from_file(PATH)
    ids = lambda text: [*whole.encode(text or "", add_special_tokens=False).ids, 2]
    key = lambda doc: -(10**9) if doc is None else doc
    got = sorted(found, key=lambda r: r.start)
    assert [key(r.doc_id) for r in got] == sorted(key(d) for d, _ in rows)
    assert sorted((key(r.doc_id), tuple(r.ids)) for r in got) == sorted((key(d), tuple(ids(t))) for d, t in rows)
    at = 0
    for r in got:
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(r.ids), zlib.crc32(np.array(r.ids, "<u4").tobytes()))
        at += r.n_tokens
    assert sum(r.n_ids for r in manifest.collect()) == at


def test_empty_and_damaged(spark, tmp_path):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert T.read_token_files(T.write_token_files(df)).collect() == []
    one = T.write_token_files(spark.createDataFrame([(1, "some words here")], df.schema)).first().path.removeprefix("file://")
    data = bytearray(open(one, "rb").read())
    data[-6] ^= 1
    (tmp_path / "bad").write_bytes(data)
    with pytest.raises(ValueError):
        list(T.documents_in(f"file://{tmp_path}/bad"))


def test_known_pieces_stay_when_the_room_is_full(monkeypatch):
    monkeypatch.setattr(tokenizing, "KNOWN_PIECES", 60)
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder, whole = tokenizing.PieceEncoder(path, 2), tokenizing.tokenizer(path)
    for n in range(40):
        texts = [f"the common words, and w{n} v{n + i}.\nthe x{n * i}" for i in range(4)] + [f"odd  {n} the\t", ""]
        ids, sizes = encoder.encode(texts)
        want = [[*whole.encode(t, add_special_tokens=False).ids, 2] for t in texts]
        assert sizes.tolist() == list(map(len, want)) and ids.tolist() == sum(want, [])
        assert len(encoder.size) < 120
    assert "common" in encoder.after_blank
