"""The pipeline against plain versions of its stages on the smallest tables."""

import sys
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

import corpus_pipeline
from rolegauge.llm import tokenizing
from rolegauge.llm.batches import map_texts
from rolegauge.llm.mixing import mixed
from rolegauge.llm.quality import quality_rules
from rolegauge.llm.shingles import words_of
from rolegauge.llm.token_files import write_token_files


def grams(text, least=1):
    words = words_of(text or "")
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    items = [grams(r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    kept = {r.doc_id for r in quality_rules(docs, labels).collect() if r.kept}
    rows = sorted((r.doc_id, r.text) for r in docs.collect() if r.doc_id in kept)
    sets = {d: grams(t) for d, t in rows}
    group = {d: d for d, _ in rows}
    for a, _ in rows:
        for b, _ in rows:
            if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                low, high = sorted((group[a], group[b]))
                group = {d: low if g == high else g for d, g in group.items()}
    left = [d for d, _ in rows if group[d] == d]
    left = [d for d in left if not any(i and len(i & sets[d]) >= 0.8 * len(i) for i in items)]
    drawn = {r.doc_id for r in mixed(docs.where(docs.doc_id.isin(left))).where("__drawn").collect()}
    tokenizer, start, want = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0, []
    for d, text in rows:
        if d in drawn:
            ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 2], "<u4")
            want.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
            start += len(ids)
    got = sorted(map(tuple, corpus_pipeline.run(spark, folder).collect()))
    assert got == want and 10 < len(want) < len(left) < len(rows) < docs.count()


def test_stages_keep_columns_and_bear_empty_tables(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns and out.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() == 0


def test_entry_registers_everything():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert "pipeline" in names and all(any(q.startswith(f"op{n}_") for q in names) for n in range(1, 11))
    assert set(entry.oracle_sql()) <= names


def test_known_pieces_do_not_stay_beside_other_steps(spark, folder):
    """Workers serve all stages: what encoding tokens left in a worker is gone when a task of another step works there."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").repartition(8)

    def encoders(batches):
        for batch in batches:
            known = sys.modules.get("rolegauge.llm.tokenizing")
            yield pa.RecordBatch.from_pydict({"n": pa.array([known.piece_encoder.cache_info().currsize if known else 0] * batch.num_rows, pa.int32())})

    write_token_files(docs).count()
    assert 1 in {r.n for r in docs.select("doc_id").mapInArrow(encoders, "n int").collect()}
    held = map_texts(docs, "n int", lambda carried, texts: [[tokenizing.piece_encoder.cache_info().currsize] * len(texts)], [])
    assert {r.n for r in held.collect()} == {0}
