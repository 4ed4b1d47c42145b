"""Work on Arrow batches in Python tasks: pieces of bounded size, and columns chosen by name."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

PIECE_CHARS = 4_000_000


def forget_pieces() -> None:
    """Called where a task begins that encodes no tokens. A worker serves all steps of a job, and the known pieces of `tokenizing.piece_encoder`,
    the one thing that outlives a task, would else lie beside what later steps need."""
    tokenizing = sys.modules.get("rolegauge.llm.tokenizing")
    if tokenizing is not None:
        tokenizing.piece_encoder.cache_clear()
    pa.default_memory_pool().release_unused()


def pieces(texts: list[str], limit: int = PIECE_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts have about `limit` characters together; a longer text is a piece of its own."""
    begin, held = 0, 0
    for i, text in enumerate(texts):
        if held and held + len(text) > limit:
            yield begin, i
            begin, held = i, 0
        held += len(text)
    if begin < len(texts):
        yield begin, len(texts)


def map_texts(df: DataFrame, schema: str, work: Callable[[list[list], list[str]], list], carry: list[str], text: str = "text") -> DataFrame:
    """`work(carried columns, texts)` for each piece, row work without a shuffle. It returns the output columns as lists or arrays.
    A null text reaches it as an empty one."""
    chosen = df.select(*[df[c] for c in carry], df[text].cast("string").alias("__text"))
    types = chosen.sparkSession.createDataFrame([], schema).schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(types)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_pieces()
        for batch in batches:
            texts = [t or "" for t in batch.column(len(carry)).to_pylist()]
            for begin, end in pieces(texts):
                part = [batch.column(i).slice(begin, end - begin).to_pylist() for i in range(len(carry))]
                columns = work(part, texts[begin:end])
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return chosen.mapInArrow(run, types)
