"""Phrase collocation mining: the best scored phrases of each language by best-first branch-and-bound growth.

Texts are lower-cased (A-Z), cut into pieces at SEPARATORS and into words at blanks and tabs. Per language, f(phrase) counts all places of a
phrase inside pieces. Candidates are phrases of 2 to LONGEST words with a = f(phrase) >= LEAST; a cut into its first k and its other words
has the score floor(SCALE * a / (f(first) + f(rest))), and the lowest cut counts (ties: the smallest k). A candidate goes if a longer one
that contains it has at least SHARE percent of its count. The TOP best of each language are returned.

Growth. Words and pairs of frequent words are counted first. A phrase q whose first word is w has the bound floor(SCALE * f(q) / (f(w) + f(q))): a
phrase that begins with q is not more frequent than q, and what follows w in it is at least as frequent as the phrase, so neither its score
nor its own bound is above. Expanding q counts all phrases of one more word at either end; the phrases that can remove q are among them,
as a longer phrase is no more frequent than the part of it that is one word longer than q. In each round the frontier is expanded down to
the score of rank AHEAD * TOP, in one pass over the texts, until in every language nothing that is not expanded has a bound as high as the
score of rank TOP (0 if fewer survive). Then all survivors with that score or more are known, ties included, and settled.

The phrases to expand reach the tasks as bit filters of FILTER_BITS bits, whatever their number: a phrase outside that passes a filter is counted
too, exactly, and does no harm. Each task counts pieces of bounded size with numpy; equal phrases are added up before the shuffle. What the
driver gets are filters. Scores are computed in decimals.

A null language is `und` (and one with the `und` rows); null and empty texts have no words. Repeated rows count as often as they stand
there. Ties are ordered by count, then by phrase in the order of its UTF-8 bytes. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rolegauge.llm.batches import pieces
from rolegauge.llm.shingles import FACTORS, mixed
from rolegauge.storage import materialize

LEAST, LONGEST, SCALE, SHARE, TOP = 30, 4, 2_000_000, 80, 2000
AHEAD = 2
PIECE_BYTES = 8_000_000
FILTER_BITS, PROBES, SLICE = 1 << 25, 4, 1 << 15
SEPARATORS = b".,;:!?\n\x0b\x0c\r"
#: A-Z in lower case, all separators as the first one; after that only blanks and tabs are white space.
PREPARED = bytes(ord(".") if b in SEPARATORS else b + 32 if 65 <= b <= 90 else b for b in range(256))
COUNTS = "lang string, phrase string, n bigint"


def word_hashes(words: list[bytes], lang: str) -> np.ndarray:
    seed = xxhash.xxh3_64_intdigest(lang.encode())
    return np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in words), np.uint64, len(words))


def phrase_hashes(words: list[np.ndarray]) -> np.ndarray:
    """One hash for each phrase, from the hashes of its first, second, ... words."""
    return mixed(sum(h * factor for h, factor in zip(words, FACTORS, strict=False)) + np.uint64(len(words)))


def places(hashes: np.ndarray) -> list[np.ndarray]:
    """The bits of each hash in a filter."""
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    return [((hashes + step * np.uint64(i)) & np.uint64(FILTER_BITS - 1)).astype(np.int64) for i in range(PROBES)]


def passes(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    found = np.ones(len(hashes), bool)
    for at in places(hashes):
        found &= (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
    return found


def filter_bits(phrases: DataFrame) -> np.ndarray:
    """The filter of (lang, phrase) rows: FILTER_BITS / SLICE rows at most reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_kind: dict[tuple, list[list[bytes]]] = {}
            for lang, phrase in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = phrase.encode().split(b" ")
                by_kind.setdefault((lang, len(words)), []).append(words)
            for (lang, _), rows in by_kind.items():
                at = np.concatenate(places(phrase_hashes([word_hashes(list(column), lang) for column in zip(*rows, strict=True)])))
                yield pa.RecordBatch.from_arrays([pa.array(at // SLICE, pa.int32()), pa.array(at % SLICE, pa.int64())], ["slice", "bit"])

    found = phrases.select("lang", "phrase").mapInArrow(run, "slice int, bit bigint").groupBy("slice").agg(F.bitmap_construct_agg("bit").alias("bits"))
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    for row in found.collect():
        bits[row.slice * SLICE // 8 : (row.slice + 1) * SLICE // 8] = np.frombuffer(row.bits, np.uint8)
    return bits


def distinct(columns: list[np.ndarray], room: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the first of equal rows, and how often each stands there. Values are below `room`."""
    key, most = columns[0].astype(np.int64), room
    for column in columns[1:]:
        if most * room >= 1 << 62:
            values, key = np.unique(key, return_inverse=True)
            most = len(values)
        key, most = key * room + column, most * room
    _, first, count = np.unique(key, return_index=True, return_counts=True)
    return first, count


class Piece:
    """The words of some texts of one language."""

    def __init__(self, lang: str, texts: list[bytes]):
        self.lang = lang
        tokens = b".".join(texts).translate(PREPARED).replace(b".", b" . ").split()
        coded = pa.array(tokens, pa.binary()).dictionary_encode()
        self.words, self.ids = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.ends = pc.equal(self.words, pa.scalar(b".")).to_numpy(zero_copy_only=False).astype(bool)

    def word_counts(self) -> pa.RecordBatch:
        """Counts of the words; the row without a phrase has their sum."""
        count = np.bincount(self.ids, minlength=len(self.words))
        own = np.nonzero(~self.ends)[0]
        names = pa.concat_arrays([self.words.take(pa.array(own)).cast(pa.string()), pa.nulls(1, pa.string())])
        return self.rows(names, np.append(count[own], count[own].sum()))

    def grown(self, frequent: np.ndarray, frontier: dict[int, np.ndarray | None]) -> Iterator[pa.RecordBatch]:
        """Counts of phrases of frequent words: those one word longer, at either end, than a phrase in the filter of its size (None: all)."""
        hashes = word_hashes(self.words.to_pylist(), self.lang)
        live = (passes(frequent, phrase_hashes([hashes])) & ~self.ends)[self.ids] if len(self.ids) else np.zeros(0, bool)
        by_word = hashes[self.ids]
        for size, bits in frontier.items():
            n = len(self.ids) - size
            if n <= 0:
                continue
            whole = np.logical_and.reduce([live[i : i + n] for i in range(size + 1)])
            at = np.nonzero(whole)[0]
            if bits is not None:
                shorter = np.unique(np.concatenate([at, at + 1]))
                inside = np.zeros(n + 1, bool)
                inside[shorter] = passes(bits, phrase_hashes([by_word[shorter + i] for i in range(size)]))
                at = at[inside[at] | inside[at + 1]]
            if len(at):
                columns = [self.ids[at + i] for i in range(size + 1)]
                first, count = distinct(columns, len(self.words))
                names = pc.binary_join_element_wise(*[self.words.take(pa.array(c[first])) for c in columns], b" ")
                yield self.rows(names.cast(pa.string()), count)

    def rows(self, names: pa.Array, count: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([self.lang] * len(names), pa.string()), names, pa.array(count, pa.int64())], ["lang", "phrase", "n"])


def counted(documents: DataFrame, frequent: np.ndarray | None = None, frontier: dict[int, np.ndarray | None] | None = None) -> DataFrame:
    """(lang, phrase, n): the words of all texts, or the grown phrases."""
    context = documents.sparkSession.sparkContext
    sent = context.broadcast((frequent, frontier))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, grow = sent.value
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()
            for begin, end in pieces(texts, PIECE_BYTES):
                by_lang: dict[str, list[bytes]] = {}
                for lang, text in zip(langs[begin:end], texts[begin:end], strict=True):
                    by_lang.setdefault(lang, []).append(text)
                for lang, own in by_lang.items():
                    piece = Piece(lang, own)
                    if grow is None:
                        yield piece.word_counts()
                    else:
                        yield from piece.grown(known, grow)

    rows = documents.select(F.coalesce(documents["lang"].cast("string"), F.lit("und")).alias("lang"), F.coalesce(documents["text"].cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(run, COUNTS).groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def first_words(phrase: Column, k: Column | int) -> Column:
    return F.array_join(F.slice(F.split(phrase, " "), F.lit(1), k if isinstance(k, Column) else F.lit(k)), " ")


def last_words(phrase: Column, skipped: Column) -> Column:
    words = F.split(phrase, " ")
    return F.array_join(F.slice(words, skipped + 1, F.size(words)), " ")


def scored(grams: DataFrame, words: DataFrame) -> DataFrame:
    """(lang, phrase, size, a, l, r, score) of the phrases all of whose parts are known."""
    known = words.unionByName(grams.select("lang", "phrase", "a"))
    cuts = grams.select("lang", "phrase", "size", "a", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.withColumns({"left": first_words(F.col("phrase"), F.col("k")), "right": last_words(F.col("phrase"), F.col("k"))})
    side = lambda part, count: known.select("lang", F.col("phrase").alias(part), F.col("a").alias(count))
    cuts = cuts.join(side("left", "l"), ["lang", "left"]).join(side("right", "r"), ["lang", "right"])
    cuts = cuts.withColumn("score", F.expr(f"(cast(a as decimal(20,0)) * {SCALE}BD) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))"))
    least = F.min(F.struct("score", "k", "l", "r"))
    best = cuts.groupBy("lang", "phrase", "size", "a").agg(least.alias("least"), F.count("*").alias("cuts")).where("cuts = size - 1")
    return best.select("lang", "phrase", "size", "a", "least.l", "least.r", "least.score")


def survivors(grams: DataFrame, words: DataFrame) -> DataFrame:
    """The scored phrases that no known longer phrase removes."""
    longer = grams.where("size > 2").select("lang", "phrase", "size", "a")
    inner = F.array(first_words(F.col("phrase"), F.col("size") - 1), last_words(F.col("phrase"), F.lit(1)))
    held = longer.select("lang", F.explode(inner).alias("phrase"), F.col("a").alias("more")).groupBy("lang", "phrase").agg(F.max("more").alias("more"))
    out = scored(grams, words).join(held, ["lang", "phrase"], "left")
    return out.where(f"more IS NULL OR 100BD * cast(more as decimal(20,0)) < {SHARE}BD * cast(a as decimal(20,0))").drop("more")


def ranked(found: DataFrame, top: int) -> DataFrame:
    """The first rows of each language with their rank; tasks pass on `top` rows of a language at most."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def with_bounds(grams: DataFrame, words: DataFrame) -> DataFrame:
    """Phrases that can grow, with their bound."""
    heads = words.select("lang", F.col("phrase").alias("head"), F.col("a").alias("of_head"))
    nodes = grams.where(F.col("size") < LONGEST).withColumn("head", F.substring_index("phrase", " ", 1)).join(heads, ["lang", "head"])
    bound = F.expr(f"(cast(a as decimal(20,0)) * {SCALE}BD) div (cast(of_head as decimal(20,0)) + cast(a as decimal(20,0)))")
    return nodes.select("lang", "phrase", "size", bound.alias("bound"))


def frequent_phrases(counts: DataFrame, least: int) -> DataFrame:
    return counts.where(F.col("n") >= least).select("lang", "phrase", F.size(F.split("phrase", " ")).alias("size"), F.col("n").alias("a"))


def next_limits(limits: DataFrame, found: DataFrame, top: int) -> DataFrame:
    """(lang, t2, t3, tau, t): t2 and t3 are the bounds down to which phrases of two and three words are expanded (null: none yet), tau the
    score of rank `top`, t the bound down to which the next pass goes."""
    at = lambda rank: F.coalesce(F.max(F.when(F.col("rank") == rank, F.col("score"))), F.lit(0))
    now = ranked(found, AHEAD * top).groupBy("lang").agg(at(top).alias("tau"), at(AHEAD * top).alias("t"))
    return limits.select("lang", "t2", "t3").join(now, "lang", "left").select("lang", "t2", "t3", F.coalesce("tau", F.lit(0)).alias("tau"), F.coalesce("t", F.lit(0)).alias("t"))


def mine_phrases(documents: DataFrame, top: int = TOP, least: int = LEAST) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the best phrases of each language."""
    counts = materialize(counted(documents).where((F.col("n") >= least) | F.col("phrase").isNull()), "word-counts")
    words = counts.where("phrase IS NOT NULL").select("lang", "phrase", F.col("n").alias("a"))
    totals = counts.where("phrase IS NULL").select("lang", "n")
    frequent = filter_bits(words)
    grams = materialize(frequent_phrases(counted(documents, frequent, {1: None}), least), "phrases")
    limits = materialize(totals.select("lang", F.lit(None).cast("bigint").alias("t2"), F.lit(None).cast("bigint").alias("t3")), "limits")
    while True:
        found = materialize(survivors(grams, words), "survivors")
        limits = materialize(next_limits(limits, found, top), "limits")
        if not limits.where("t2 IS NULL OR t3 IS NULL OR t2 > tau OR t3 > tau").head(1):
            break
        grams, limits = grow(documents, frequent, grams, words, limits, least)
    out = ranked(found, top).join(totals, "lang")
    return out.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def grow(documents: DataFrame, frequent: np.ndarray, grams: DataFrame, words: DataFrame, limits: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """One pass over the texts: the phrases known after it, and the limits that hold then. Phrases of three words are complete down to t2, so
    they are expanded no further down than that."""
    # A language that is settled goes no further down.
    open_ = F.expr("t2 IS NULL OR t3 IS NULL OR t2 > tau OR t3 > tau")
    to2 = F.when(open_ & (F.col("t2").isNull() | (F.col("t2") > F.col("tau"))), F.least("t", F.coalesce("t2", "t"))).otherwise(F.col("t2"))
    to3 = F.when(open_, F.greatest("t", "t2")).otherwise(F.col("t3"))
    to3 = F.when(F.col("t2").isNull(), F.lit(None)).otherwise(F.least(to3, F.coalesce("t3", to3)))
    after = materialize(limits.select("lang", "t2", "t3", to2.alias("to2"), to3.cast("bigint").alias("to3")), "limits")
    nodes = with_bounds(grams, words).join(after, "lang")
    due = lambda n: nodes.where(f"size = {n} AND bound >= to{n} AND (t{n} IS NULL OR bound < t{n})")
    triples = materialize(due(3).select("lang", "phrase"), "frontier")
    # The rest of a phrase of four words after its first one is needed for its score: its beginning is expanded too.
    pairs = due(2).select("lang", "phrase").union(triples.select("lang", last_words(F.col("phrase"), F.lit(1)).alias("phrase")))
    frontier = {2: filter_bits(pairs), 3: filter_bits(triples)}
    more = materialize(frequent_phrases(counted(documents, frequent, frontier), least), "phrases")
    known = materialize(grams.union(more).dropDuplicates(["lang", "phrase"]), "phrases")
    return known, after.select("lang", F.col("to2").alias("t2"), F.col("to3").alias("t3"))
