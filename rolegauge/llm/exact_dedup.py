"""Exact dedup: groups of equal texts by a 128-bit content hash, compared byte by byte; one row of each group stays.

Texts are equal if they are identical after A-Z are lower-cased; other letters are left as they are. Null counts as empty.

1. Every row gets the 128-bit hash (MD5) and the SHA-256 of its normalised text; these narrow rows are written once.
2. Rows are grouped by hash and by the bytes themselves. Tasks combine their own rows before the shuffle, so a text with any number of
   copies is one row of each task at most, and rows that share a hash but not their bytes are groups of their own.
3. A group is named by hash and SHA-256 of its bytes. Should two groups of different bytes share both names, the job stops with an error
   instead of mixing them. The narrow rows meet the groups of two or more rows by name; a hot group is split by Spark's skew join.

DataFrame functions only. The row that stays has the smallest id, or the largest if asked; a null id is smaller than all others here and
only stays if the group has no other id. Rows that repeat the id and the text of the row that stays are marked as kept too, as they cannot
be told apart; `without_copies` leaves one of them. Empty and null texts are one group. Extra columns, whatever their names, stay in
`without_copies` and are not read otherwise. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rolegauge.storage import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(text: Column) -> Column:
    """A-Z in lower case, null as empty. `lower` is the faster way where all characters are ASCII."""
    t = F.coalesce(text.cast("string"), F.lit(""))
    return F.when(F.octet_length(t) == F.char_length(t), F.lower(t)).otherwise(F.translate(t, UPPER, LOWER))


def content_hash(text: Column) -> Column:
    """128 bits of the normalised text."""
    return F.unhex(F.md5(text.cast("binary")))


def groups_of(rows: DataFrame, keep: str) -> DataFrame:
    """(hash, sha256, keep_id, n) of each group of equal bytes; rows has hash, body, doc_id."""
    pick = {"smallest": F.min, "largest": F.max}[keep]
    same = rows.groupBy("hash", "body").agg(pick("doc_id").alias("keep_id"), F.count("*").alias("n"))
    named = same.select("hash", F.sha2(F.col("body").cast("binary"), 256).alias("sha256"), "keep_id", "n")
    whole = named.groupBy("hash", "sha256").agg(F.first("keep_id").alias("keep_id"), F.sum("n").alias("n"), F.count("*").alias("bodies"))
    twofold = F.raise_error(F.concat(F.lit("different texts share both digests: "), F.col("sha256"))).cast("bigint")
    return whole.select("hash", "sha256", "keep_id", F.when(F.col("bodies") == 1, F.col("n")).otherwise(twofold).alias("n"))


def exact_groups(
    documents: DataFrame, text: str = "text", doc_id: str = "doc_id", keep: str = "smallest", hashed: Callable[[Column], Column] = content_hash
) -> DataFrame:
    """One row per document: doc_id, keep_id (the row that stays), group_size, kept, text_sha256."""
    body = normalised(documents[text])
    rows = documents.select(documents[doc_id].alias("doc_id"), body.alias("body")).withColumn("hash", hashed(F.col("body")))
    known = materialize(rows.select("doc_id", "hash", F.sha2(F.col("body").cast("binary"), 256).alias("sha256")), "content-hashes")
    groups = materialize(groups_of(rows, keep).where("n > 1"), "content-groups")
    found = groups.select(F.col("hash").alias("__hash"), F.col("sha256").alias("__sha256"), "keep_id", "n")
    out = known.join(found, (F.col("hash") == F.col("__hash")) & (F.col("sha256") == F.col("__sha256")), "left")
    keep_id = F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return out.select(
        "doc_id", keep_id.alias("keep_id"), F.coalesce("n", F.lit(1)).cast("bigint").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep_id).alias("kept"), F.col("sha256").alias("text_sha256"),
    )


def without_copies(documents: DataFrame, text: str = "text", doc_id: str = "doc_id", keep: str = "smallest") -> DataFrame:
    """The documents without those that have an equal text under the id that stays, with all their columns. Of rows that repeat that id
    and text, one stays."""
    found = exact_groups(documents, text, doc_id, keep)
    # A group is left whole by its rows' digests: (id, digest) of the rows that stay.
    stays = found.where("kept").groupBy("doc_id", "text_sha256").agg(F.count("*").alias("rows"))
    stays = materialize(stays.select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha256"), "rows").withColumnRenamed("rows", "__rows"), "kept-rows")
    digest = F.sha2(normalised(documents[text]).cast("binary"), 256)
    rows = documents.join(stays, documents[doc_id].eqNullSafe(F.col("__id")) & (digest == F.col("__sha256")))
    single = rows.where("__rows = 1").select(*[documents[c] for c in documents.columns])
    several = rows.where("__rows > 1").dropDuplicates(["__id", "__sha256"]).select(*[F.col(f"`{c}`") for c in documents.columns])
    return single.union(several)
