"""Held-out documents, and bounded samples of the others."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

MOST_GROUPS, SPARE = 500, 4


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the quarter of ids that no model learns from; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def learnable(doc_id: str = "doc_id") -> Column:
    return F.col(doc_id).isNotNull() & ~held_out(doc_id)


def sample_of_each(rows: DataFrame, group: str, most: int, key: str = "doc_id", groups: int = MOST_GROUPS) -> DataFrame:
    """At most `most` rows of each of the `groups` largest groups, those with the smallest hash of the key.

    A hash below a bound that the group's size sets lets about SPARE x `most` rows of a group pass, whatever the input's size; only these
    are shuffled and ranked. The sizes are at most `groups` rows, which bounds what is broadcast. Rows without a group are left out.
    """
    share = F.pmod(F.xxhash64(key), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sizes = rows.where(F.col(group).isNotNull()).groupBy(F.col(group).alias("__group")).agg(F.count("*").alias("__size"))
    sizes = sizes.orderBy(F.desc("__size"), "__group").limit(groups)
    near = rows.join(F.broadcast(sizes), F.col(group) == F.col("__group")).where(share * F.col("__size") < SPARE * most)
    order = W.partitionBy("__group").orderBy(share, key)
    return near.withColumn("__place", F.row_number().over(order)).where(F.col("__place") <= most).drop("__place", "__group", "__size")
