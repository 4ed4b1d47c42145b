"""From raw documents to token files: five stages, each written as Parquet and read again as the next one's documents.

Quality rules drop documents; of each group of near copies one stays; documents that contain a benchmark item go; sources, languages and
topics are mixed to their target weights; what is left is written as Huffman-coded token ids and read back. All stages but the last
return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rolegauge.llm.decontaminate import without_leaks
from rolegauge.llm.jaccard_join import keep_one_of_each_group
from rolegauge.llm.mixing import sample_mixture
from rolegauge.llm.quality import keep_good
from rolegauge.llm.token_files import read_token_files, write_token_files
from rolegauge.storage import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one_of_each_group(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sample_mixture(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return read_token_files(write_token_files(docs), with_ids=False)


STAGES = [
    ("quality_rules", quality),
    ("jaccard_join", near_copies),
    ("decontamination", decontaminate),
    ("mixing", mix),
    ("token_files", tokens),
]

#: Trees, MinHash and BPE have no SQL form; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
