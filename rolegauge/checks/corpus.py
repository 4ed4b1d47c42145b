"""Test inputs derived from the generated tables; ``checks/sql/base.py`` says the same in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rolegauge.checks.sentences import EXTENSIONS, REQUIREMENTS, SNIPPETS, TITLES
from rolegauge.functions.terms import base_tokens
from rolegauge.functions.text import normalize
from rolegauge.session import shuffle_partitions
from rolegauge.sources.catalog import default_catalog


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def pick(values: list, number: Column) -> Column:
    """The value at ``number`` modulo the length of the list."""
    choices = F.array(*[F.lit(v).cast("string") for v in values])
    return F.get(choices, F.pmod(number, F.lit(len(values))).cast("int"))


def corpus(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with a snippet, a file type, a target role and an owner. The test files have one row group, which is one task, so they
    are dealt out here; the library leaves input splits as they are."""
    docs = table(spark, folder, "documents").repartition(shuffle_partitions(spark), "doc_id")
    bench = table(spark, folder, "benchmark").select("item_id", F.col("text").alias("bench_text"))
    size = bench.agg(F.count("*")).scalar()
    number = F.col("doc_id")
    described = F.when(
        number % 5 != 0, F.concat_ws(" ", F.col("bench_text"), pick(REQUIREMENTS, number))
    )
    return (
        docs.withColumn("item_id", F.pmod(number, size))
        .join(bench, "item_id", "left")
        .select(
            "doc_id",
            F.concat(F.col("text"), F.lit("\n"), pick(SNIPPETS, number)).alias("raw_text"),
            pick(EXTENSIONS, number).alias("ext"),
            pick(TITLES, number).alias("title"),
            described.alias("description"),
            F.when(number % 11 != 0, number % 37).alias("user_id"),
            F.concat(F.lit("cv_"), number.cast("string"), F.lit("."), pick(EXTENSIONS, number)).alias("filename"),
            F.timestamp_seconds(F.lit(1735689600) + number * 3600).alias("uploaded_at"),
        )
    )


def catalog(spark: SparkSession, folder: str) -> DataFrame:
    """The default roles, then one role per benchmark item."""
    bench = table(spark, folder, "benchmark")
    long_tokens = F.filter(base_tokens(normalize(F.col("text"))), lambda t: F.length(t) > 4)
    items = bench.select(
        (F.col("item_id") + 5).alias("job_id"),
        F.concat(F.lit("Role "), F.col("item_id").cast("string")).alias("title"),
        F.array_join(F.array_distinct(long_tokens), ", ").alias("keywords"),
        F.col("text").alias("description"),
    )
    return default_catalog(spark).unionByName(items)


def users(spark: SparkSession, folder: str) -> DataFrame:
    """Users seen in the events; the lowest id is the admin, some ids are left out."""
    seen = table(spark, folder, "events").groupBy("user_id").agg(F.min("ts").alias("created_at"))
    lowest = seen.agg(F.min("user_id")).scalar()
    return seen.filter(F.col("user_id") % 13 != 5).select(
        F.col("user_id").alias("id"),
        F.when(F.col("user_id") == lowest, F.lit("admin"))
        .otherwise(F.concat(F.lit("user_"), F.col("user_id").cast("string")))
        .alias("username"),
        "created_at",
    )


def reports(spark: SparkSession, folder: str) -> DataFrame:
    """Events as stored reports with payload texts in the current, the legacy and broken forms."""
    e = table(spark, folder, "events")
    number, score = F.col("event_id"), F.least(F.lit(100), F.floor(F.col("value"))).cast("int")
    n = number.cast("string")
    jobs = pick_text(
        number, 10,
        F.concat(F.lit('[{"title": "Data Analyst", "match_score": '), (number % 100).cast("string"),
                 F.lit('}, {"title": "Role '), n, F.lit('", "match_score": 7}]')),
        F.concat(F.lit("[{'title': 'True None "), n, F.lit("', 'match_score': 7.5, 'note': None}, {'title': ''}]")),
        F.concat(F.lit("broken ["), n),
        F.concat(F.lit('"Data Analyst, Role '), n, F.lit('"')),
        F.lit(None).cast("string"),
        F.concat(F.lit('["Plain '), n, F.lit('", {"title": "Mixed", "match_score": 3}, "  "]')),
        F.concat(F.lit("['a' 'b', 5, u'z', True, ('tuple', 1), '5', r'c "), n, F.lit("']")),
        F.concat(F.lit("('Top', {'title': 'Role "), n, F.lit("'})")),
        F.concat(F.lit("[{'title': 'A\\x41 ' \"it's \" '"), n, F.lit("', 'match_score': 1_0, 'tags': ('x',)}, 7.5]")),
        F.concat(F.lit("'Legacy ' 'Role "), n, F.lit(", Second'")),
    )
    criteria = pick_text(
        number, 4,
        F.concat(F.lit('{"Skills": '), (number % 11).cast("string"), F.lit('.5, "Education": 4}')),
        F.concat(F.lit("{'Education': "), (number % 7).cast("string"), F.lit("}")),
        F.lit("not json"),
        F.lit(""),
    )
    suggestions = pick_text(
        number, 5,
        F.concat(F.lit('["Add detail '), n, F.lit('", "Use numbers"]')),
        F.lit("[]"),
        F.lit(None).cast("string"),
        F.lit('{"a": 1}'),
        F.lit("['Legacy advice']"),
    )
    analysis = pick_text(
        number, 3,
        F.concat(
            F.lit('{"word_count": '), n,
            F.lit(', "score_details": {"Skills": "Detected explicit skills."}, "bullet_rewrites": '
                  '[{"before": "Helped", "after": "Delivered '), n,
            F.lit('"}], "analysis_steps": [{"label": "Parsed", "detail": "'), n, F.lit(' words"}]}'),
        ),
        F.lit("{}"),
        F.lit(None).cast("string"),
    )
    return e.select(
        number.alias("id"),
        F.when(F.col("user_id") % 10 != 0, F.col("user_id")).alias("user_id"),
        F.concat(F.lit("cv_"), n, F.lit("."), pick(EXTENSIONS, number)).alias("filename"),
        F.col("ts").alias("uploaded_at"),
        F.when(number % 50 != 0, score).alias("score"),
        jobs.alias("matched_jobs"),
        criteria.alias("criteria"),
        suggestions.alias("suggestions"),
        analysis.alias("analysis"),
    )


def pick_text(number: Column, count: int, *choices: Column) -> Column:
    result = F.when(number % count == 0, choices[0])
    for place, choice in enumerate(choices[1:], start=1):
        result = result.when(number % count == place, choice)
    return result


def contacts(spark: SparkSession, folder: str) -> DataFrame:
    """The turns of the conversations as contact messages."""
    c = table(spark, folder, "conversations")
    n = F.col("conv_id").cast("string")
    number = F.col("conv_id")
    return c.select(
        (number * 1000 + F.col("turn")).alias("id"),
        (number % 200).alias("user_id"),
        F.when(number % 23 == 3, F.lit("  ")).otherwise(F.concat(F.lit("Sender "), n)).alias("name"),
        F.when(number % 7 == 0, F.concat(F.lit("not-an-email-"), n))
        .otherwise(F.concat(F.lit(" sender"), n, F.lit("@example.org ")))
        .alias("email"),
        F.concat(F.lit("Topic "), F.col("turn").cast("string")).alias("subject"),
        F.col("text").alias("message"),
        F.timestamp_seconds(F.lit(1704067200) + number * 3600 + F.col("turn") * 60).alias("created_at"),
    )


def attempts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        F.col("event_type").alias("action"), F.col("user_id").alias("client"), "ts", F.col("event_id").alias("attempt_id")
    )
