"""The registered queries of this subpackage: name -> (query, DuckDB statement or None)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rolegauge.llm.decontaminate import find_leaks
from rolegauge.llm.exact_dedup import exact_groups
from rolegauge.llm.jaccard_join import jaccard_join
from rolegauge.llm.language import identify_languages
from rolegauge.llm.mixing import mixture_weights
from rolegauge.llm.mixing_sql import statement as mixing_statement
from rolegauge.llm.passages import repeated_passages
from rolegauge.llm.phrases import mine_phrases
from rolegauge.llm.phrases_sql import statement as phrases_statement
from rolegauge.llm.quality import quality_rules
from rolegauge.llm.secret_scan import scan_secrets
from rolegauge.llm.token_files import read_token_files, write_token_files
from rolegauge.llm.toxicity import score_toxicity
from rolegauge.llm.vector_codes import vector_codes
from rolegauge.llm.vector_codes_sql import statement as vector_codes_statement
from rolegauge.llm.warc import read_archives, write_archives


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_warc(spark: SparkSession, folder: str) -> DataFrame:
    records = read_archives(write_archives(table(spark, folder, "pages")), payloads=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP1_SQL = """
SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN strlen(html) >= 1000 AND page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN strlen(html) >= 1000 AND page_id < top THEN top END AS refers_to
FROM (SELECT page_id, coalesce(html, '') AS html, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS top FROM pages)
"""


def op2_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


OP2_SQL = """
WITH words AS (
  SELECT 'd' AS side, doc_id AS id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM documents
  UNION ALL SELECT 'b', item_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') FROM benchmark),
places AS (SELECT side, id, w, unnest(range(1, len(w) - 3)) AS i FROM words WHERE len(w) >= 5),
grams AS (SELECT DISTINCT side, id, array_to_string(w[i:i + 4], ' ') AS g FROM places),
sizes AS (SELECT id, count(*) AS n FROM grams WHERE side = 'b' GROUP BY id),
shared AS (
  SELECT d.id AS doc_id, b.id AS item_id, count(*) AS n_shared
  FROM grams d JOIN grams b ON d.g = b.g WHERE d.side = 'd' AND b.side = 'b' GROUP BY 1, 2)
SELECT doc_id, item_id, n AS n_shingles, n_shared, n_shared / n AS containment
FROM shared JOIN sizes ON item_id = id WHERE n_shared >= 0.8 * n
"""


def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixture_weights(table(spark, folder, "documents"))


def op4_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join(table(spark, folder, "documents"))


OP4_SQL = """
WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE
    WHEN len(w) >= 5 THEN list_sort(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s
  FROM words),
classes AS (SELECT s, min(doc_id) AS class_id, count(*) AS n_copies FROM sets WHERE len(s) > 0 GROUP BY s),
grams AS (SELECT class_id, len(s) AS n, unnest(s) AS x FROM classes),
pairs AS (
  SELECT a.class_id AS a, b.class_id AS b FROM grams a JOIN grams b ON a.x = b.x AND a.class_id <> b.class_id
  GROUP BY a.class_id, b.class_id, a.n, b.n HAVING count(*) >= 0.8 * (a.n + b.n - count(*))),
reach AS (SELECT a, b FROM pairs UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON r.b = p.a),
ids AS (SELECT a, min(least(a, b)) AS group_id FROM reach GROUP BY a),
links AS (SELECT a, count(*) AS n_links FROM pairs GROUP BY a)
SELECT doc_id, coalesce(class_id, doc_id) AS class_id, coalesce(n_copies, 1) AS n_copies, coalesce(n_links, 0) AS n_links,
       coalesce(group_id, class_id, doc_id) AS group_id
FROM sets LEFT JOIN classes USING (s) LEFT JOIN ids ON ids.a = class_id LEFT JOIN links ON links.a = class_id
"""


def op5_passages(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_passages(table(spark, folder, "documents"))


def op6_language(spark: SparkSession, folder: str) -> DataFrame:
    return identify_languages(table(spark, folder, "documents"))


def op7_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return read_token_files(write_token_files(table(spark, folder, "documents")), with_ids=False)


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return score_toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op9_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan_secrets(table(spark, folder, "documents"))


def op11_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return vector_codes(table(spark, folder, "embeddings"))


def op12_phrases(spark: SparkSession, folder: str) -> DataFrame:
    return mine_phrases(table(spark, folder, "documents"))


def op13_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_groups(table(spark, folder, "documents"), keep="largest")


OP13_SQL = """
WITH t AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body FROM documents),
g AS (SELECT doc_id, body, max(doc_id) OVER (PARTITION BY body) AS keep_id, count(*) OVER (PARTITION BY body) AS group_size FROM t)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(body) AS text_sha256 FROM g
"""


ENTRIES = {
    "op1_warc": (op1_warc, OP1_SQL),
    "op2_decontaminate": (op2_decontaminate, OP2_SQL),
    "op3_mixing": (op3_mixing, mixing_statement()),
    "op4_jaccard_join": (op4_jaccard_join, OP4_SQL),
    "op5_passages": (op5_passages, None),
    "op6_language": (op6_language, None),
    "op7_token_files": (op7_token_files, None),
    "op8_toxicity": (op8_toxicity, None),
    "op9_secret_scan": (op9_secret_scan, None),
    "op10_quality": (op10_quality, None),
    "op11_vector_codes": (op11_vector_codes, vector_codes_statement()),
    "op12_phrases": (op12_phrases, phrases_statement()),
    "op13_exact_dedup": (op13_exact_dedup, OP13_SQL),
}


def queries() -> dict:
    return {name: query for name, (query, _) in ENTRIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in ENTRIES.items() if sql}
