"""File-like rows derived from the documents table."""

from __future__ import annotations

import io
import zipfile
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rolegauge.checks.corpus import pick_text, table


def files(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as files with right, wrong and missing extensions and signatures."""
    docs = table(spark, folder, "documents")
    number = F.col("doc_id")
    n = number.cast("string")
    name = pick_text(
        number, 5,
        F.concat(F.lit("file_"), n, F.lit(".pdf")), F.concat(F.lit("file_"), n, F.lit(".DOCX")),
        F.concat(F.lit("file."), n, F.lit(".txt")), F.concat(F.lit("file_"), n), F.concat(F.lit("file_"), n, F.lit(".exe")),
    )
    head = pick_text(number, 4, F.lit("%PDF-1.7 "), F.lit("PK\x03\x04"), F.lit("a\x00b"), F.lit(""))
    return docs.select(
        "doc_id", name.alias("filename"), F.encode(F.concat(head, F.col("text")), "UTF-8").alias("content"),
        (F.length("text") * 5000).alias("length"),
    )


def split_bytes(spark: SparkSession, folder: str) -> DataFrame:
    """Document bytes with three bytes in the middle that are not UTF-8."""
    docs = table(spark, folder, "documents")
    text = F.encode(F.col("text"), "UTF-8")
    return docs.select("doc_id", F.concat(text, F.unhex(F.lit("FFC0FE")), text).alias("content"))


@F.udf(T.BinaryType(), useArrow=False)
def docx_bytes(text: str) -> bytes:
    """A minimal DOCX file, one paragraph per line and a table with the line count."""
    space = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
    lines = text.split("\n")
    body = "".join(f"<w:p><w:r><w:t>{escape(line)}</w:t></w:r></w:p>" for line in lines)
    cells = "".join(f"<w:tc><w:p><w:r><w:t>{value}</w:t></w:r></w:p></w:tc>" for value in ("lines", len(lines)))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as archive:
        archive.writestr(
            "word/document.xml",
            f'<w:document xmlns:w="{space}"><w:body>{body}<w:tbl><w:tr>{cells}</w:tr></w:tbl></w:body></w:document>',
        )
    return out.getvalue()
