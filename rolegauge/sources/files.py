"""Document files: scan, signature check, text extraction, reject reasons."""

from __future__ import annotations

import io
import re
import zipfile
import zlib
from xml.etree import ElementTree

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rolegauge.functions.text import strip
from rolegauge.operators.validation import accepted_file, extension, signature_matches

W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
UNREADABLE = "no readable text"
# File names in any case, for the listing itself: other files are not opened.
NAMES = "*.{[pP][dD][fF],[tT][xX][tT],[dD][oO][cC][xX]}"
MAX_XML_BYTES = 256 << 20
MOST_COLUMNS = 63  # of a table that does not say how many it has
DAMAGE = (zipfile.BadZipFile, zipfile.LargeZipFile, zlib.error, ElementTree.ParseError, KeyError, RuntimeError, EOFError, OSError, ValueError)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """Accepted files below ``path``: ``path, ext, length, content``. Other files are never opened."""
    source = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", NAMES)
    files = source.load(path)
    return files.filter(accepted_file(F.col("path"), F.col("length"))).select(
        "path", extension(F.col("path")).alias("ext"), "length", "content"
    )


def decode_text(content: Column) -> Column:
    """UTF-8 bytes as text; bytes that are not UTF-8 are left out."""
    return F.replace(F.make_valid_utf8(content.cast("string")), F.lit("�"), F.lit(""))


def docx_text(content: bytes) -> str:
    """Paragraphs, then table cells row by row, one per line; a merged cell counts once for each place it covers in the
    table's grid. Empty when the file is damaged, encrypted, packed in an unknown way, or its text is larger than MAX_XML_BYTES."""

    def paragraph(node: ElementTree.Element) -> str:
        signs = {f"{W}tab": "\t", f"{W}br": "\n", f"{W}cr": "\n"}
        return "".join(part.text or "" if part.tag == f"{W}t" else signs.get(part.tag, "") for part in node.iter())

    try:
        with zipfile.ZipFile(io.BytesIO(content)) as archive:
            if archive.getinfo("word/document.xml").file_size > MAX_XML_BYTES:
                return ""
            body = ElementTree.fromstring(archive.read("word/document.xml")).find(f"{W}body")
    except DAMAGE:
        return ""
    if body is None:
        return ""
    def places(cell: ElementTree.Element, free: int) -> int:
        """Columns that a cell covers, at most those that are free; 1 for a width that is no number."""
        span = cell.find(f"{W}tcPr/{W}gridSpan")
        width = span.get(f"{W}val", "1").strip() if span is not None else "1"
        return max(1, min(int(width), free)) if re.fullmatch("[0-9]{1,9}", width) else 1

    lines = [paragraph(p) for p in body.findall(f"{W}p")]
    for table in body.findall(f"{W}tbl"):
        above: list[str] = []
        columns = len(table.findall(f"{W}tblGrid/{W}gridCol")) or MOST_COLUMNS
        for row in table.findall(f"{W}tr"):
            texts: list[str] = []
            for cell in row.findall(f"{W}tc"):
                merge = cell.find(f"{W}tcPr/{W}vMerge")
                below = merge is not None and merge.get(f"{W}val") != "restart" and len(texts) < len(above)
                text = above[len(texts)] if below else "\n".join(paragraph(p) for p in cell.findall(f"{W}p"))
                texts += [text] * places(cell, columns - len(texts))
            lines += texts
            above = texts
    return "\n".join(lines)


@F.udf(T.StringType(), useArrow=False)
def docx_texts(content: bytes | None) -> str | None:
    """DOCX bytes as text; NULL stays NULL. Files are handed over a hundred at a time, where an Arrow batch holds ten thousand of them."""
    return None if content is None else docx_text(bytes(content))


def extracted(files: DataFrame) -> DataFrame:
    """``path, ext, raw_text, reject_reason`` of accepted files, in one pass over the bytes.

    Only the bytes of DOCX files are handed to Python. PDF text needs a parser this package does not have: those rows
    come out without text and are rejected as unreadable.
    """
    content, ext = F.col("content"), F.col("ext")
    fits = signature_matches(content, ext)
    docx_bytes = F.when((ext == "docx") & fits, content)
    text = F.when(ext == "txt", decode_text(content)).when(ext == "docx", docx_texts(docx_bytes)).otherwise(F.lit(""))
    read = files.select("path", "ext", fits.alias("fits"), F.when(fits, text).alias("raw_text"))
    reason = F.when(~F.col("fits"), "signature").when(strip(F.col("raw_text")) == "", UNREADABLE)
    return read.select("path", "ext", "raw_text", reason.alias("reject_reason"))
