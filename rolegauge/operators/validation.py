"""Accept a row or say why not. The first failing rule gives the reason; NULL means accepted."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rolegauge.functions.text import is_email, strip
from rolegauge.lexicon import ALLOWED_EXTENSIONS, MAX_CATALOG_CHARS, MAX_FIELD_CHARS, MAX_FILE_BYTES, MAX_TITLE_CHARS


def extension(filename: Column) -> Column:
    """Lower-case text after the last dot, NULL without a dot."""
    return F.when(filename.contains("."), F.lower(F.substring_index(filename, ".", -1)))


def accepted_file(filename: Column, length: Column) -> Column:
    return F.coalesce(extension(filename).isin(ALLOWED_EXTENSIONS), F.lit(False)) & (length <= MAX_FILE_BYTES)


def signature_matches(content: Column, ext: Column) -> Column:
    """Whether the first eight bytes fit the file type."""
    head = F.hex(F.substring(content, 1, 8))
    pairs = F.regexp_extract_all(head, F.lit("(..)"), F.lit(1))
    known = (
        F.when(ext == "pdf", head.startswith("255044462D"))
        .when(ext == "docx", head.startswith("504B0304"))
        .when(ext == "txt", ~F.array_contains(pairs, "00"))
        .otherwise(False)
    )
    return F.coalesce(known, F.lit(False))


def _text(column: Column) -> Column:
    return strip(F.coalesce(column, F.lit("")))


def scan_reason(filename: Column, title: Column, description: Column, content: Column, raw_text: Column) -> Column:
    ext = extension(filename)
    return (
        F.when(F.coalesce(filename, F.lit("")) == "", "file missing")
        .when(~F.coalesce(ext.isin(ALLOWED_EXTENSIONS), F.lit(False)), "file type")
        .when((F.length(_text(title)) > MAX_TITLE_CHARS) | (F.length(_text(description)) > MAX_FIELD_CHARS), "target too long")
        .when(~signature_matches(content, ext), "signature")
        .when(_text(raw_text) == "", "no text")
    )


def contact_reason(name: Column, email: Column, subject: Column, message: Column) -> Column:
    fields = {"name": _text(name), "email": _text(email), "subject": _text(subject), "message": _text(message)}
    too_long = F.lit(False)
    for value in fields.values():
        too_long = too_long | (F.length(value) > MAX_FIELD_CHARS)
    return (
        F.when((fields["name"] == "") | (fields["email"] == "") | (fields["message"] == ""), "field missing")
        .when(~is_email(fields["email"]), "email")
        .when(too_long, "too long")
    )


def catalog_reason(title: Column, keywords: Column, description: Column) -> Column:
    t, k, d = _text(title), _text(keywords), _text(description)
    return F.when((t == "") | (k == ""), "field missing").when(
        F.greatest(F.length(t), F.length(k), F.length(d)) > MAX_CATALOG_CHARS, "too long"
    )


def username_reason(username: Column, taken: Column) -> Column:
    name = _text(username)
    return (
        F.when(F.length(name) < 3, "too short")
        .when(~F.rlike(name, F.lit(r"\A[A-Za-z0-9_.-]+\z")), "characters")
        .when(taken, "taken")
    )
