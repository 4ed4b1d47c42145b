"""Contact messages: keep the valid ones and append them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rolegauge.functions.text import strip
from rolegauge.operators.validation import contact_reason
from rolegauge.schemas import CONTACTS_DDL, conform, schema

FIELDS = ["name", "email", "subject", "message"]


def accepted_contacts(messages: DataFrame) -> DataFrame:
    """Valid messages with their fields trimmed, in the shape of the contact table."""
    valid = messages.filter(contact_reason(*[F.col(f) for f in FIELDS]).isNull())
    trimmed = valid.withColumns({f: strip(F.coalesce(f, F.lit(""))) for f in FIELDS})
    return conform(trimmed, schema(CONTACTS_DDL))


def append_contacts(messages: DataFrame, path: str) -> None:
    accepted_contacts(messages).write.mode("append").parquet(path)
