"""JSON at the edges: decode untrusted text, encode records, read single fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Spark's default keeps milliseconds only.
_ISO = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
_PERMISSIVE = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}


def decode(text: Column, schema: T.StructType) -> Column:
    """Record of ``schema``; unreadable text lands in ``_corrupt_record`` where declared."""
    return F.from_json(text, schema, _PERMISSIVE)


def encode(*columns: Column | str) -> Column:
    """JSON object of the given columns."""
    return F.to_json(F.struct(*columns), _ISO)


def field_text(document: Column, name: str) -> Column:
    return F.get_json_object(document, f"$.{name}")


def field_number(document: Column, name: str) -> Column:
    """Number in a JSON field; NULL when it is absent or not a number."""
    return field_text(document, name).try_cast("double")
