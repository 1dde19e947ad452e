"""JSON encode / decode of message values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marquee.functions._col import as_col


def decode_json(value, schema: StructType) -> Column:
    """Bytes or text → struct by a fixed schema (PERMISSIVE: bad text gives NULL fields)."""
    return F.from_json(as_col(value).cast("string"), schema)


def encode_json(cols, keep_nulls: bool = True) -> Column:
    """Struct of ``cols`` → JSON text; ``keep_nulls`` writes ``null`` like ``json.dumps``."""
    opts = {"ignoreNullFields": "false"} if keep_nulls else {}
    return F.to_json(F.struct(*[as_col(c) for c in cols]), opts)


def json_field(text, path: str) -> Column:
    """Schema-less lookup of one field as text (``$.key``)."""
    return F.get_json_object(as_col(text), path)
