"""Message encode (topic value) and decode (stream rows → typed documents)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marquee.functions.json import decode_json, encode_json
from marquee.schemas import MESSAGE, MESSAGE_FIELDS


def encode_messages(df: DataFrame, fields=MESSAGE_FIELDS, key: str | None = None) -> DataFrame:
    """One ``value`` (JSON text, NULLs written as ``null``) per row; optional ``key``."""
    cols = [encode_json(list(fields)).alias("value")]
    if key is not None:
        cols.insert(0, F.col(key).cast("string").alias("key"))
    return df.select(*cols)


def decode_messages(df: DataFrame, value: str = "value", schema: StructType = MESSAGE,
                    stamp: bool = True, quarantine: bool = False, raw: str | None = None):
    """Bytes/text ``value`` → flattened typed columns, plus ``processed_at``.

    Every message yields exactly one row: unparsable text, a JSON array, an empty or
    NULL value all come out as a row of NULLs, and a field of the wrong JSON type is
    NULL while its siblings survive.  With ``quarantine=True`` the result is a pair
    ``(good, dead_letter)`` split on a NULL first schema field.  ``raw`` names a column that
    keeps the message's own text, so a malformed one can be inspected and replayed.
    """
    parsed = df.select(decode_json(F.col(value), schema).alias("data"), F.col(value).cast("string").alias("__raw"))
    out = parsed.select("data.*", *([F.col("__raw").alias(raw)] if raw else []))
    if stamp:
        out = out.withColumn("processed_at", F.current_timestamp())
    if not quarantine:
        return out
    key = schema.fields[0].name
    return out.filter(F.col(key).isNotNull()), out.filter(F.col(key).isNull())
