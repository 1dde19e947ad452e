"""Column-expression helpers: every function returns a native Spark ``Column``."""

from marquee.functions.text import (fixed, join_first, pad_right, prefix, py_round, slug,
                                    strip_text, thousands, zero_pad)
from marquee.functions.values import (bucket_index, bucket_label, clamp_range, count_distinct_with_null,
                                      floor_at, percent_of, to_number, unknown_name)
from marquee.functions.dates import date_text, micros_text, stamp_text, year_from_text
from marquee.functions.json import decode_json, encode_json, json_field

__all__ = [
    "fixed", "join_first", "pad_right", "prefix", "py_round", "slug", "strip_text", "thousands",
    "zero_pad", "bucket_index", "bucket_label", "clamp_range", "count_distinct_with_null",
    "floor_at", "percent_of", "to_number", "unknown_name", "date_text", "micros_text", "stamp_text", "year_from_text",
    "decode_json", "encode_json", "json_field",
]
