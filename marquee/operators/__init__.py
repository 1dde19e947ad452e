"""DataFrame → DataFrame operators of the catalogue flow."""

from marquee.operators.analytics import avg_by_group, bucket_histogram, topk_by_group
from marquee.operators.clean import (clean_documents, explode_categories, keep_nonempty, profile,
                                     project_typed, silver_from_stored)
from marquee.operators.dedup import dedup_first, first_candidates
from marquee.operators.enrich import enrich_records
from marquee.operators.lookup import lookup_name, lookup_names
from marquee.operators.messages import decode_messages, encode_messages
from marquee.operators.preview import batch_preview, preview_rows

__all__ = [
    "avg_by_group", "bucket_histogram", "topk_by_group", "clean_documents", "explode_categories",
    "keep_nonempty", "profile", "project_typed", "silver_from_stored", "dedup_first", "first_candidates",
    "enrich_records", "lookup_name", "lookup_names", "decode_messages", "encode_messages",
    "batch_preview", "preview_rows",
]
