"""Writers: JSONL and TSV results, topic values, idempotent per-batch appends."""

from marquee.sinks.writers import (append_batch, tsv_lines, write_jsonl, write_single_result,
                                   write_topic, write_tsv)

__all__ = ["append_batch", "tsv_lines", "write_jsonl", "write_single_result", "write_topic", "write_tsv"]
