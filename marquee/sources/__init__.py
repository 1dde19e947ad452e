"""Readers: generic tables, silver JSONL, landed catalogue pages, category dimension."""

from marquee.sources.readers import (genre_dim_from_doc, read_genre_doc, read_pages, read_silver,
                                     read_table, records_from_pages, table)

__all__ = ["genre_dim_from_doc", "read_genre_doc", "read_pages", "read_silver", "read_table",
           "records_from_pages", "table"]
