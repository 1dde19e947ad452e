"""Bounded previews of a batch: a deterministic first-n and the per-batch summary lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions.text import join_first, pad_right, prefix


def preview_rows(df: DataFrame, cols: Sequence[str], order_by: Sequence[str], n: int = 5) -> DataFrame:
    """First ``n`` rows of ``cols`` by ``order_by`` (top-n per task, then merged)."""
    return df.orderBy(*order_by).select(*cols).limit(n)


def batch_preview(df: DataFrame, order_by: Sequence[str], title: str = "title", genres: str = "genres",
                  n: int = 10, title_width: int = 45, n_genres: int = 3) -> DataFrame:
    """The summary a micro-batch prints: the batch size, the first ``n`` titles cut and
    padded to ``title_width``, their first ``n_genres`` genres joined with ", ", and how
    many rows were not listed.  The size is an uncorrelated scalar aggregate, so the whole
    batch is never pulled into one task or the driver."""
    total = df.agg(F.count(F.lit(1))).scalar()
    first = df.orderBy(*order_by).limit(n)
    return first.select(
        # an unpartitioned window, but over the n rows left by the ordered limit only
        F.row_number().over(Window.orderBy(*order_by)).alias("idx"),
        pad_right(prefix(F.coalesce(F.col(title), F.lit("")), title_width), title_width).alias("title_line"),
        join_first(F.col(genres), n_genres).alias("genres_line"),
        total.alias("batch_rows"),
        F.greatest(total - F.lit(n), F.lit(0)).alias("more_rows"))
