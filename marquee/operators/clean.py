"""Batch ETL: typed projection, range cleaning, non-empty filter, explode, profile."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions.values import clamp_range, floor_at, to_number
from marquee.schemas import CLEAN_FIELDS, SILVER_FIELDS

# Fixed values of the cleaning rules: valid ranges and the sentinel for everything else.
YEAR_MIN, YEAR_MAX = 1900, 2030
RATING_MIN, RATING_MAX = 0.0, 10.0
VOTES_MIN = 0


def project_typed(stored: DataFrame) -> DataFrame:
    """The 13 cleaned columns: ``id`` renamed ``movie_id``; numbers converted leniently
    (text that does not parse becomes NULL instead of failing the job under ANSI)."""
    return stored.select(
        to_number("id", "long").alias("movie_id"),
        F.col("title"), F.col("original_title"),
        to_number("year", "int").alias("year"),
        to_number("rating", "double").alias("rating"),
        to_number("votes", "int").alias("votes"),
        F.col("genres"), F.col("overview"),
        to_number("popularity", "double").alias("popularity"),
        F.col("original_language"), F.col("release_date"), F.col("source"), F.col("fetched_at"))


def clamp_values(df: DataFrame) -> DataFrame:
    """Out-of-range or missing year / rating / votes become the sentinel 0."""
    return df.withColumns({
        "year": clamp_range("year", YEAR_MIN, YEAR_MAX, 0),
        "rating": clamp_range("rating", RATING_MIN, RATING_MAX, 0.0),
        "votes": floor_at("votes", VOTES_MIN, 0),
    })


def keep_nonempty(df: DataFrame, arr: str = "genres") -> DataFrame:
    """Rows whose array has at least one element (a NULL array is dropped too)."""
    return df.filter(F.size(F.col(arr)) > 0)


def clean_documents(stored: DataFrame) -> DataFrame:
    return keep_nonempty(clamp_values(project_typed(stored)))


def explode_categories(clean: DataFrame, arr: str = "genres", out: str = "genre") -> DataFrame:
    """One row per array element (order, duplicates and NULL elements kept)."""
    cols = [F.explode(F.col(arr)).alias(out) if c == arr else F.col(c) for c in CLEAN_FIELDS]
    return clean.select(*cols).select(*SILVER_FIELDS)


def silver_from_stored(stored: DataFrame) -> DataFrame:
    return explode_categories(clean_documents(stored))


def profile(stored: DataFrame) -> DataFrame:
    """Dataset profile in one pass over the stored documents.

    ``rows_in`` (documents read), ``rows_valid`` (after cleaning), ``rows_silver`` (after
    explode), ``distinct_ids`` and ``distinct_genres`` over the silver rows, where NULL
    counts as one value like ``select(c).distinct().count()``: each value is wrapped in a
    one-field struct, which is never NULL itself.
    """
    clean = clamp_values(project_typed(stored))
    ex = clean.select("movie_id", F.posexplode_outer("genres").alias("pos", "genre"))
    in_silver = F.col("pos").isNotNull()
    return ex.agg(
        F.count_if(F.col("pos").isNull() | (F.col("pos") == 0)).alias("rows_in"),
        F.count_if(F.col("pos") == 0).alias("rows_valid"),
        F.count_if(in_silver).alias("rows_silver"),
        F.count_distinct(F.when(in_silver, F.struct("movie_id"))).alias("distinct_ids"),
        F.count_distinct(F.when(in_silver, F.struct("genre"))).alias("distinct_genres"))
