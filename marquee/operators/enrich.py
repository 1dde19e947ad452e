"""Raw catalogue record → topic message (field mapping, defaults, lookups, first-wins)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions.dates import year_from_text
from marquee.functions.text import py_round, slug
from marquee.operators.dedup import dedup_first
from marquee.operators.lookup import lookup_names
from marquee.schemas import MESSAGE_FIELDS

# Defaults of a missing (or NULL) raw field.
RAW_DEFAULTS = {
    "title": "", "original_title": "", "release_date": "", "vote_average": 0.0, "vote_count": 0,
    "overview": "", "popularity": 0.0, "adult": False, "original_language": "",
    "poster_path": "", "backdrop_path": "",
}


def _field(df: DataFrame, name: str) -> Column:
    default = RAW_DEFAULTS.get(name)
    if name not in df.columns:
        if name == "genre_ids":
            return F.array().cast("array<int>")
        return F.lit(default)
    if name == "genre_ids":
        return F.coalesce(F.col(name), F.array().cast("array<int>"))
    return F.coalesce(F.col(name), F.lit(default)) if default is not None else F.col(name)


def enrich_records(raw: DataFrame, genre_dim: DataFrame, source, fetched_at,
                   first_by: Sequence[str] = (), dim_key: str = "id", dim_name: str = "name",
                   dedup: bool = True) -> DataFrame:
    """Map raw records to the 17-field message.

    ``genres`` resolves ``genre_ids`` through ``genre_dim`` (``Unknown_<id>`` when
    missing), ``year`` comes from ``release_date`` text, ``rating`` is ``vote_average``
    rounded to one place, ``source`` is the listing label lower-cased with ``_`` for
    spaces and ``fetched_at`` a ``yyyy-MM-dd HH:mm:ss`` stamp (both may be columns or
    literal text).  With ``dedup`` only the first record of each ``id`` by ``first_by``
    is kept.
    """
    src = F.lit(source) if isinstance(source, str) else source
    stamp = F.lit(fetched_at) if isinstance(fetched_at, str) else fetched_at
    base = raw
    if dedup:
        base = dedup_first(raw, ["id"], list(first_by))
    release = _field(base, "release_date")
    mapped = base.select(
        F.col("id").try_cast("long").alias("id"),
        _field(base, "title").alias("title"),
        _field(base, "original_title").alias("original_title"),
        year_from_text(release).alias("year"),
        py_round(_field(base, "vote_average").cast("double"), 1).alias("rating"),
        _field(base, "vote_count").try_cast("int").alias("votes"),
        _field(base, "genre_ids").alias("genre_ids"),
        _field(base, "overview").alias("overview"),
        _field(base, "popularity").cast("double").alias("popularity"),
        _field(base, "adult").cast("boolean").alias("adult"),
        _field(base, "original_language").alias("original_language"),
        _field(base, "poster_path").alias("poster_path"),
        _field(base, "backdrop_path").alias("backdrop_path"),
        release.alias("release_date"),
        slug(src).alias("source"),
        stamp.cast("string").alias("fetched_at"),
    )
    named = lookup_names(mapped, "genre_ids", genre_dim, dim_key, dim_name, "genres")
    return named.select(*MESSAGE_FIELDS)
