"""Record layouts along the catalogue flow (Spark DDL as StructTypes)."""

from pyspark.sql.types import (ArrayType, BooleanType, DoubleType, IntegerType, LongType, StringType,
                               StructField, StructType, TimestampType)

# Raw catalogue record as landed from the listing service (one element of ``results``).
RAW_RECORD = StructType([
    StructField("id", LongType()),
    StructField("title", StringType()),
    StructField("original_title", StringType()),
    StructField("genre_ids", ArrayType(IntegerType())),
    StructField("release_date", StringType()),
    StructField("vote_average", DoubleType()),
    StructField("vote_count", IntegerType()),
    StructField("overview", StringType()),
    StructField("popularity", DoubleType()),
    StructField("adult", BooleanType()),
    StructField("original_language", StringType()),
    StructField("poster_path", StringType()),
    StructField("backdrop_path", StringType()),
])

# A landed page: ``{"page": n, "results": [...]}``.
RAW_PAGE = StructType([
    StructField("page", LongType()),
    StructField("results", ArrayType(RAW_RECORD)),
])

# Category dimension document: ``{"genres": [{"id": .., "name": ..}]}``.
GENRE_DOC = StructType([
    StructField("genres", ArrayType(StructType([
        StructField("id", IntegerType()), StructField("name", StringType())]))),
])

# Message value on the topic: 17 fields, all nullable.
MESSAGE = StructType([
    StructField("id", LongType()),
    StructField("title", StringType()),
    StructField("original_title", StringType()),
    StructField("year", IntegerType()),
    StructField("rating", DoubleType()),
    StructField("votes", IntegerType()),
    StructField("genres", ArrayType(StringType())),
    StructField("genre_ids", ArrayType(IntegerType())),
    StructField("overview", StringType()),
    StructField("popularity", DoubleType()),
    StructField("adult", BooleanType()),
    StructField("original_language", StringType()),
    StructField("poster_path", StringType()),
    StructField("backdrop_path", StringType()),
    StructField("release_date", StringType()),
    StructField("source", StringType()),
    StructField("fetched_at", StringType()),
])
MESSAGE_FIELDS = [f.name for f in MESSAGE.fields]

# Appended document: the message plus the processing stamp.
STORED = StructType(MESSAGE.fields + [StructField("processed_at", TimestampType())])

# After projection, cast and clamp (13 columns).
CLEAN_FIELDS = ["movie_id", "title", "original_title", "year", "rating", "votes", "genres",
                "overview", "popularity", "original_language", "release_date", "source",
                "fetched_at"]

# One row per (item, category): ``genres`` replaced by a scalar ``genre``.
SILVER = StructType([
    StructField("movie_id", LongType()),
    StructField("title", StringType()),
    StructField("original_title", StringType()),
    StructField("year", IntegerType()),
    StructField("rating", DoubleType()),
    StructField("votes", IntegerType()),
    StructField("genre", StringType()),
    StructField("overview", StringType()),
    StructField("popularity", DoubleType()),
    StructField("original_language", StringType()),
    StructField("release_date", StringType()),
    StructField("source", StringType()),
    StructField("fetched_at", StringType()),
])
SILVER_FIELDS = [f.name for f in SILVER.fields]
