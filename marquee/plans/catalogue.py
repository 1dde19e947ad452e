"""End-to-end catalogue flow on DataFrames:

raw records → messages (enrich) → topic values (encode) → stored documents (decode) →
silver rows (clean + explode) → the three analytics.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.operators.analytics import avg_by_group, bucket_histogram, topk_by_group
from marquee.operators.clean import silver_from_stored
from marquee.operators.enrich import enrich_records
from marquee.operators.messages import decode_messages, encode_messages
from marquee.plans.standins import RAW_FIRST_BY, nation_names, raw_catalogue
from marquee.session import work_path
from marquee.sinks.writers import write_jsonl
from marquee.sources.readers import read_silver


def messages(spark: SparkSession, root: str) -> DataFrame:
    raw = raw_catalogue(spark, root, first_only=True)
    return enrich_records(raw, nation_names(spark, root), source=F.col("listing"),
                          fetched_at=F.col("landed_at"), first_by=RAW_FIRST_BY)


def stored(spark: SparkSession, root: str, stamp: bool = False, materialize: bool = True) -> DataFrame:
    """Documents as the stream appends them: messages through JSON and back.

    With ``materialize`` they are written as a Parquet table in the shared work folder and
    read back, as the batch ETL reads the store.  Fused into one plan instead, Catalyst
    would push the ETL's filter below the decode and repeat the JSON work per use.
    """
    docs = decode_messages(encode_messages(messages(spark, root)), stamp=stamp)
    if not materialize:
        return docs
    path = work_path(spark, "stored")
    docs.write.mode("overwrite").parquet(path)
    return spark.read.schema(docs.schema).parquet(path)


def silver(spark: SparkSession, root: str, materialize: bool = True, fmt: str = "parquet") -> DataFrame:
    """Silver rows.  With ``materialize`` they are written to the shared work folder and
    read back, as the analytics read them; the write also ends the lineage of the joins
    upstream.  ``fmt="json"`` writes the JSONL layout (NULL fields omitted) and reads it
    back with the fixed schema."""
    rows = silver_from_stored(stored(spark, root))
    if not materialize:
        return rows
    path = work_path(spark, "silver")
    if fmt == "json":
        write_jsonl(rows, path)
        return read_silver(spark, path)
    rows.write.mode("overwrite").format(fmt).save(path)
    return spark.read.format(fmt).load(path)


def avg_rating_by_genre(silver_df: DataFrame, min_count: int = 50) -> DataFrame:
    return avg_by_group(silver_df, "genre", "rating", min_count=min_count, exact_scale=1)


def top_by_year(silver_df: DataFrame, k: int = 10) -> DataFrame:
    return topk_by_group(silver_df, k=k)


def rating_buckets(silver_df: DataFrame) -> DataFrame:
    return bucket_histogram(silver_df, "rating")
