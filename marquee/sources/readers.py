"""Batch readers.  Connectors that need extra jars (document stores, brokers) are reached
through ``read_table(spark, fmt, options)``; nothing here depends on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import StringType, StructType

from marquee.functions.values import number_of_text
from marquee.schemas import GENRE_DOC, RAW_PAGE, SILVER

def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """``<root>/<name>.parquet`` (the driver's test tables)."""
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")


def read_table(spark: SparkSession, fmt: str, path: str | None = None, options: dict | None = None,
               schema: StructType | None = None) -> DataFrame:
    """Full scan of a stored collection in any registered format (``parquet``, ``json``,
    ``mongodb``, ...).  A fixed ``schema`` avoids an inference pass."""
    r = spark.read.format(fmt).options(**(options or {}))
    if schema is not None:
        r = r.schema(schema)
    return r.load(path) if path is not None else r.load()


def _once(df: DataFrame, *cols) -> DataFrame:
    """``df.select(*cols)`` as a generator of one row from one.  Filters behind a plain projection
    are pushed below it with a copy of its expressions for each use; these are computed once."""
    return df.select(F.inline(F.array(F.struct(*cols))))


def read_silver(spark: SparkSession, path: str, lenient: bool = False) -> DataFrame:
    """Silver JSONL (blank lines are skipped by the reader).

    ``lenient=True`` accepts what a JSON number, or a text that spells one, holds, and skips
    lines that are no JSON object.  The last value of a repeated key counts.  It adds ``bad_fields``: names of the fields whose value
    is there but does not convert (an unparsable text, an explicit null, a nested value).  A
    missing field is not bad; its column is NULL.  The analytics drop a row with a bad value
    in a field they convert.
    """
    if not lenient:
        return spark.read.schema(SILVER).json(path)
    # parsed as the one element of an array: text after the object, or a second one, is an error.
    # Each field keeps its kind; of a repeated key the last value counts, and NaN or Infinity,
    # as Python's reader takes them, come as the texts that spell them.
    fields = T.StructType([T.StructField(f.name, T.VariantType()) for f in SILVER.fields])
    doc = F.from_json(F.concat(F.lit("["), F.col("value"), F.lit("]")), T.ArrayType(fields))
    lines = _once(spark.read.text(path), doc.alias("a")).filter(F.size("a") == 1).select(F.col("a")[0].alias("v")).filter("v is not null")
    names = [f.name for f in SILVER.fields]
    lines = _once(lines, *[F.schema_of_variant(F.col(f"v.{n}")).alias(f"kind_{n}") for n in names],
                  *[F.try_variant_get(F.col(f"v.{n}"), "$", "string").alias(f"text_{n}") for n in names])
    values = []
    for f in SILVER.fields:
        kind, text = F.col(f"kind_{f.name}"), F.col(f"text_{f.name}")
        if isinstance(f.dataType, StringType):
            value = F.when(kind == "STRING", text)
        else:
            plain = F.when(kind == "BOOLEAN", (text == "true").cast("int").cast("string")).otherwise(text)
            # a number converts as a number (7.9 to 7); a text must spell one of the type
            value = F.when(kind == "STRING", number_of_text(text, f.dataType)).otherwise(
                plain.try_cast("double").try_cast(f.dataType))
        values.append(value.alias(f.name))
    lines = _once(lines, *values, *[f"kind_{n}" for n in names])
    bad = [F.when(F.col(f"kind_{n}").isNotNull() & F.col(n).isNull(), F.lit(n)) for n in names]
    return lines.select(*names, F.array_compact(F.array(*bad)).alias("bad_fields"))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed listing pages, one JSON document per line: ``{"page": n, "results": [...]}``."""
    return spark.read.schema(RAW_PAGE).json(path)


def records_from_pages(pages: DataFrame) -> DataFrame:
    """One row per record of every page, with ``page`` and position ``pos`` kept so that
    "first seen" can be defined as (page, pos)."""
    return pages.select("page", F.posexplode("results").alias("pos", "r")).select("page", "pos", "r.*")


def read_genre_doc(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(GENRE_DOC).json(path)


def genre_dim_from_doc(doc: DataFrame) -> DataFrame:
    """``{"genres": [{id, name}, ...]}`` → rows ``(id, name)``; an empty or bad document
    gives no rows (every id then falls back to ``Unknown_<id>``)."""
    return doc.select(F.explode("genres").alias("g")).select("g.id", "g.name").filter(F.col("id").isNotNull())


def read_lines_in_order(spark: SparkSession, path: str, value: str = "value") -> DataFrame:
    """Text lines with their place in the input, ``input_pos`` (file, start of the split, row):
    ordering by it gives the files by path and their lines as they stand, after any shuffle.

    A task numbers its rows as it reads them, so inside one split of one file the numbers rise
    from line to line, and splits start in the order of their lines.
    """
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
                     F.monotonically_increasing_id().alias("row"))
    return spark.read.text(path).select(F.col("value").alias(value), place.alias("input_pos"))
