"""Dimension lookups: scalar key → name, and array of keys → array of names.

The scalar lookup is a plain equi-join with the dimension, whatever its size: the planner
broadcasts it when statistics or AQE show it to be small, and otherwise shuffles.

The array lookup reads its input once.  A dimension counted to be short becomes a map in the
expression, and nothing is shuffled.  Against any other the elements are exploded with their
row, keys that hold a large share of all elements are found by a sketch, and the join is
salted for these.

There is one key typing for all: numbers meet numbers by value, and a key of another kind than
the dimension's finds nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, NumericType

from marquee.functions.values import unknown_name
from marquee.session import work_path


def _dimension(dim: DataFrame, key: str, name: str) -> DataFrame:
    # One name per key; a dict built from a list keeps one value per key as well.
    return dim.groupBy(F.col(key).alias("__k")).agg(F.max(name).alias("__name")).filter(F.col("__k").isNotNull())


def _comparable(key: Column, key_type: DataType, dim_type: DataType) -> Column:
    """``key`` in a type that an equi-join compares with the dimension's by value; NULL (finds
    nothing) when the two are of different kinds."""
    both_numbers = isinstance(key_type, NumericType) and isinstance(dim_type, NumericType)
    return key if both_numbers or key_type == dim_type else F.lit(None).cast(dim_type)


def lookup_name(df: DataFrame, key: str, dim: DataFrame, dim_key: str, dim_name: str,
                out: str, fallback_prefix: str = "Unknown_") -> DataFrame:
    """``out = dim.get(df[key], f"{prefix}{key}")``."""
    d = _dimension(dim, dim_key, dim_name)
    probe = _comparable(F.col(key), df.schema[key].dataType, d.schema["__k"].dataType)
    j = df.withColumn("__probe", probe).join(d, F.col("__probe") == F.col("__k"), "left")
    return j.withColumn(out, F.coalesce(F.col("__name"), unknown_name(F.col(key), fallback_prefix))) \
            .drop("__probe", "__k", "__name")


MAP_ENTRIES = 256  # dimensions of up to so many names are a map in the expression
TRACKED = 64  # keys whose shares the sketch reports: twice as many as can hold 1/32 of all elements
SALTS = 32  # tasks that share the elements of a hot key


def lookup_names(df: DataFrame, ids: str, dim: DataFrame, dim_key: str, dim_name: str, out: str,
                 fallback_prefix: str = "Unknown_") -> DataFrame:
    """``out = [dim.get(g, f"{prefix}{g}") for g in df[ids]]``: order and duplicates kept,
    NULL array stays NULL, empty array gives an empty array.  Rows of ``df`` need no key and
    may repeat.
    """
    d = _dimension(dim, dim_key, dim_name)
    element = df.schema[ids].dataType
    element = element.elementType if isinstance(element, ArrayType) else element
    common = _common_type(d.sparkSession, element, d.schema["__k"].dataType)
    entries = d.limit(MAP_ENTRIES + 1).collect() if common is not None else []
    if len(entries) > MAP_ENTRIES:
        return _joined_names(df, ids, d, common, out, fallback_prefix)
    if not entries:
        name = lambda g: unknown_name(g, fallback_prefix)
    else:
        names = F.map_from_arrays(F.array(*[F.lit(e["__k"]).cast(common) for e in entries]),
                                  F.array(*[F.lit(e["__name"]) for e in entries]))
        name = lambda g: F.coalesce(names[g.cast(common)], unknown_name(g, fallback_prefix))
    kept = [c for c in df.columns if c != out]
    return df.select(*kept, F.transform(ids, name).alias(out))


def _common_type(spark: SparkSession, element: DataType, key: DataType) -> DataType | None:
    """The type in which Spark compares the two, None for different kinds."""
    if element == key:
        return key
    if not (isinstance(element, NumericType) and isinstance(key, NumericType)):
        return None
    both = spark.range(0).select(F.coalesce(F.lit(None).cast(element), F.lit(None).cast(key)).alias("c"))
    return both.schema["c"].dataType


def _salted(items: DataFrame, names: DataFrame, hot: list) -> tuple[DataFrame, DataFrame]:
    """Elements and names with the same ``__salt``: elements of hot keys and those without a key
    take one of ``SALTS`` by their row, names of hot keys are there with all of them."""
    spread = F.col("__probe").isNull() | F.col("__probe").isin(hot)
    salt = F.when(spread, F.pmod(F.xxhash64("__rid", "__pos"), F.lit(SALTS)).cast("int")).otherwise(0)
    every = F.when(F.col("__k").isin(hot), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    return items.withColumn("__salt", salt), names.withColumn("__salt", F.explode(every))


def _joined_names(df: DataFrame, ids: str, d: DataFrame, common: DataType, out: str, prefix: str) -> DataFrame:
    """Names by a salted join of the elements, put back together per row.

    A row travels with its first element (or alone, without any), so the input is computed
    once, into a written table, while a sketch counts the keys; what holds ``1 / SALTS`` of the
    elements is spread over ``SALTS`` tasks, its names copied as often.  Elements without a
    key, those of empty and NULL arrays included, match nothing and are spread by their row.
    """
    kept = [c for c in df.columns if c != out]
    row = F.struct(*[F.col(f"`{c}`") for c in kept], *([F.col(f"`{ids}`").alias("__ids")] if ids not in kept else []))
    rows = df.select(F.monotonically_increasing_id().alias("__rid"), row.alias("__row"))
    source = f"__row.`{ids if ids in kept else '__ids'}`"
    items = rows.select("__rid", "__row", F.posexplode_outer(source).alias("__pos", "__id"))
    items = items.select("__rid", "__pos", "__id", F.when(F.coalesce("__pos", F.lit(0)) == 0, F.col("__row")).alias("__row"),
                         F.col("__id").cast(common).alias("__probe"))
    seen = Observation()
    path = work_path(df.sparkSession, "lookup-elements")
    items.observe(seen, F.count("__probe").alias("n"), F.expr(f"approx_top_k(__probe, {TRACKED}, {100 * TRACKED})").alias("top")) \
         .write.parquet(path)
    counted = seen.get
    hot = [t["item"] for t in counted["top"] or () if t["item"] is not None and t["count"] * SALTS >= counted["n"]]
    items = df.sparkSession.read.schema(items.schema).parquet(path)
    items, names = _salted(items, d.select(F.col("__k").cast(common).alias("__k"), "__name"), hot)
    named = items.join(names, (items["__probe"] == names["__k"]) & (items["__salt"] == names["__salt"]), "left")
    name = F.coalesce("__name", unknown_name(F.col("__id"), prefix))
    whole = named.groupBy("__rid").agg(
        F.first("__row", ignorenulls=True).alias("__row"),
        F.array_sort(F.collect_list(F.when(F.col("__pos").isNotNull(), F.struct("__pos", name.alias("n"))))).alias("__l"))
    found = F.when(F.col(source).isNotNull(), F.transform("__l", lambda e: e["n"]))
    return whole.select(*[F.col(f"__row.`{c}`") for c in kept], found.alias(out))
