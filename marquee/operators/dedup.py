"""First-wins de-duplication: ``row_number() = 1`` under a total order (skew-safe)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType


def _orderable(t: DataType) -> bool:
    if isinstance(t, MapType):
        return False
    if isinstance(t, ArrayType):
        return _orderable(t.elementType)
    if isinstance(t, StructType):
        return all(_orderable(f.dataType) for f in t.fields)
    return True


def first_order(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> list[Column]:
    """The total order behind "first": ``order_by`` ascending with NULLs last, then every
    other orderable column ascending with NULLs last, so the pick never depends on
    arrival order or on which task saw a row first."""
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    cols = list(order_by) + [c for c in rest if _orderable(df.schema[c].dataType)]
    return [F.col(c).asc_nulls_last() for c in cols]


def dedup_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """Keep one row per ``keys``: the first by ``order_by`` (then all other columns).

    ``row_number() = 1`` over the key lets Catalyst place a partial ``WindowGroupLimit``
    before the shuffle: each map task sorts its rows and sends on only its first row per
    key, so a key that holds a third of all rows costs one row per task in the exchange,
    not a third of the data in one reducer.  The sort is code-generated and spills, where
    a ``min`` over a struct of all columns would fall back to an interpreted sort
    aggregate.  NULL keys form one group, like a Python set that holds ``None``.
    """
    keys = list(keys)
    order = first_order(df, keys, order_by)
    if not order:  # nothing to order by: every row of a key is equal on orderable columns
        return df.dropDuplicates(keys)
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("__rn", F.row_number().over(w))
              .filter(F.col("__rn") == 1)
              .drop("__rn"))


def first_candidates(df: DataFrame, keys: Sequence[str], leading) -> DataFrame:
    """The one row per ``keys`` that is first by the ``leading`` order columns or expressions,
    then by every other column of ``df`` (NULLs last): ``dedup_first`` placed before wide
    joins, which then run on one row per key.  Joins in between must keep or drop whole keys.

    ``row_number() = 1`` is limited per task before its shuffle, so a hot key, ties on the
    leading columns included, sends one row per task.
    """
    lead = [(F.col(c) if isinstance(c, str) else c).asc_nulls_last() for c in leading]
    w = Window.partitionBy(*keys).orderBy(*lead, *first_order(df, keys, ()))
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")
