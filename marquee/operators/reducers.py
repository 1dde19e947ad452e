"""User mappers and reducers over sorted runs.

A mapper turns a record into any number of records.  A reducer gets a key and an iterator over
that key's rows in order, and yields result rows; rows are repartitioned by key, sorted inside
their partition and streamed through in Arrow batches, so no group is ever held, however large.
A combiner is a reducer that runs on each task's own rows before the shuffle: with it a hot key
sends on what the combiner leaves.

Where built-in expressions do, prefer them: these are for logic that only a user can write.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH = 10_000  # result rows handed over at a time

Mapper = Callable[[dict], Iterable[Sequence]]
Reducer = Callable[[tuple, Iterator[dict]], Iterable[Sequence]]


def _records(batches) -> Iterator[dict]:
    for b in batches:
        names = b.schema.names
        for at in range(0, b.num_rows, BATCH):
            for values in zip(*[c.slice(at, BATCH).to_pylist() for c in b.columns], strict=True):
                yield dict(zip(names, values, strict=True))


def _batches(rows: Iterable[Sequence], schema: T.StructType) -> Iterator[pa.RecordBatch]:
    from pyspark.sql.pandas.types import to_arrow_type

    types = [to_arrow_type(f.dataType) for f in schema.fields]
    held = []

    def packed():
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], schema.names)
    for row in rows:
        held.append(row)
        if len(held) == BATCH:
            yield packed()
            held = []
    if held:
        yield packed()


def _schema(schema: str | T.StructType) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def map_records(df: DataFrame, mapper: Mapper, schema: str | T.StructType) -> DataFrame:
    """``mapper(record) -> rows`` over every row of ``df``, row by row, without a shuffle."""
    out = _schema(schema)

    def run(batches):
        yield from _batches((row for r in _records(batches) for row in mapper(r)), out)
    return df.mapInArrow(run, out)


def _key(record: dict, keys: Sequence[str]) -> tuple:
    # a NaN is one key, as it is where rows are dealt and sorted
    return tuple("NaN" if isinstance(v, float) and v != v else v for v in (record[k] for k in keys))


def _runs(df: DataFrame, keys: Sequence[str], reducer: Reducer, schema: T.StructType) -> DataFrame:
    keys = list(keys)

    def run(batches):
        runs = groupby(_records(batches), key=lambda r: _key(r, keys))
        yield from _batches((row for key, rows in runs for row in reducer(key, rows)), schema)
    return df.mapInArrow(run, schema)


def reduce_runs(df: DataFrame, keys: Sequence[str], reducer: Reducer, schema: str | T.StructType,
                order_by: Sequence[str | Column] = (), combiner: Reducer | None = None) -> DataFrame:
    """``reducer(key, rows) -> rows`` over each key's rows, in ``order_by`` order.

    ``rows`` is a stream that is read once; what the reducer leaves unread is skipped.  NULL
    is a key like any other.  The ``combiner`` yields rows of ``df``'s own columns and must
    not change the result; it sees the rows of a key in one task, in the same order.
    """
    order = [*keys, *order_by]
    if combiner is not None:
        df = _runs(df.sortWithinPartitions(*order), keys, combiner, df.schema)
    return _runs(df.repartition(*[F.col(k) for k in keys]).sortWithinPartitions(*order), keys, reducer, _schema(schema))
