"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.session import work_path


def read(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """``<sf_dir>/<name>.parquet``, narrowed to ``columns`` when any are named."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def vocabulary() -> tuple[str, str]:
    """Rank file and pattern of the public byte-level vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def written(df: DataFrame, name: str, batch_bytes: int | None = None, options: dict[str, str] | None = None) -> DataFrame:
    """``df`` written as Parquet in the shared working folder and read back: lineage ends
    here, and what executors lose later is read again from the shared files.  The shuffle files
    behind it go once it is written, instead of staying until the driver collects its garbage.
    ``batch_bytes`` bounds the batches that Python gets meanwhile, rounded up to whole rows;
    ``options`` are the writer's."""
    path, conf = work_path(df.sparkSession, name), df.sparkSession.conf
    settings = {CLEANUP: "true"} | ({BATCH: str(batch_bytes)} if batch_bytes else {})
    before = {k: conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            conf.set(k, v)
        df.write.options(**(options or {})).parquet(path)
    finally:
        for k, v in before.items():
            if v is None:
                conf.unset(k)
            else:
                conf.set(k, v)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """Hand what has been freed back to the machine, where the C library can."""
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass


def _kept() -> types.SimpleNamespace:
    return sys.modules.setdefault("__marquee_llm_cache__", types.SimpleNamespace(values={}, used=False))


def process_cache() -> dict:
    """One dictionary per Python worker process, shared by the tasks it runs in turn."""
    _kept().used = True
    return _kept().values


def made(make: Callable[[], Callable]) -> Callable:
    """``make()`` at the start of a task.  Workers outlive stages: what an operator has kept in this
    one goes as soon as a task of another begins, which does not ask for it."""
    kept = _kept()
    kept.used = False
    f = make()
    if kept.values and not kept.used:
        kept.values.clear()
        give_back()
    return f


SLICE_BYTES = 4_000_000  # text turned into Python objects at a time, rounded up to whole texts


def slices(batch: pa.RecordBatch, columns: Sequence[str], limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of a batch, so many at a time that ``columns`` (text or binary ones
    count) hold about ``limit`` bytes."""
    size = np.zeros(batch.num_rows, dtype=np.int64)
    for c in columns:
        values = batch.column(batch.schema.get_field_index(c))
        if pa.types.is_string(values.type) or pa.types.is_binary(values.type) or pa.types.is_large_string(values.type):
            size += pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False)
    total = np.cumsum(size)
    at = 0
    while at < batch.num_rows:
        before = total[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(total, before + limit, side="right")))
        yield batch.slice(at, end - at)
        at = end


def struct_of(text, ddl: str, make: Callable[[], Callable]) -> Column:
    """A struct column computed from a text column in Python.

    Only the text crosses to Python, once, and only the struct comes back; the rest of a row
    waits in the JVM, which spills it.  ``make()`` runs once per task and gives
    ``f(texts) -> lists``, one list per field of ``ddl``, for some megabytes of text at a time.
    """
    fields = T.StructType.fromDDL(ddl).fields

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        from pyspark.sql.pandas.types import to_arrow_type

        f = made(make)
        types, names = [to_arrow_type(x.dataType) for x in fields], [x.name for x in fields]
        for column in columns:
            whole = pa.RecordBatch.from_arrays([column], ["text"])
            # a slice's rows go back at once: those of a whole batch would take memory here and in the JVM
            for b in slices(whole, ["text"]):
                yield pa.StructArray.from_arrays([pa.array(v, type=t) for v, t in zip(f(b.column(0).to_pylist()), types, strict=True)], names)
            if not len(column):
                yield pa.array([], pa.struct(list(zip(names, types, strict=True))))
    # never computed twice for two uses of its fields
    return F.arrow_udf(run, T.StructType(fields)).asNondeterministic()(text)


def add_columns(df: DataFrame, inputs: Sequence[str], outputs: str | T.StructType,
                make: Callable[[], Callable], keep: Sequence[str] | None = None) -> DataFrame:
    """``df`` with columns computed batch by batch in Python (Arrow, no shuffle).

    ``make()`` runs once per task and gives ``f(*lists) -> lists``: the values of ``inputs``
    in, one list per output column back, row for row.  ``keep`` names the columns carried
    through (default: all); a carried column that clashes with an output name is replaced.
    """
    out = outputs if isinstance(outputs, T.StructType) else T.StructType.fromDDL(outputs)
    kept = [c for c in (df.columns if keep is None else keep) if c not in out.names]
    schema = T.StructType([df.schema[c] for c in kept] + out.fields)
    inputs = list(inputs)

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_type

        f = made(make)
        types = [to_arrow_type(x.dataType) for x in out.fields]
        for b in batches:
            got = f(*[b.column(b.schema.get_field_index(c)).to_pylist() for c in inputs])
            new = [pa.array(v, type=t) for v, t in zip(got, types, strict=True)]
            carried = [b.column(b.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays(carried + new, names=schema.names)

    need = [c for c in df.columns if c in kept or c in inputs]
    return df.select(*need).mapInArrow(run, schema)
