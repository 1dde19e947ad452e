"""First-wins by order, not by arrival, over the whole life of a stream.

Each id keeps the first row seen so far in the state; a row that comes later but orders before it
replaces it and is sent on as a correction with the next ``revision``.  A store that takes
all of them in holds, by the highest revision of an id, the row a batch job over everything
that ever arrived would keep.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from marquee.operators.dedup import first_order

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
GROUPS = 1024  # groups over which ids are dealt; Python is called once for each of them that a micro-batch touches
SPREAD = 64  # groups (below 0) over which rows without a key are dealt; they are no repeats and keep no state
BLOCKS = 8  # blocks of a group's state, then they become one


def use_rocksdb(spark: SparkSession) -> None:
    """Arbitrary state needs the RocksDB state store."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def _rank(value) -> tuple:
    """Ascending with NULLs last."""
    return (1, 0) if value is None or value != value else (0, value)


def _plain(t: T.DataType):
    """What turns a value of a frame, where a NULL beside them makes whole numbers floats, into
    the Python value that the state takes for its type."""
    if isinstance(t, T.IntegralType):
        return int
    if isinstance(t, T.FractionalType) and not isinstance(t, T.DecimalType):
        return float
    if isinstance(t, T.BooleanType):
        return bool
    if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
        return lambda v: v.to_pydatetime()
    return lambda v: v


BLOCK = pa.schema([("id", pa.string()), ("revision", pa.int32()), ("order", pa.binary())])


def _packed(block: pa.Table) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, BLOCK) as w:
        w.write_table(block)
    return out.getvalue().to_pybytes()


def _latest(blocks: Sequence[pa.Table]) -> pa.Table:
    """One block with the last row of every id."""
    whole = pa.concat_tables(blocks).combine_chunks()
    return whole.take(pa.array(list({ident: k for k, ident in enumerate(whole["id"].to_pylist())}.values()), pa.int64()))


class _FirstByOrder(StatefulProcessor):
    """State of a group of ids: blocks of (id, revision, order values of its first row), a block
    for each micro-batch that changed any; of an id the last row counts.  Only the rows of ids that
    arrive become Python values."""

    def __init__(self, types: Sequence[T.DataType]):
        self.order, self.plain = [f"o{i}" for i in range(len(types))], [_plain(t) for t in types]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.blocks = handle.getListState("blocks", T.StructType([T.StructField("block", T.BinaryType())]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        if key[0] < 0:
            for pdf in rows:
                yield pd.DataFrame({"row": pdf["row_text"], "revision": 1})
            return
        best = {}
        for pdf in rows:
            for ident, text, *values in zip(pdf["ident"], pdf["row_text"], *[pdf[c] for c in self.order], strict=True):
                values = [None if v is None or v != v else c(v) for c, v in zip(self.plain, values, strict=True)]
                rank = tuple(map(_rank, values))
                if ident not in best or rank < best[ident][0]:
                    best[ident] = (rank, text, values)
        blocks, known, wanted = [], {}, pa.array(list(best), pa.string())
        for (packed,) in self.blocks.get():
            blocks.append(pa.ipc.open_stream(bytes(packed)).read_all())
            found = blocks[-1].filter(pc.is_in(blocks[-1]["id"], wanted))
            known.update(zip(found["id"].to_pylist(), zip(found["revision"].to_pylist(), found["order"].to_pylist(), strict=True), strict=True))
        new = []
        for ident, (rank, text, values) in best.items():
            revision, before = known.get(ident, (0, None))
            if before is None or rank < tuple(map(_rank, pickle.loads(before))):
                new.append((ident, revision + 1, pickle.dumps(values), text))
        if not new:
            return
        idents, revisions, values, texts = map(list, zip(*new, strict=True))
        block = pa.Table.from_arrays([pa.array(idents, pa.string()), pa.array(revisions, pa.int32()), pa.array(values, pa.binary())], schema=BLOCK)
        if len(blocks) < BLOCKS:
            self.blocks.appendValue((_packed(block),))
        else:
            self.blocks.put([(_packed(_latest([*blocks, block])),)])
        yield pd.DataFrame({"row": texts, "revision": revisions})

    def close(self) -> None:
        pass


def first_by_order(stream: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    """The rows of ``stream`` that are first of their ``key`` when they arrive, by ``order_by`` and
    then every other column (NULLs last, as the batch ``dedup_first``), with ``revision`` 1, 2, ...

    One row per key and micro-batch at most; a restart goes on from the checkpoint.  The state
    holds one row per distinct key, and up to ``BLOCKS`` earlier ones until blocks become one.  Keys
    share ``GROUPS`` groups, so that rows and state of many cross to Python together; a micro-batch
    reads the state of the groups it touches and adds what changed.  Rows without a key all pass
    as revision 1.  Rows travel as JSON text, so columns must be of types that JSON keeps.
    """
    order = [c for c in dict.fromkeys([*order_by, *stream.columns]) if c != key]
    text = F.to_json(F.struct(*stream.columns), {"ignoreNullFields": "false"})
    dealt = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    ident = F.col(key).cast("string")
    group = F.when(F.col(key).isNull(), -1 - dealt(text, SPREAD)).otherwise(dealt(ident, GROUPS))
    # names that a Python tuple can have, whatever those of the stream
    bare = stream.select(group.alias("group_key"), ident.alias("ident"), text.alias("row_text"),
                         *[F.col(f"`{c}`").alias(f"o{i}") for i, c in enumerate(order)])
    found = bare.groupBy("group_key").transformWithStateInPandas(
        _FirstByOrder([stream.schema[c].dataType for c in order]), "row string, revision int", "Append", "None")
    return found.select(F.from_json("row", stream.schema).alias("r"), "revision").select("r.*", "revision")


def latest_revisions(stored: DataFrame, key: str) -> DataFrame:
    """What a store of ``first_by_order`` rows stands for: the last revision of each key (a
    replayed batch brings equal rows), and all rows without a key."""
    order = [F.col("revision").desc(), *first_order(stored, [key], ["revision"])[1:]]
    keyed = stored.filter(F.col(key).isNotNull()).withColumn("__n", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return keyed.filter("__n = 1").drop("__n").unionByName(stored.filter(F.col(key).isNull()))
