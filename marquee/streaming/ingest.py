"""Streaming ingest built on Structured Streaming.

``read_stream`` (any source: broker, files) → ``message_stream`` (decode + stamp) →
optional ``dedup_stream`` (each id once) → ``start_ingest`` (append mode, per-batch callback,
checkpointed offsets).  The per-batch sink writes each batch into its own ``batch_id``
partition, so a batch replayed after a failure replaces itself.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marquee.operators.messages import decode_messages
from marquee.operators.preview import batch_preview
from marquee.schemas import MESSAGE
from marquee.sinks.writers import append_batch


def read_stream(spark: SparkSession, fmt: str, options: dict | None = None, path: str | None = None,
                schema: StructType | None = None) -> DataFrame:
    """Unbounded source.  Broker options (servers, topic, ``startingOffsets``,
    ``failOnDataLoss``) pass through unchanged; file sources need a ``schema``."""
    r = spark.readStream.format(fmt).options(**(options or {}))
    if schema is not None:
        r = r.schema(schema)
    return r.load(path) if path is not None else r.load()


def message_stream(stream: DataFrame, value: str = "value", schema: StructType = MESSAGE,
                   metrics: str | None = None, raw: str | None = None) -> DataFrame:
    """Key-less message values → typed rows + ``processed_at`` (stateless).

    With ``metrics`` the stream is observed under that name: per micro-batch, ``rows``
    decoded and ``malformed`` rows (no value for the first schema field, the key), reported
    in the query progress without an extra pass over the batch.  ``raw`` keeps the
    message's text in a column of that name (for the dead letter).
    """
    rows = decode_messages(stream, value=value, schema=schema, stamp=True, raw=raw)
    if metrics is None:
        return rows
    key = schema.fields[0].name
    return rows.observe(metrics, F.count(F.lit(1)).alias("rows"),
                        F.count_if(F.col(key).isNull()).alias("malformed"))


class BatchCounter:
    """Totals over all micro-batches of a query: rows arrived, rows without a key, rows
    stored.  A few integers, however long the stream runs; a replayed batch (only the last one
    can be) replaces its own numbers."""

    FIELDS = ("rows", "malformed", "stored")

    def __init__(self):
        self._lock = threading.Lock()
        self._before = dict.fromkeys(self.FIELDS, 0)
        self._last = dict.fromkeys(self.FIELDS, 0)
        self.last_batch: int | None = None

    def record(self, batch_id: int, **counts: int) -> None:
        with self._lock:
            if self.last_batch != batch_id:
                self._before = {k: v + self._last[k] for k, v in self._before.items()}
            self.last_batch = batch_id
            self._last = {k: int(counts.get(k, 0)) for k in self.FIELDS}

    @property
    def totals(self) -> dict[str, int]:
        with self._lock:
            return {k: v + self._last[k] for k, v in self._before.items()}


def dedup_stream(stream: DataFrame, key: str = "id") -> DataFrame:
    """Each ``key`` once over the whole life of the query, the first to arrive.

    The keys seen are checkpointed state without a watermark: no row is dropped for arriving
    late, a restart forgets nothing, and no event time is read that could be malformed.
    The state holds a row per distinct key (the RocksDB state store keeps it off the heap),
    and a micro-batch touches only the state of its own keys.  Rows without a key are no
    repeats of each other: each has a key of its own, so the source is read and decoded once.
    ``first_by_order`` keeps the first by order instead, and no state for rows without a key.
    """
    own = F.when(F.col(key).isNull(), F.uuid()).otherwise(F.concat(F.lit("k"), F.col(key).cast("string")))
    return stream.withColumn("__key", own).dropDuplicates(["__key"]).drop("__key")


def batch_sink(path: str | None, fmt: str = "parquet", counter: BatchCounter | None = None,
               on_batch: Callable[[DataFrame, int], None] | None = None,
               preview: Callable[[int, list], None] | None = None,
               preview_order: Sequence[str] = ("id",),
               dead_letter: str | None = None, key: str = "id", options: dict | None = None, raw: str = "raw"):
    """``foreachBatch`` callback: idempotent append of the batch, then optional metrics.

    The batch is persisted while it is written, counted and previewed, so the source is
    read once per batch, and released at the end.  ``preview(batch_id, lines)`` receives
    the batch summary of ``batch_preview`` (the first 10 titles by ``preview_order``, the
    batch size and the remainder): at most 10 rows reach the driver, never the batch.
    With ``dead_letter`` the rows without a ``key`` (malformed messages) are appended
    there (Parquet), message text (column ``raw``, if kept) included, instead of the store,
    under the same ``batch_id``.  ``options`` go to the store's writer (connection settings
    of a non-file store).
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            good = batch.drop(raw)
            if dead_letter is not None:
                good = good.filter(F.col(key).isNotNull())
                append_batch(batch.filter(F.col(key).isNull()), dead_letter, batch_id)
            append_batch(good, path, batch_id, fmt, options)
            if counter is not None:
                bad = F.col(key).isNull() if key in batch.columns else F.lit(False)
                n = batch.agg(F.count(F.lit(1)).alias("rows"), F.count_if(bad).alias("malformed")).first()
                stored = n["rows"] - (n["malformed"] if dead_letter is not None else 0)
                counter.record(batch_id, rows=n["rows"], malformed=n["malformed"], stored=stored)
            if preview is not None:
                preview(batch_id, batch_preview(batch, list(preview_order)).collect())
            if on_batch is not None:
                on_batch(batch, batch_id)
        finally:
            batch.unpersist()
    return run


def start_ingest(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str,
                 trigger: dict | None = None, query_name: str | None = None):
    """Start the append-mode query.  ``trigger`` is passed to ``.trigger(**trigger)``;
    the default is the next batch as soon as the last one ends."""
    w = stream.writeStream.outputMode("append").foreachBatch(sink).option("checkpointLocation", checkpoint)
    if trigger:
        w = w.trigger(**trigger)
    if query_name:
        w = w.queryName(query_name)
    return w.start()
