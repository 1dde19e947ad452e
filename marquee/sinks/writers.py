"""Sinks.  Every writer replaces its target (re-running a job gives the same files)."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.operators.messages import encode_messages
from marquee.session import work_path


def write_jsonl(df: DataFrame, path: str) -> None:
    """Overwrite ``path`` with JSON lines; NULL fields are omitted from a line."""
    df.write.mode("overwrite").json(path)


def tsv_lines(df: DataFrame) -> DataFrame:
    """Headerless TAB-separated text of every column (NULL as empty text)."""
    return df.select(F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns])
                     .alias("value"))


def write_tsv(df: DataFrame, path: str) -> None:
    """Overwrite ``path`` with headerless TSV part files."""
    tsv_lines(df).write.mode("overwrite").text(path)


def ordered_parts(df: DataFrame, order_by=None) -> tuple[DataFrame, DataFrame]:
    """The TSV lines of ``df`` in its own order (or ``order_by``) as a written table of sorted
    parts, ``(part, row, value)``, and its manifest, ``(part, first, n)``.

    Ordering is a range partitioning whose parts are sorted by a task each; the manifest has one
    row per part: the sizes and, by their prefix sums, the number of each part's first line.
    """
    spark = df.sparkSession
    lines = tsv_lines(df.orderBy(*order_by) if order_by else df)
    path = work_path(spark, "ordered")
    lines.select(F.spark_partition_id().alias("part"),
                 F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("row"), "value").write.parquet(path)
    parts = spark.read.schema("part int, row long, value string").parquet(path)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = parts.groupBy("part").agg(F.count("*").alias("n"))
    return parts, sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"), "n")


def ordered_lines(df: DataFrame, order_by=None) -> DataFrame:
    """``(line_no, line)`` of the ordered result, numbered from 0 without one sorting task."""
    parts, manifest = ordered_parts(df, order_by)
    # one row per part of the result, whatever its length
    return parts.join(F.broadcast(manifest), "part").select((F.col("first") + F.col("row")).alias("line_no"),
                                                            F.col("value").alias("line"))


def _in_order(parts: DataFrame) -> DataFrame:
    """The parts one after another: a scan packs files by size, so each is read by itself."""
    spark, files = parts.sparkSession, sorted(parts.inputFiles())  # named by part
    reads = [spark.read.schema(parts.schema).parquet(f) for f in files]
    return functools.reduce(DataFrame.unionAll, reads) if reads else parts


def merged_lines(df: DataFrame, order_by=None) -> DataFrame:
    """The ordered result as lines of one partition, concatenated from sorted parts: the one
    task sorts nothing and streams.  It stops with an error if a line is out of its place."""
    parts, manifest = ordered_parts(df, order_by)
    placed = _in_order(parts).join(F.broadcast(manifest), "part").coalesce(1)
    at, due = F.monotonically_increasing_id(), F.col("first") + F.col("row")
    return placed.select(F.when(at == due, F.col("value")).otherwise(
        F.raise_error(F.concat(F.lit("line "), due.cast("string"), F.lit(" is out of its place")))).alias("value"))


def write_single_result(df: DataFrame, path: str, order_by=None) -> None:
    """One merged TSV file in the order of ``df`` (or ``order_by``), whatever its size, as a
    merge of part files would leave it: sorted in parallel, then concatenated as a stream."""
    merged_lines(df, order_by).write.mode("overwrite").text(path)


def write_ordered_result(df: DataFrame, path: str, order_by=None) -> None:
    """The ordered result as TSV part files whose names sort in line order, with
    ``<path>/_manifest`` (JSON lines: part, first line, lines); no task sees the whole."""
    parts, manifest = ordered_parts(df, order_by)
    _in_order(parts).select("value").write.mode("overwrite").text(path)
    manifest.write.mode("overwrite").json(f"{path.rstrip('/')}/_manifest")


def write_topic(df: DataFrame, fmt: str = "kafka", options: dict | None = None, path: str | None = None,
                fields=None, key: str | None = None) -> None:
    """Publish each row as a JSON ``value`` (optional ``key``) through any batch sink."""
    enc = encode_messages(df, fields, key) if fields is not None else encode_messages(df, key=key)
    w = enc.write.format(fmt).options(**(options or {}))
    if fmt != "kafka":
        w = w.mode("overwrite")
    w.save(path) if path is not None else w.save()


# Formats written as partitioned files, where a batch can own a partition.
FILE_FORMATS = frozenset({"parquet", "json", "orc", "csv", "text", "avro"})


def append_batch(df: DataFrame, path: str | None, batch_id: int, fmt: str = "parquet",
                 options: dict | None = None) -> None:
    """Idempotent append of one micro-batch: the batch owns ``batch_id=<n>`` and a replay
    overwrites exactly that partition, so at-least-once delivery stores it once.

    A store that is not a file format (a document store reached through its connector) gets
    a plain append with the ``batch_id`` column, so a replayed batch can be recognised there.
    """
    tagged = df.withColumn("batch_id", F.lit(int(batch_id)))
    if fmt not in FILE_FORMATS:
        w = tagged.write.format(fmt).mode("append").options(**(options or {}))
        w.save(path) if path is not None else w.save()
        return
    (tagged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**(options or {}))
           .partitionBy("batch_id").format(fmt).save(path))
