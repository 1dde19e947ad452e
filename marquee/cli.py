"""Command-line entry points, one per pipeline stage:

    spark-submit ... -m marquee produce   landed pages + category document → topic messages
    spark-submit ... -m marquee ingest    topic → decoded documents appended per micro-batch
    spark-submit ... -m marquee etl       stored documents → silver JSONL (+ counts, preview)
    spark-submit ... -m marquee analytics silver JSONL → three TSV results

The session (and the shared ``spark.checkpoint.dir``) comes from the cluster.  Connector
settings pass through as repeated ``--option key=value``.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from marquee.functions.dates import stamp_text
from marquee.operators.enrich import enrich_records
from marquee.plans.jobs import run_analytics, run_etl
from marquee.schemas import STORED
from marquee.sinks.writers import FILE_FORMATS, write_topic
from marquee.sources.readers import genre_dim_from_doc, read_genre_doc, read_pages, read_table, records_from_pages
from marquee.streaming.ingest import BatchCounter, batch_sink, dedup_stream, message_stream, read_stream, start_ingest
from marquee.streaming.ordered import first_by_order, use_rocksdb
from marquee.streaming.progress import ProgressLedger, observe_arrived, observe_kept, totals

VALUE = StructType([StructField("value", StringType())])

# Broker-source behaviour of the original stream (start at the latest offsets,
# keep going when offsets were lost); any --option overrides them.
BROKER_DEFAULTS = {"startingOffsets": "latest", "failOnDataLoss": "false"}


def _options(pairs) -> dict:
    out = {}
    for p in pairs or []:
        k, sep, v = p.partition("=")
        if not sep:
            raise SystemExit(f"--option needs key=value, got {p!r}")
        out[k] = v
    return out


def produce(spark: SparkSession, a) -> None:
    """Records of the landed pages, first seen per id (page, then position), enriched and
    published as JSON messages."""
    recs = records_from_pages(read_pages(spark, a.pages))
    dim = genre_dim_from_doc(read_genre_doc(spark, a.genres))
    msgs = enrich_records(recs, dim, source=a.source, fetched_at=stamp_text(F.current_timestamp()),
                          first_by=["page", "pos"])
    write_topic(msgs, fmt=a.sink_format, options=_options(a.option), path=a.sink_path)


def _print_preview(batch_id: int, lines: list) -> None:
    if not lines:
        return
    print(f"Batch {batch_id}: {lines[0].batch_rows} documents stored")
    for r in lines:
        print(f"  [{r.idx:2d}] {r.title_line}  {r.genres_line}")
    if lines[0].more_rows:
        print(f"  ... and {lines[0].more_rows} more")


def ingest(spark: SparkSession, a):
    schema = VALUE if a.format in FILE_FORMATS else None
    options = {**(BROKER_DEFAULTS if a.format == "kafka" else {}), **_options(a.option)}
    src = read_stream(spark, a.format, options=options, path=a.path, schema=schema)
    rows = message_stream(src, metrics="ingest", raw="raw" if a.dead_letter else None)
    if a.progress:
        rows = observe_arrived(rows, "id")
    if a.first_by:
        use_rocksdb(spark)
        rows = first_by_order(rows, "id", a.first_by.split(","))
    elif a.dedup:
        rows = dedup_stream(rows, key="id")
    name, ledger = "marquee-ingest", None
    if a.progress:
        rows = observe_kept(rows)
        ledger = ProgressLedger(spark, a.progress, name)
        spark.streams.addListener(ledger)
    counter = BatchCounter()
    sink = batch_sink(a.store, fmt=a.store_format, dead_letter=a.dead_letter, options=_options(a.store_option),
                      counter=counter,
                      preview=None if a.quiet else _print_preview)
    q = start_ingest(rows, sink, checkpoint=a.checkpoint,
                     trigger={"availableNow": True} if a.available_now else None, query_name=name)
    try:
        q.awaitTermination()
    finally:
        if ledger is not None:
            spark.streams.removeListener(ledger)
            ledger.settle(q)
    if not a.quiet:
        print("observed:", json.dumps(counter.totals))
        if ledger is not None:
            print("over all runs:", json.dumps(totals(spark, a.progress).first().asDict()))
    return q


def etl(spark: SparkSession, a):
    schema = STORED if a.source_format == "json" else None  # JSON needs no inference pass
    stored = read_table(spark, a.source_format, path=a.source_path, options=_options(a.option), schema=schema)
    stored = stored.drop("batch_id") if "batch_id" in stored.columns else stored
    rep = run_etl(spark, stored, a.out, fmt=a.silver_format,
                  preview_order=("movie_id", "genre") if a.ordered_preview else None)
    if not a.quiet:
        print(f"documents read: {rep.rows_in:,}; valid: {rep.rows_valid:,}; silver rows: {rep.rows_silver:,}")
        print(f"unique items: {rep.distinct_ids:,}; unique genres: {rep.distinct_genres}")
        for r in rep.preview:
            print("  ", r)
    return rep


def analytics(spark: SparkSession, a) -> dict:
    paths = run_analytics(spark, a.silver, a.out, lenient=a.lenient, min_count=a.min_count, k=a.k,
                          fmt=a.silver_format)
    if not a.quiet:
        for name, p in paths.items():
            print(name, p)
    return paths


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="marquee")
    sub = ap.add_subparsers(dest="stage", required=True)

    p = sub.add_parser("produce", help="landed pages -> topic messages")
    p.add_argument("--pages", required=True)
    p.add_argument("--genres", required=True, help="category document {\"genres\": [{id, name}]}")
    p.add_argument("--source", default="Popular", help="listing label (lower-cased, spaces to _)")
    p.add_argument("--sink-format", default="kafka")
    p.add_argument("--sink-path")
    p.add_argument("--option", action="append", help="sink option key=value (e.g. topic=movies)")
    p.set_defaults(run=produce)

    p = sub.add_parser("ingest", help="topic -> stored documents")
    p.add_argument("--format", default="kafka")
    p.add_argument("--path")
    p.add_argument("--option", action="append",
                   help="source option key=value (kafka.bootstrap.servers, subscribe, startingOffsets, ...)")
    p.add_argument("--store")
    p.add_argument("--store-format", default="parquet")
    p.add_argument("--store-option", action="append")
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--first-by", help="columns, comma-separated: keep the first of an id by these, later finds as revisions")
    p.add_argument("--progress", help="folder for durable counts per micro-batch")
    p.add_argument("--dead-letter")
    p.add_argument("--dedup", action="store_true", help="store each id once, the first to arrive")
    p.add_argument("--available-now", action="store_true", help="process what is there, then stop")
    p.add_argument("--quiet", action="store_true")
    p.set_defaults(run=ingest)

    p = sub.add_parser("etl", help="stored documents -> silver JSONL")
    p.add_argument("--source-format", default="parquet")
    p.add_argument("--source-path")
    p.add_argument("--option", action="append")
    p.add_argument("--out", required=True)
    p.add_argument("--silver-format", default="json", help="json (JSONL, default) or a columnar format")
    p.add_argument("--ordered-preview", action="store_true",
                   help="preview the first rows by id (a full scan) instead of any 5 rows")
    p.add_argument("--quiet", action="store_true")
    p.set_defaults(run=etl)

    p = sub.add_parser("analytics", help="silver JSONL -> three TSV results")
    p.add_argument("--silver", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--lenient", action="store_true", help="accept numbers written as text (JSONL silver)")
    p.add_argument("--silver-format", default="json")
    p.add_argument("--min-count", type=int, default=50)
    p.add_argument("--k", type=int, default=10)
    p.add_argument("--quiet", action="store_true")
    p.set_defaults(run=analytics)
    return ap


def main(argv=None, spark: SparkSession | None = None):
    a = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"marquee-{a.stage}").getOrCreate()
    return a.run(spark, a)


if __name__ == "__main__":
    main(sys.argv[1:])
