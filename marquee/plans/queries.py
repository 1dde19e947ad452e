"""Registered queries: one callable ``(spark, root) -> DataFrame`` per operator family.

Every query reads whole tables under ``root`` (``<root>/<table>.parquet``); arrays in
results are rendered as text so that results compare across engines.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from marquee.functions.dates import date_text, micros_text, stamp_text, year_from_text
from marquee.functions.text import py_round, thousands, zero_pad
from marquee.functions.values import clamp_range, floor_at, to_number
from marquee.operators.analytics import avg_by_group, bucket_histogram, topk_by_group
from marquee.operators.clean import keep_nonempty, profile
from marquee.operators.dedup import dedup_first
from marquee.operators.enrich import enrich_records
from marquee.operators.lookup import lookup_name, lookup_names
from marquee.operators.messages import decode_messages, encode_messages
from marquee.operators.preview import batch_preview, preview_rows
from marquee.plans import catalogue, reducers
from marquee.plans.jobs import etl_report_frame, run_analytics, run_etl
from marquee.plans.standins import (BEYOND, nation_names, order_lines, part_names, part_ratings, raw_catalogue,
                                     shipments)
from marquee.schemas import MESSAGE
from marquee.session import work_path
from marquee.sinks.writers import ordered_lines, write_jsonl, write_single_result, write_topic
from marquee.sources.readers import (genre_dim_from_doc, read_genre_doc, read_lines_in_order, read_pages, read_silver,
                                     read_table, records_from_pages, table)
from marquee.streaming.ingest import BatchCounter, batch_sink, dedup_stream, message_stream, read_stream, start_ingest
from marquee.streaming.ordered import first_by_order, latest_revisions, use_rocksdb
from marquee.streaming.progress import ProgressLedger, observe_arrived, observe_kept, totals


def _text_array(c):
    return F.array_join(F.col(c).cast("array<string>"), "|")


# --- the three analytics on stand-ins ------------------------------------------------

def q_avg_by_group(spark: SparkSession, root: str) -> DataFrame:
    return avg_by_group(part_ratings(spark, root), "genre", "rating", min_count=50, exact_scale=1)


def q_topk_by_group(spark: SparkSession, root: str) -> DataFrame:
    return topk_by_group(order_lines(spark, root, first_only=True), k=10)


def q_bucket_histogram(spark: SparkSession, root: str) -> DataFrame:
    return bucket_histogram(part_ratings(spark, root), "rating")


# --- lookups, text and value rules ----------------------------------------------------

def q_id_name_lookup(spark: SparkSession, root: str) -> DataFrame:
    c = table(spark, root, "customer").select("c_custkey", (F.col("c_nationkey") + BEYOND).alias("nation_id"))
    return lookup_name(c, "nation_id", nation_names(spark, root), "id", "name", "nation_name")


def q_array_lookup(spark: SparkSession, root: str) -> DataFrame:
    sh = shipments(spark, root).select(
        "l_orderkey", "l_linenumber", F.array("s_nationkey", F.col("c_nationkey") + BEYOND).alias("route_ids"))
    named = lookup_names(sh, "route_ids", nation_names(spark, root), "id", "name", "route_names")
    return named.select("l_orderkey", "l_linenumber", F.array_join("route_names", " > ").alias("route"))


def q_array_lookup_large(spark: SparkSession, root: str) -> DataFrame:
    """Names of a dimension that grows with the data; every second id misses it."""
    li = table(spark, root, "lineitem").select(
        "l_orderkey", "l_linenumber", F.array(F.col("l_partkey"), F.col("l_partkey") + 10_000_000_000).alias("part_ids"))
    named = lookup_names(li, "part_ids", part_names(spark, root), "id", "name", "part_names")
    return named.select("l_orderkey", "l_linenumber", F.array_join("part_names", " > ").alias("parts"))


def q_enrich_repeated_ids(spark: SparkSession, root: str) -> DataFrame:
    """Records that repeat their id (a line's order) with different arrays, not de-duplicated:
    each keeps the names of its own array."""
    li = table(spark, root, "lineitem").select(
        F.col("l_orderkey").alias("id"), F.col("l_linenumber").cast("string").alias("title"),
        F.array("l_partkey", "l_suppkey").cast("array<int>").alias("genre_ids"))
    out = enrich_records(li, part_names(spark, root), "Popular", "2024-01-01 00:00:00", dedup=False)
    return out.select("id", "title", _text_array("genres").alias("genres"))


def q_field_mapping_defaults(spark: SparkSession, root: str) -> DataFrame:
    """Records that lack whole fields (``adult``, paths) and hold NULL in others: half the
    titles, dates and votes."""
    o = table(spark, root, "orders")
    odd = F.col("o_orderkey") % 2 == 1
    raw = o.select(
        F.col("o_orderkey").alias("id"), F.when(odd, F.col("o_orderpriority")).alias("title"),
        F.when(~odd, date_text("o_orderdate")).alias("release_date"), F.when(odd, F.col("o_totalprice")).alias("vote_average"),
        F.when(~odd, F.col("o_custkey")).alias("vote_count"), F.lit(None).cast("array<int>").alias("genre_ids"))
    return _message_text(enrich_records(raw, nation_names(spark, root), "Top Rated", "2024-01-01 00:00:00"))


def q_text_shapes(spark: SparkSession, root: str) -> DataFrame:
    o = table(spark, root, "orders")
    return o.select("o_orderkey", zero_pad("o_orderkey", 10).alias("padded"),
                    thousands(F.col("o_orderkey") * 1000).alias("grouped"))


def q_year_from_text(spark: SparkSession, root: str) -> DataFrame:
    o = table(spark, root, "orders")
    return o.select("o_orderkey",
                    year_from_text(date_text("o_orderdate")).alias("year_of_date"),
                    year_from_text(F.col("o_orderpriority")).alias("year_of_priority"),
                    year_from_text(F.col("o_orderstatus")).alias("year_of_status"))


def q_round_1dp(spark: SparkSession, root: str) -> DataFrame:
    li = table(spark, root, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     py_round(F.col("l_extendedprice") / F.col("l_quantity"), 1).alias("unit_price_1dp"))


def q_dedup_first(spark: SparkSession, root: str) -> DataFrame:
    li = table(spark, root, "lineitem")
    first = dedup_first(li, ["l_orderkey"], ["l_shipdate", "l_linenumber"])
    return first.withColumn("l_shipdate", stamp_text(F.col("l_shipdate")))


def q_json_encode_decode(spark: SparkSession, root: str) -> DataFrame:
    ev = table(spark, root, "events").withColumn(
        "ts", micros_text("ts"))
    fields = ["event_id", "user_id", "event_type", "value", "props", "ts"]
    schema = StructType([StructField("event_id", LongType()), StructField("user_id", LongType()),
                         StructField("event_type", StringType()), StructField("value", DoubleType()),
                         StructField("props", StringType()), StructField("ts", StringType())])
    return decode_messages(encode_messages(ev, fields), schema=schema, stamp=False)


PROPS_SCHEMA = StructType([StructField("k", IntegerType())])


def q_json_malformed(spark: SparkSession, root: str) -> DataFrame:
    ev = table(spark, root, "events")
    docs = table(spark, root, "documents")
    values = (ev.select(F.lit("event").alias("src"), F.col("event_id").alias("src_id"), F.col("props").alias("value"))
              .unionByName(docs.select(F.lit("document").alias("src"), F.col("doc_id").alias("src_id"),
                                       F.col("text").alias("value")))
              .unionByName(ev.select(F.lit("mistyped").alias("src"), F.col("event_id").alias("src_id"),
                                     F.to_json(F.struct(F.col("event_type").alias("k"))).alias("value"))))
    dec = values.select("src", "src_id", F.from_json(F.col("value"), PROPS_SCHEMA).alias("m"))
    return dec.select("src", "src_id", F.col("m.k").alias("k"))


def q_typed_projection(spark: SparkSession, root: str) -> DataFrame:
    ev = table(spark, root, "events")
    return ev.select(F.col("event_id").alias("movie_id"),
                     to_number(F.get_json_object("props", "$.k"), "int").alias("votes"),
                     to_number("event_type", "int").alias("year"),
                     # decimal text, whose whole part counts
                     to_number(F.concat(F.col("event_id").cast("string"), F.lit(".75")), "int").alias("whole"),
                     to_number("value", "double").alias("rating"))


def q_clamp_year(spark: SparkSession, root: str) -> DataFrame:
    o = table(spark, root, "orders")
    return o.select("o_orderkey",
                    clamp_range(F.year("o_orderdate"), 1900, 2030, 0).alias("year"),
                    clamp_range(F.year("o_orderdate") + 34, 1900, 2030, 0).alias("later_year"),
                    clamp_range(year_from_text(F.col("o_orderpriority")), 1900, 2030, 0).alias("priority_year"))


def q_clamp_rating(spark: SparkSession, root: str) -> DataFrame:
    ev = table(spark, root, "events")
    return ev.select("event_id", clamp_range("value", 0.0, 10.0, 0.0).alias("rating"))


def q_clamp_votes(spark: SparkSession, root: str) -> DataFrame:
    c = table(spark, root, "customer")
    return c.select("c_custkey", floor_at(to_number("c_acctbal", "int"), 0, 0).alias("votes"))


def q_nonempty_array(spark: SparkSession, root: str) -> DataFrame:
    d = table(spark, root, "documents").select(
        "doc_id", F.regexp_extract_all("text", F.lit("[0-9]+"), 0).alias("numbers"))
    return keep_nonempty(d, "numbers").select("doc_id", F.size("numbers").alias("n_numbers"))


def q_explode_rows(spark: SparkSession, root: str) -> DataFrame:
    p = table(spark, root, "part")
    return p.select("p_partkey", F.explode(F.split("p_name", " ")).alias("genre"))


def q_preview_rows(spark: SparkSession, root: str) -> DataFrame:
    p = table(spark, root, "part").select(
        "p_partkey", F.col("p_name").alias("title"), F.split("p_name", " ").alias("genres"))
    return batch_preview(p, ["p_partkey"])


def q_delimiter_compat(spark: SparkSession, root: str) -> DataFrame:
    """Top-k whose titles are document texts: with delimiters and line breaks in them, such rows
    are lost in the line-oriented shuffle that the compatibility mode mirrors."""
    d = table(spark, root, "documents").select(
        F.col("doc_id").alias("movie_id"), F.col("text").alias("title"), (F.col("doc_id") % 7 + 2000).cast("int").alias("year"),
        F.col("n_chars").cast("int").alias("votes"), F.lit(5.0).alias("rating"), F.lit("2024").alias("fetched_at"),
        F.col("source").alias("genre"))
    return topk_by_group(d, compat_delimiters=True)


def q_reducer_avg_by_group(spark: SparkSession, root: str) -> DataFrame:
    return reducers.avg_by_genre(part_ratings(spark, root))


def q_reducer_topk_by_group(spark: SparkSession, root: str) -> DataFrame:
    return reducers.top_by_year(order_lines(spark, root))


def q_reducer_bucket_histogram(spark: SparkSession, root: str) -> DataFrame:
    return reducers.rating_buckets(part_ratings(spark, root))


def q_first_in_input_order(spark: SparkSession, root: str) -> DataFrame:
    """Line items land in files in an order of their own; of each part the line that stands first
    in the files is kept, whatever shuffles come between."""
    li = table(spark, root, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber")
    order = [F.pmod(F.col("l_orderkey") * 7919 + F.col("l_linenumber") * 104_729, F.lit(1_000_003)), F.col("l_orderkey"), F.col("l_linenumber")]
    path = work_path(spark, "landed-lines")
    # files are numbered by range, lines sorted inside
    li.repartitionByRange(8, *order).sortWithinPartitions(*order).select(F.to_json(F.struct("*")).alias("value")).write.text(path)
    lines = read_lines_in_order(spark, path).repartition("value")
    rows = lines.select(F.from_json("value", li.schema).alias("r"), "input_pos").select("r.*", "input_pos")
    return dedup_first(rows, ["l_partkey"], ["input_pos"]).drop("input_pos")


# --- the catalogue flow ---------------------------------------------------------------

def _message_text(df: DataFrame) -> DataFrame:
    return df.withColumns({"genres": _text_array("genres"), "genre_ids": _text_array("genre_ids")})


def q_catalogue_messages(spark: SparkSession, root: str) -> DataFrame:
    return _message_text(catalogue.messages(spark, root))


def q_message_roundtrip(spark: SparkSession, root: str) -> DataFrame:
    return _message_text(catalogue.stored(spark, root, stamp=False))


def q_silver_etl(spark: SparkSession, root: str) -> DataFrame:
    return catalogue.silver(spark, root, materialize=False)


def q_dataset_profile(spark: SparkSession, root: str) -> DataFrame:
    return profile(catalogue.stored(spark, root))


def q_jsonl_roundtrip(spark: SparkSession, root: str) -> DataFrame:
    return catalogue.silver(spark, root, materialize=True, fmt="json")


def q_silver_avg_by_genre(spark: SparkSession, root: str) -> DataFrame:
    return catalogue.avg_rating_by_genre(catalogue.silver(spark, root, materialize=False))


def q_silver_top10_by_year(spark: SparkSession, root: str) -> DataFrame:
    return catalogue.top_by_year(catalogue.silver(spark, root, materialize=False))


def q_silver_rating_buckets(spark: SparkSession, root: str) -> DataFrame:
    return catalogue.rating_buckets(catalogue.silver(spark, root, materialize=False))


TSV_SCHEMA = StructType([StructField("genre", StringType()), StructField("avg_rating", StringType()),
                         StructField("n", LongType())])


def q_tsv_roundtrip(spark: SparkSession, root: str) -> DataFrame:
    path = work_path(spark, "avg-by-group-tsv")
    write_single_result(q_avg_by_group(spark, root), path, order_by=["genre"])
    return spark.read.schema(TSV_SCHEMA).option("sep", "\t").csv(path)


def q_result_order(spark: SparkSession, root: str) -> DataFrame:
    """The top-k's result file read back with its line numbers: the order of a result counts."""
    path = work_path(spark, "top-tsv")
    write_single_result(q_topk_by_group(spark, root), path)
    lines = spark.read.text(path, wholetext=True)  # one file, one row
    return lines.select(F.posexplode(F.split(F.rtrim(F.col("value"), F.lit("\n")), "\n")).alias("line_no", "line"))


def q_numbered_lines(spark: SparkSession, root: str) -> DataFrame:
    """All orders as lines of one ordered result, numbered over its sorted parts."""
    orders = table(spark, root, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    return ordered_lines(orders.orderBy(F.desc("o_totalprice"), "o_orderkey").drop("o_totalprice"))


def q_catalog_pages(spark: SparkSession, root: str) -> DataFrame:
    """Landed pages and the category document are written as JSON text, read back with
    their fixed schemas, flattened, and the category ids resolved to names."""
    raw = raw_catalogue(spark, root)
    record_cols = ["id", "title", "original_title", "genre_ids", "release_date", "vote_average",
                   "vote_count", "overview", "popularity", "adult", "original_language"]
    pages = raw.select(F.to_json(F.struct(F.col("id").alias("page"),
                                          F.array(F.struct(*record_cols)).alias("results"))).alias("value"))
    pages_path = work_path(spark, "pages")
    # pages are the largest thing written: compressed, in files that a task each reads whole
    pages.write.mode("overwrite").option("compression", "gzip").option("maxRecordsPerFile", 1_000_000).text(pages_path)
    # documents of at most 10 categories each, so that no row grows with the dimension
    doc_path = work_path(spark, "genre-doc")
    (nation_names(spark, root).groupBy(F.floor(F.col("id") / 10).alias("part"))
        .agg(F.to_json(F.struct(F.array_sort(F.collect_list(F.struct("id", "name"))).alias("genres"))).alias("value"))
        .select("value").write.mode("overwrite").text(doc_path))
    recs = records_from_pages(read_pages(spark, pages_path))
    names = genre_dim_from_doc(read_genre_doc(spark, doc_path))
    out = lookup_names(recs, "genre_ids", names, "id", "name", "genres")
    return out.select("page", "pos", "id", "title", _text_array("genres").alias("genres"))


def q_etl_job(spark: SparkSession, root: str) -> DataFrame:
    """The batch ETL job on the stored documents: counts observed during the silver write,
    distinct counts from the written silver."""
    report = run_etl(spark, catalogue.stored(spark, root), work_path(spark, "silver-etl"), preview_order=None)
    return etl_report_frame(spark, report)


def q_etl_preview(spark: SparkSession, root: str) -> DataFrame:
    """The ETL's ordered preview: the first five silver rows by id and genre."""
    report = run_etl(spark, catalogue.stored(spark, root), work_path(spark, "silver-etl"))
    return spark.createDataFrame([tuple(r.values()) for r in report.preview],
                                 "title string, year int, rating double, votes int, genre string")


def q_preview_ordered(spark: SparkSession, root: str) -> DataFrame:
    return preview_rows(table(spark, root, "orders"), ["o_orderkey", "o_totalprice"], ["o_totalprice", "o_orderkey"], 20)


def q_read_table(spark: SparkSession, root: str) -> DataFrame:
    """The stored documents, written as JSON lines and read through the generic reader with
    their fixed schema."""
    path = work_path(spark, "stored-json")
    catalogue.stored(spark, root).write.mode("overwrite").json(path)
    return _message_text(read_table(spark, "json", path, schema=MESSAGE))


def q_topic_sink(spark: SparkSession, root: str) -> DataFrame:
    """Messages published through the topic writer (a file sink stands in for the broker) and
    read back as text."""
    path = work_path(spark, "topic")
    ev = table(spark, root, "events").select("event_id", "event_type", "value")
    write_topic(ev, fmt="text", path=path, fields=["event_id", "event_type", "value"])
    return spark.read.text(path)


def q_analytics_job(spark: SparkSession, root: str, fmt: str = "json") -> DataFrame:
    """ETL, then the three analytics over the written silver; every line of the three TSV
    result files read back as text."""
    report = run_etl(spark, catalogue.stored(spark, root), work_path(spark, "silver-etl"), fmt=fmt)
    paths = run_analytics(spark, report.path, work_path(spark, "results"), fmt=fmt)
    frames = [spark.read.text(p).select(F.lit(name).alias("result"), F.col("value").alias("line"))
              for name, p in paths.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def q_analytics_job_columnar(spark: SparkSession, root: str) -> DataFrame:
    """The same jobs with a columnar (Parquet) silver instead of JSONL."""
    return q_analytics_job(spark, root, fmt="parquet")


def q_silver_lenient_avg(spark: SparkSession, root: str) -> DataFrame:
    """Silver written with every number as JSON text (``"rating": "7.5"``), read back with
    the lenient reader, then the average per genre."""
    rows = catalogue.silver(spark, root, materialize=False)
    numeric = [f.name for f in rows.schema.fields if f.dataType.simpleString() in ("int", "double")]
    as_text = rows.withColumns({c: F.col(c).cast("string") for c in numeric})
    path = work_path(spark, "silver-text")
    write_jsonl(as_text, path)
    return catalogue.avg_rating_by_genre(read_silver(spark, path, lenient=True))


def _land_bad_silver(spark: SparkSession, root: str) -> str:
    """JSON lines with every kind of value the lenient analytics meet, by order key: good
    numbers, numbers as text, unparsable ratings, votes, years, titles that are no text,
    explicit nulls, missing fields, lines that are no JSON, repeated keys, NaN, and numbers with a
    suffix."""
    o = table(spark, root, "orders")
    k = F.col("o_orderkey") % 12
    text = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    rating = (F.pmod("o_custkey", F.lit(50)) / 5.0 + 0.2).cast("string")
    votes = F.col("o_totalprice").cast("int").cast("string")
    year = F.year("o_orderdate").cast("string")
    line = F.concat(
        F.lit('{"movie_id": '), F.col("o_orderkey").cast("string"), F.lit(', "genre": '), text(F.when(k == 10, F.lit("odd")).otherwise(F.col("o_orderpriority"))),
        F.lit(', "fetched_at": "2024-01-01 00:00:00", "title": '),
        F.when(k == 1, F.lit("17")).otherwise(text(F.col("o_orderstatus"))),
        F.lit(', "rating": '), F.when(k == 2, F.lit('"abc"')).when(k == 3, F.lit("null")).when(k == 4, text(rating))
        .when(k == 9, F.concat(F.lit('"abc", "rating": '), rating)).when(k == 10, F.lit("NaN"))
        .when(k == 11, text(F.concat(rating, F.lit("d")))).otherwise(rating),
        F.when(k == 5, F.lit("")).otherwise(F.concat(F.lit(', "votes": '), F.when(k == 6, F.lit('"7.5"')).otherwise(votes))),
        F.lit(', "year": '), F.when(k == 7, F.lit('"soon"')).when(k == 8, text(year)).otherwise(year), F.lit("}"))
    path = work_path(spark, "silver-bad")
    o.select(F.when(k == 0, F.concat(line, F.lit(" trailing {"))).otherwise(line).alias("value")).write.mode("overwrite").text(path)
    return path


def q_lenient_avg(spark: SparkSession, root: str) -> DataFrame:
    return avg_by_group(read_silver(spark, _land_bad_silver(spark, root), lenient=True), exact_scale=1)


def q_lenient_topk(spark: SparkSession, root: str) -> DataFrame:
    return topk_by_group(read_silver(spark, _land_bad_silver(spark, root), lenient=True))


def q_lenient_buckets(spark: SparkSession, root: str) -> DataFrame:
    """NaN falls into the top bucket, as it is below no edge."""
    return bucket_histogram(read_silver(spark, _land_bad_silver(spark, root), lenient=True))


# --- streaming --------------------------------------------------------------------------

EVENT_MSG_SCHEMA = StructType([StructField("event_id", LongType()), StructField("user_id", LongType()),
                               StructField("event_type", StringType()), StructField("value", DoubleType()),
                               StructField("props", StringType()), StructField("ts", StringType())])
EVENT_FIELDS = [f.name for f in EVENT_MSG_SCHEMA.fields]


def _land_event_messages(spark: SparkSession, root: str, copies: int = 1) -> str:
    """Write every event as one JSON message line into a landing folder (``copies`` times),
    one file per partition of the events scan, as a broker topic has one log per partition."""
    ev = table(spark, root, "events").withColumn("ts", micros_text("ts"))
    path = work_path(spark, "landing")
    enc = encode_messages(ev, EVENT_FIELDS)
    for i in range(copies):
        enc.write.mode("append").text(f"{path}/copy={i}")
    return path


def _run_stream(spark, landing: str, dedup: bool = False, max_files: int | None = None):
    opts = {"maxFilesPerTrigger": str(max_files)} if max_files else {}
    src = read_stream(spark, "text", options={**opts, "recursiveFileLookup": "true"}, path=landing,
                      schema=StructType([StructField("value", StringType())]))
    rows = message_stream(src, schema=EVENT_MSG_SCHEMA)
    out = work_path(spark, "stored")
    counter = BatchCounter()
    if dedup:
        rows = dedup_stream(rows, key="event_id")
    sink = batch_sink(out, counter=counter, key="event_id")
    q = start_ingest(rows, sink, checkpoint=work_path(spark, "stream-ckpt"), trigger={"availableNow": True})
    q.awaitTermination()
    return q, out, counter


def q_stream_append(spark: SparkSession, root: str) -> DataFrame:
    _, out, _ = _run_stream(spark, _land_event_messages(spark, root))
    return spark.read.parquet(out).drop("processed_at", "batch_id")


def _land_places(lines: DataFrame, landing: str, places: range) -> int:
    """Land the ``value`` lines of each of ``places`` in turn, every task writing its own file as
    it reads, and give the files of a place (those of one micro-batch).  Dealt by place instead, a
    place would be one task's, sorted whole before its one file is written."""
    spark = lines.sparkSession
    files = 0
    for p in places:
        at = f"{landing}/place={p}"
        lines.filter(F.col("place") == p).select("value").write.text(at)
        files += len(spark.read.text(at).inputFiles())
    return max(1, -(-files // len(places)))


def q_stream_dedup(spark: SparkSession, root: str) -> DataFrame:
    """Every event twice, in files of shuffled event time that arrive over several
    micro-batches: each id is stored once and none is lost."""
    ev = table(spark, root, "events").withColumn("ts", micros_text("ts"))
    landing = work_path(spark, "landing-shuffled")
    twice = ev.withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1))))
    files = twice.withColumn("place", F.pmod(F.xxhash64("event_id", "copy"), F.lit(6)))
    use_rocksdb(spark)  # the ids seen are state that grows with the events
    max_files = _land_places(files.select("place", F.to_json(F.struct(*EVENT_FIELDS)).alias("value")), landing, range(6))
    _, out, _ = _run_stream(spark, landing, dedup=True, max_files=max_files)
    return spark.read.parquet(out).drop("processed_at", "batch_id")


def _copies_of_events(spark: SparkSession, root: str) -> DataFrame:
    """Message lines: every event three times, as it is, with its type in capitals and a day later,
    and its ``props``, which hold no event id; ``place`` deals them over eight files."""
    ev = table(spark, root, "events")
    copies = F.array(F.struct("ts", "event_type"), F.struct("ts", F.upper("event_type").alias("event_type")),
                     F.struct((F.col("ts") + F.expr("interval 1 day")).alias("ts"), F.col("event_type")))
    three = ev.select("event_id", "user_id", "value", "props", F.posexplode(copies).alias("copy", "c"))
    three = three.select("event_id", "user_id", "c.event_type", "value", "props", micros_text("c.ts").alias("ts"), "copy")
    place = lambda *c: F.pmod(F.xxhash64(*c), F.lit(8)).alias("place")
    return three.select(place("event_id", "copy"), F.to_json(F.struct(*EVENT_FIELDS)).alias("value")).unionByName(
        ev.select(place("event_id"), F.coalesce("props", F.lit("")).alias("value")))


def _run_in_two_parts(spark: SparkSession, lines: DataFrame, transform, sink, name: str):
    """Half of the files land and a query takes them in, a place per micro-batch, and ends; the
    others land and it is started again from its checkpoint.  Yields the ended queries."""
    landing, checkpoint = work_path(spark, "landing-copies"), work_path(spark, "stream-ckpt")
    use_rocksdb(spark)
    for part in (range(4), range(4, 8)):
        max_files = _land_places(lines, landing, part)
        src = read_stream(spark, "text", options={"maxFilesPerTrigger": str(max_files), "recursiveFileLookup": "true"}, path=landing,
                          schema=StructType([StructField("value", StringType())]))
        rows = transform(message_stream(src, schema=EVENT_MSG_SCHEMA).drop("processed_at"))
        q = start_ingest(rows, sink, checkpoint, trigger={"availableNow": True}, query_name=name)
        q.awaitTermination()
        yield q


def q_stream_first_by_order(spark: SparkSession, root: str) -> DataFrame:
    """Repeats of an event arrive in any order over eight micro-batches and a restart; what is
    stored stands for the first by time and type."""
    use_rocksdb(spark)
    out = work_path(spark, "stored")
    for _ in _run_in_two_parts(spark, _copies_of_events(spark, root),
                               lambda rows: first_by_order(rows.filter(F.col("event_id").isNotNull()), "event_id", ["ts", "event_type"]),
                               batch_sink(out, key="event_id"), f"first-{uuid.uuid4().hex[:8]}"):
        pass
    return latest_revisions(spark.read.parquet(out).drop("batch_id"), "event_id").drop("revision")


def q_stream_progress(spark: SparkSession, root: str) -> DataFrame:
    """Rows arrived, malformed, repeated and kept, from the durable records of a query with
    de-duplication that was restarted; and the rows in store and dead letter."""
    out, dead, records = work_path(spark, "stored"), work_path(spark, "dead-letter"), work_path(spark, "progress")
    name = f"progress-{uuid.uuid4().hex[:8]}"
    ledger = ProgressLedger(spark, records, name)
    spark.streams.addListener(ledger)
    try:
        for q in _run_in_two_parts(spark, _copies_of_events(spark, root),
                                   lambda rows: observe_kept(dedup_stream(observe_arrived(rows, "event_id"), "event_id")),
                                   batch_sink(out, key="event_id", dead_letter=dead), name):
            ledger.settle(q)
    finally:
        spark.streams.removeListener(ledger)
    stored, letters = spark.read.parquet(out), spark.read.parquet(dead)
    return totals(spark, records).select("rows", "malformed", "repeated", "kept",
                                         stored.agg(F.count(F.lit(1))).scalar().alias("stored"),
                                         letters.agg(F.count(F.lit(1))).scalar().alias("dead_letters"))


def q_stream_quarantine(spark: SparkSession, root: str) -> DataFrame:
    """Every event as a valid message, plus messages that carry no event id: each
    document's text as ``{"title": ...}`` and each event's ``props`` object.  The stream
    stores the first kind and sends the rest to the dead-letter table; counts come from
    both tables and from the per-batch counter; the dead letter keeps the messages' text."""
    ev = table(spark, root, "events").withColumn("ts", micros_text("ts"))
    docs = table(spark, root, "documents")
    landing = work_path(spark, "landing-mixed")
    encode_messages(ev, EVENT_FIELDS).write.mode("overwrite").text(f"{landing}/events")
    (docs.select(F.to_json(F.struct(F.col("text").alias("title"))).alias("value"))
         .write.mode("overwrite").text(f"{landing}/documents"))
    ev.select(F.coalesce(F.col("props"), F.lit("")).alias("value")).write.mode("overwrite").text(f"{landing}/props")
    src = read_stream(spark, "text", options={"recursiveFileLookup": "true"}, path=landing,
                      schema=StructType([StructField("value", StringType())]))
    rows = message_stream(src, schema=EVENT_MSG_SCHEMA, metrics="ingest", raw="raw")
    store, dead = work_path(spark, "stored"), work_path(spark, "dead-letter")
    counter = BatchCounter()
    q = start_ingest(rows, batch_sink(store, dead_letter=dead, key="event_id", counter=counter),
                     checkpoint=work_path(spark, "stream-ckpt"), trigger={"availableNow": True})
    q.awaitTermination()
    seen = counter.totals
    letters = spark.read.parquet(dead)
    dead_rows, dead_chars = letters.agg(F.count(F.lit(1))).scalar(), letters.agg(F.sum(F.length("raw"))).scalar()
    return spark.read.parquet(store).agg(F.count(F.lit(1)).alias("stored_rows")).select(
        "stored_rows", dead_rows.alias("dead_rows"), dead_chars.alias("dead_chars"),
        F.lit(seen["rows"]).cast("long").alias("observed_rows"),
        F.lit(seen["malformed"]).cast("long").alias("observed_malformed"))


def q_message_sink(spark: SparkSession, root: str) -> DataFrame:
    ev = table(spark, root, "events").select("event_id", "event_type", "value")
    return encode_messages(ev, ["event_id", "event_type", "value"], key="event_id")


def q_stream_metrics(spark: SparkSession, root: str) -> DataFrame:
    """Rows arrived and stored over all micro-batches, by the per-batch counter and by the
    stored table."""
    _, out, counter = _run_stream(spark, _land_event_messages(spark, root), max_files=1)
    totals = counter.totals
    return spark.read.parquet(out).agg(F.count(F.lit(1)).alias("rows")).select(
        "rows", F.lit(totals["rows"]).cast("long").alias("input_rows"), F.lit(totals["stored"]).cast("long").alias("callback_rows"))


QUERIES = {
    "avg_by_group": q_avg_by_group,
    "topk_by_group": q_topk_by_group,
    "bucket_histogram": q_bucket_histogram,
    "id_name_lookup": q_id_name_lookup,
    "array_lookup": q_array_lookup,
    "year_from_text": q_year_from_text,
    "round_1dp": q_round_1dp,
    "dedup_first": q_dedup_first,
    "json_encode_decode": q_json_encode_decode,
    "json_malformed": q_json_malformed,
    "typed_projection": q_typed_projection,
    "clamp_year": q_clamp_year,
    "clamp_rating": q_clamp_rating,
    "clamp_votes": q_clamp_votes,
    "nonempty_array": q_nonempty_array,
    "explode_rows": q_explode_rows,
    "preview_rows": q_preview_rows,
    "delimiter_compat": q_delimiter_compat,
    "catalogue_messages": q_catalogue_messages,
    "message_roundtrip": q_message_roundtrip,
    "silver_etl": q_silver_etl,
    "dataset_profile": q_dataset_profile,
    "jsonl_roundtrip": q_jsonl_roundtrip,
    "silver_avg_by_genre": q_silver_avg_by_genre,
    "silver_top10_by_year": q_silver_top10_by_year,
    "silver_rating_buckets": q_silver_rating_buckets,
    "tsv_roundtrip": q_tsv_roundtrip,
    "catalog_pages": q_catalog_pages,
    "etl_job": q_etl_job,
    "analytics_job": q_analytics_job,
    "analytics_job_columnar": q_analytics_job_columnar,
    "silver_lenient_avg": q_silver_lenient_avg,
    "stream_append": q_stream_append,
    "stream_dedup": q_stream_dedup,
    "stream_quarantine": q_stream_quarantine,
    "message_sink": q_message_sink,
    "stream_metrics": q_stream_metrics,
    "array_lookup_large": q_array_lookup_large,
    "enrich_repeated_ids": q_enrich_repeated_ids,
    "field_mapping_defaults": q_field_mapping_defaults,
    "text_shapes": q_text_shapes,
    "result_order": q_result_order,
    "numbered_lines": q_numbered_lines,
    "etl_preview": q_etl_preview,
    "preview_ordered": q_preview_ordered,
    "read_table": q_read_table,
    "topic_sink": q_topic_sink,
    "lenient_avg": q_lenient_avg,
    "lenient_topk": q_lenient_topk,
    "lenient_buckets": q_lenient_buckets,
    "reducer_avg_by_group": q_reducer_avg_by_group,
    "reducer_topk_by_group": q_reducer_topk_by_group,
    "reducer_bucket_histogram": q_reducer_bucket_histogram,
    "first_in_input_order": q_first_in_input_order,
    "stream_first_by_order": q_stream_first_by_order,
    "stream_progress": q_stream_progress,
}
