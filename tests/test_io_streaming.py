"""Sinks / readers round trips and the streaming ingest (file source stands in for the broker)."""

import json
import os
import tempfile

from pyspark.sql.types import StringType, StructField, StructType

from marquee.operators.analytics import avg_by_group
from marquee.schemas import SILVER, SILVER_FIELDS
from marquee.sinks.writers import append_batch, write_jsonl, write_single_result, write_tsv
from marquee.sources.readers import read_silver
from marquee.streaming.ingest import (BatchCounter, batch_sink, dedup_stream, message_stream, read_stream,
                                      start_ingest)

VALUE = StructType([StructField("value", StringType())])


def fresh(prefix):
    return tempfile.mkdtemp(prefix=f"marquee-{prefix}-")


def silver_rows(spark):
    rows = [(1, "T", None, 2020, 7.5, 10, "Drama", None, 1.0, "en", "2020-01-01", "popular", "2024-01-01 00:00:00"),
            (2, "U", "u", 0, 0.0, 0, None, "o", None, "", "", "popular", None)]
    return spark.createDataFrame(rows, SILVER)


def test_jsonl_roundtrip_omits_nulls(spark):
    path = os.path.join(fresh("jsonl"), "silver")
    df = silver_rows(spark)
    write_jsonl(df, path)
    write_jsonl(df, path)                                 # overwrite, not append
    lines = [json.loads(l) for f in sorted(os.listdir(path)) if f.endswith(".json")
             for l in open(os.path.join(path, f)) if l.strip()]
    assert len(lines) == 2 and "original_title" not in lines[0]
    back = read_silver(spark, path)
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)


def test_lenient_silver_reader(spark):
    path = fresh("lenient")
    with open(os.path.join(path, "part-0.json"), "w") as f:
        f.write(json.dumps({"movie_id": "5", "rating": "7.5", "year": 2001, "genre": "g"}) + "\n\n")
        f.write(json.dumps({"movie_id": 6, "rating": "x", "year": "bad", "genre": "g"}) + "\n")
    got = {r.movie_id: r for r in read_silver(spark, path, lenient=True).collect()}
    assert got[5].rating == 7.5 and got[5].year == 2001
    assert got[6].rating is None and got[6].year is None
    assert sorted(got[6].bad_fields) == ["rating", "year"] and got[5].bad_fields == []
    assert read_silver(spark, path, lenient=True).columns == SILVER_FIELDS + ["bad_fields"]


def test_lenient_lines_by_python_rules(spark):
    """Repeated keys, NaN and Infinity, underscores, suffixes, signs: as json.loads, int() and float()."""
    import math
    lines = ['{"movie_id": 1, "rating": "x", "rating": 7.5, "title": "a: NaN, b"}', '{"movie_id": 2, "rating": NaN}',
             '{"movie_id": 3, "rating": -Infinity}', '{"movie_id": 4, "rating": "7.5d", "votes": "8L", "year": "2020f"}',
             '{"movie_id": 5, "rating": " 1_0.5e1 ", "votes": "+1_000", "year": "-7"}', '{"movie_id": 6, "rating": "inf", "votes": "1_", "year": "0x10"}',
             '{"movie_id": 7, "rating": 1e400, "votes": NaN}', '{"movie_id": 8},{"movie_id": 9}', '[1]', '"x"', '{"movie_id": 10', "NaN", ""]
    path = fresh("lenient-python")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("overwrite").text(path)
    got = {r.movie_id: r for r in read_silver(spark, path, lenient=True).collect()}
    assert sorted(got) == [1, 2, 3, 4, 5, 6, 7]
    assert (got[1].rating, got[1].title, got[1].bad_fields) == (7.5, "a: NaN, b", [])
    assert math.isnan(got[2].rating) and got[3].rating == -math.inf and got[6].rating == got[7].rating == math.inf
    assert (got[4].rating, got[4].votes, got[4].year) == (None, None, None) and sorted(got[4].bad_fields) == ["rating", "votes", "year"]
    assert (got[5].rating, got[5].votes, got[5].year) == (105.0, 1000, -7)
    assert sorted(got[6].bad_fields) == ["votes", "year"] and got[7].bad_fields == ["votes"]


def test_lenient_rows_with_bad_values_are_dropped(spark):
    path = fresh("lenient-bad")
    lines = ['{"movie_id": 1, "title": "good", "year": "2001", "votes": 9, "rating": 7.5}',
             '{"movie_id": 2, "title": "bad rating", "year": 2001, "votes": 99, "rating": "abc"}',
             '{"movie_id": 2, "title": "seen already", "year": 2001, "votes": 98, "rating": 5, "fetched_at": "9"}',
             '{"movie_id": 3, "title": 5, "year": 2001, "votes": 50, "rating": 5}',
             '{"movie_id": 4, "title": "no rating", "year": 2001, "votes": 7}',
             '{"movie_id": 5, "title": "null", "year": 2001, "votes": null, "rating": 5}',
             '{"movie_id": 6, "title": "float votes", "year": 2001.9, "votes": 8.9, "rating": true}',
             '{"movie_id": 7, "title": "tail", "year": 2001, "votes": 70, "rating": 5} {}', "[1]", "3", "{bad", ""]
    with open(os.path.join(path, "part-0.json"), "w") as f:
        f.write("\n".join(lines))
    from marquee.operators.analytics import topk_by_group
    silver = read_silver(spark, path, lenient=True)
    first = topk_by_group(silver, first_by=("fetched_at",))
    # row 2: its first line by fetched_at has a value there (NULLs last), so the other is a repeat
    assert [(r.title, r.votes, r.rating) for r in first.collect()] == [
        ("seen already", 98, "5.0"), ("good", 9, "7.5"), ("float votes", 8, "1.0"), ("no rating", 7, "0.0")]


def test_tsv_single_file(spark):
    rows = [("g", 5.0)] * 60 + [("a", 7.0)] * 55
    res = avg_by_group(spark.createDataFrame(rows, "genre string, rating double"))
    path = os.path.join(fresh("tsv"), "q1")
    write_single_result(res, path, order_by=["genre"])
    parts = [f for f in os.listdir(path) if f.startswith("part-")]
    assert len(parts) == 1
    assert open(os.path.join(path, parts[0])).read().splitlines() == ["a\t7.00\t55", "g\t5.00\t60"]
    write_tsv(res, path + "-parts")


def test_append_batch_is_idempotent(spark):
    path = os.path.join(fresh("append"), "stored")
    df = spark.createDataFrame([(1,), (2,)], "id int")
    append_batch(df, path, 0)
    append_batch(df, path, 1)
    append_batch(df, path, 1)                              # replay of batch 1
    got = spark.read.parquet(path)
    assert got.count() == 4 and sorted(r.batch_id for r in got.select("batch_id").distinct().collect()) == [0, 1]


def land(dirpath, name, messages):
    with open(os.path.join(dirpath, name), "w") as f:
        for m in messages:
            f.write(m + "\n")


def msg(i, title="t", fetched="2024-01-01 00:00:00"):
    return json.dumps({"id": i, "title": title, "genres": ["g"], "fetched_at": fetched})


def run_available(spark, src, out, ckpt, dedup=False, counter=None, preview=None, dead=None, max_files=None):
    opts = {"maxFilesPerTrigger": str(max_files)} if max_files else {}
    stream = message_stream(read_stream(spark, "text", options=opts, path=src, schema=VALUE), raw="raw" if dead else None)
    if dedup:
        stream = dedup_stream(stream, key="id")
    q = start_ingest(stream, batch_sink(out, counter=counter, preview=preview, dead_letter=dead), checkpoint=ckpt,
                     trigger={"availableNow": True})
    q.awaitTermination()
    return q


def test_stream_append_restart_and_malformed(spark):
    base = fresh("stream")
    src, out, ckpt = (os.path.join(base, p) for p in ("in", "out", "ckpt"))
    os.makedirs(src)
    land(src, "a.json", [msg(1), msg(2), "{bad", ""])
    counter = BatchCounter()
    run_available(spark, src, out, ckpt, counter=counter)
    first = spark.read.parquet(out)
    assert first.count() == 4                              # malformed and empty lines kept as NULL rows
    assert first.filter("id IS NULL").count() == 2 and first.filter("processed_at IS NULL").count() == 0
    land(src, "b.json", [msg(3)])
    run_available(spark, src, out, ckpt, counter=counter)  # restart: only the new file is read
    assert sorted(r.id for r in spark.read.parquet(out).filter("id IS NOT NULL").collect()) == [1, 2, 3]
    assert counter.totals == {"rows": 5, "malformed": 2, "stored": 5}
    run_available(spark, src, out, ckpt)                   # nothing new: an empty run changes nothing
    assert spark.read.parquet(out).count() == 5


def test_stream_dedup_over_batches_restart_and_bad_times(spark):
    base = fresh("dedup")
    src, out, ckpt, dead = (os.path.join(base, p) for p in ("in", "out", "ckpt", "dead"))
    os.makedirs(src)
    # each id in two files, event times far apart and shuffled, one that is no time at all
    times = ["2024-01-01 00:00:00", "2030-01-01 00:00:00", "1999-01-01 00:00:00", "yesterday"]
    for i in range(8):
        land(src, f"f{i}.json", [msg(10 * (i % 4) + j, fetched=times[(i + j) % 4]) for j in range(10)] + ["{bad", ""])
    run_available(spark, src, out, ckpt, dedup=True, dead=dead, max_files=1)
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(40))
    assert spark.read.parquet(dead).count() == 16          # malformed rows are no repeats of each other
    land(src, "late.json", [msg(3, "again"), msg(99, fetched="1990-01-01 00:00:00")])
    run_available(spark, src, out, ckpt, dedup=True, dead=dead)   # restart: nothing is forgotten
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(40)) + [99]


def test_stream_batch_preview_is_bounded_and_null_safe(spark):
    base = fresh("preview")
    src, out, ckpt = (os.path.join(base, p) for p in ("in", "out", "ckpt"))
    os.makedirs(src)
    land(src, "a.json", [msg(i, title=f"title {i:02d}" + "x" * 50) for i in range(12)] + ["{bad"])
    seen = {}
    run_available(spark, src, out, ckpt, preview=lambda b, lines: seen.setdefault(b, lines))
    (lines,) = seen.values()
    assert [r.idx for r in lines] == list(range(1, 11))
    assert {r.batch_rows for r in lines} == {13} and {r.more_rows for r in lines} == {3}
    assert lines[0].title_line == " " * 45 and lines[0].genres_line == ""   # the malformed row (NULL id first)
    assert lines[1].title_line == ("title 00" + "x" * 50)[:45] and lines[1].genres_line == "g"


def test_stream_dead_letter_keeps_the_message(spark):
    base = fresh("dead")
    src, out, dead, ckpt = (os.path.join(base, p) for p in ("in", "out", "dead", "ckpt"))
    os.makedirs(src)
    land(src, "a.json", [msg(1), "{bad", msg(2), json.dumps({"title": "no id"}), ""])
    counter = BatchCounter()
    run_available(spark, src, out, ckpt, counter=counter, dead=dead)
    stored = spark.read.parquet(out)
    assert sorted(r.id for r in stored.collect()) == [1, 2] and "raw" not in stored.columns
    d = spark.read.parquet(dead)
    assert sorted(r.raw for r in d.collect()) == ["", '{"title": "no id"}', "{bad"]
    assert counter.totals == {"rows": 5, "malformed": 3, "stored": 2}


def test_batch_counter_totals_over_many_batches_and_a_replay():
    c = BatchCounter()
    for i in range(300):
        c.record(i, rows=2, malformed=1, stored=1)
    c.record(299, rows=5, malformed=0, stored=5)            # replay of the last batch replaces it
    assert c.totals == {"rows": 299 * 2 + 5, "malformed": 299, "stored": 299 + 5}


def test_lenient_lines_are_parsed_once(spark):
    path = fresh("lenient-once")
    spark.createDataFrame([('{"movie_id": "1", "genre": "a", "rating": " 7_0.5 "}',)], "value string").write.mode("overwrite").text(path)
    rows = avg_by_group(read_silver(spark, path, lenient=True), min_count=1)
    assert [tuple(r) for r in rows.collect()] == [("a", "70.50", 1)]
    # the filters on bad values, genre and rating hold no copies of the parser
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1
