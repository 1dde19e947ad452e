"""Inputs that queries land for themselves: no task holds a whole file, pages are compressed."""

import glob
import inspect

from pyspark.sql import functions as F

from marquee.plans import queries
from marquee.session import work_path


def _events(folder, spark, n):
    e = spark.range(n).select(F.col("id").alias("event_id"), F.timestamp_seconds(F.col("id") + 1_700_000_000).alias("ts"),
                              (F.col("id") % 7).alias("user_id"), F.lit("view").alias("event_type"),
                              (F.col("id") / 3.0).alias("value"), F.lit('{"a": 1}').alias("props"))
    e.repartition(4).write.parquet(f"{folder}/events.parquet")
    return str(folder)


def test_places_land_as_a_file_per_task(spark):
    lines = spark.range(0, 4000, 1, 4).select(F.pmod("id", F.lit(5)).alias("place"), F.col("id").cast("string").alias("value"))
    at = work_path(spark, "landing")
    assert queries._land_places(lines, at, range(5)) == 4
    back = spark.read.text(at)
    assert back.count() == 4000 and back.filter("pmod(cast(value as long), 5) <> place").count() == 0
    assert len(back.inputFiles()) == 20


def test_every_event_is_stored_once_from_many_files(spark, tmp_path):
    root = _events(tmp_path, spark, 500)
    out = queries.q_stream_dedup(spark, root)
    assert out.count() == 500 and out.select("event_id").distinct().count() == 500
    t = queries.q_stream_progress(spark, root).first()
    assert (t["rows"], t["malformed"], t["repeated"], t["kept"], t["stored"], t["dead_letters"]) == (2000, 500, 1000, 1000, 500, 500)
    # neither deals a place to one task
    for q in (queries.q_stream_dedup, queries._run_in_two_parts):
        assert "repartition(" not in inspect.getsource(q)


def test_catalogue_pages_are_written_compressed(spark, monkeypatch):
    paths = []

    def at(spark, name):
        paths.append(work_path(spark, name))
        return paths[-1]

    cols = ("id long, title string, original_title string, genre_ids array<int>, release_date string, vote_average double, "
            "vote_count int, overview string, popularity double, adult boolean, original_language string")
    raw = spark.createDataFrame([(i, f"t{i}", "o", [1, 99], "2024-01-01", 5.0, i, "x", 1.0, False, "o") for i in range(30)], cols)
    monkeypatch.setattr(queries, "work_path", at)
    monkeypatch.setattr(queries, "raw_catalogue", lambda *_: raw)
    monkeypatch.setattr(queries, "nation_names", lambda *_: spark.createDataFrame([(1, "one")], "id int, name string"))
    out = queries.q_catalog_pages(spark, "")
    assert sorted((r["id"], r["genres"]) for r in out.collect()) == [(i, "one|Unknown_99") for i in range(30)]
    parts = glob.glob(f"{paths[0].removeprefix('file:')}/part-*")
    assert parts and all(p.endswith(".gz") for p in parts)
