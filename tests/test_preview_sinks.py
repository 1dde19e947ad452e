"""Previews (K7, K8, L1) and the remaining sink/source entry points (K1, S3)."""

import json
import os
import tempfile

import pytest

from marquee.operators.preview import batch_preview, preview_rows
from marquee.sinks.writers import merged_lines, ordered_lines, write_ordered_result, write_single_result, write_topic
from marquee.sources.readers import read_table


def movies(spark, n):
    rows = [(i, f"Title {i} " + "x" * (i % 60), ["a", "b", "c", "d"][: i % 5] or None) for i in range(n)]
    return spark.createDataFrame(rows, "id int, title string, genres array<string>").repartition(4)


def test_preview_rows_first_n_by_order(spark):
    df = movies(spark, 40)
    got = [r.id for r in preview_rows(df, ["id", "title"], ["id"], n=5).collect()]
    assert got == [0, 1, 2, 3, 4]


def test_batch_preview_lines(spark):
    df = movies(spark, 23)
    got = batch_preview(df, ["id"]).collect()
    assert [r.idx for r in got] == list(range(1, 11))
    for r in got:
        i = r.idx - 1
        title = f"Title {i} " + "x" * (i % 60)
        genres = ["a", "b", "c", "d"][: i % 5]
        assert r.title_line == f"{title[:45]:<45}"
        assert r.genres_line == ", ".join(genres[:3])
        assert r.batch_rows == 23 and r.more_rows == 13
    small = batch_preview(movies(spark, 4), ["id"]).collect()
    assert len(small) == 4 and all(r.more_rows == 0 for r in small)


def test_write_topic_through_a_file_sink_and_read_table(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="marquee-topic-"), "values")
    df = spark.createDataFrame([(1, "t", None)], "id int, title string, rating double")
    write_topic(df, fmt="json", path=path, fields=["id", "title", "rating"], key="id")
    back = read_table(spark, "json", path, schema="key string, value string").first()
    assert back.key == "1" and json.loads(back.value) == {"id": 1, "title": "t", "rating": None}


@pytest.fixture
def many_parts(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small parts stay apart
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def text_of(path):
    names = sorted(n for n in os.listdir(path) if n.startswith("part-"))
    return names, "".join(open(os.path.join(path, n), encoding="utf-8").read() for n in names)


def test_a_long_ordered_result_is_merged_from_sorted_parts(spark, many_parts):
    n = 1_000_000
    df = spark.range(n).selectExpr("id", "(id * 7919) % 1000003 AS k").repartition(8)
    want = "".join(f"{i}\t{k}\n" for k, i in sorted((i * 7919 % 1000003, i) for i in range(n)))
    root = tempfile.mkdtemp(prefix="marquee-ordered-")
    write_single_result(df, f"{root}/one", order_by=["k"])
    names, text = text_of(f"{root}/one")
    assert len(names) == 1 and text == want
    write_ordered_result(df, f"{root}/parts", order_by=["k"])
    names, text = text_of(f"{root}/parts")
    assert len(names) > 4 and text == want
    manifest = sorted((r.part, r.first, r.n) for r in spark.read.json(f"{root}/parts/_manifest").collect())
    assert [f for _, f, _ in manifest] == [sum(m[2] for m in manifest[:i]) for i in range(len(manifest))]
    assert sum(m[2] for m in manifest) == n
    assert spark.read.text(f"{root}/parts").count() == n  # readers skip the manifest


def test_the_merging_task_neither_sorts_nor_shuffles(spark, many_parts):
    plan = merged_lines(movies(spark, 300).select("id", "title"), order_by=["id"])._jdf.queryExecution().executedPlan().toString()
    above = plan[:plan.index("Coalesce")]
    assert "Sort" not in above and "Exchange" not in above
    stream = [x for x in plan.split("BroadcastExchange")[0].splitlines() if "Sort" in x or "Exchange hash" in x or "Exchange range" in x]
    assert not stream


def test_numbered_lines_edges(spark, many_parts):
    df = spark.createDataFrame([(2, "b\nc"), (1, None), (1, None), (3, "")], "k int, v string")
    got = sorted((r.line_no, r.line) for r in ordered_lines(df, ["k"]).collect())
    assert got == [(0, "1\t"), (1, "1\t"), (2, "2\tb\nc"), (3, "3\t")]
    assert ordered_lines(df.limit(0), ["k"]).count() == 0
    path = os.path.join(tempfile.mkdtemp(prefix="marquee-empty-"), "one")
    write_single_result(df.limit(0), path, order_by=["k"])
    assert text_of(path)[1] == ""
