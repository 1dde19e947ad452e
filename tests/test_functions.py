"""Scalar expression helpers against Python's own rules."""

import datetime
import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marquee.functions import (bucket_label, clamp_range, count_distinct_with_null, date_text, fixed, floor_at,
                               join_first, micros_text, pad_right, percent_of, prefix, py_round, slug,
                               stamp_text, strip_text, thousands, unknown_name, year_from_text, zero_pad)


def one_col(spark, values, ddl):
    return spark.createDataFrame([(v,) for v in values], f"x {ddl}")


def test_strip_matches_python(spark):
    vals = ["  a b  ", "　Drama　", "\x1cComedy\x1f", "\tTab\t", "\n", "", None, " x ",
            "\x85y ", "mid　dle"]
    got = [r[0] for r in one_col(spark, vals, "string").select(strip_text("x")).collect()]
    assert got == [None if v is None else v.strip() for v in vals]


def test_prefix_counts_code_points(spark):
    vals = ["😀" * 60, "x" * 50, "a" * 49 + " b", None]
    got = [r[0] for r in one_col(spark, vals, "string").select(prefix("x", 50)).collect()]
    assert got == [None if v is None else v[:50] for v in vals]


TIES = [2.675, 1.005, 0.125, 0.375, 7.25, 6.85, 0.35, 1234567.125, 0.0, -0.05, 10.0, 1e20, 2.5, 0.05]


def test_fixed_matches_python_format(spark):
    vals = TIES + [float("nan"), float("inf"), float("-inf")]
    df = one_col(spark, vals, "double").select(fixed("x", 2).alias("a"), fixed("x", 1).alias("b"))
    for v, r in zip(vals, df.collect()):
        assert r.a == "{:.2f}".format(v)
        assert r.b == "{:.1f}".format(v)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.floats(min_value=-1e6, max_value=1e6, allow_nan=False), min_size=1, max_size=40))
def test_fixed_and_round_property(spark, xs):
    df = one_col(spark, xs, "double").select(fixed("x", 2).alias("f"), py_round("x", 1).alias("r"))
    for v, r in zip(xs, df.collect()):
        assert r.f == "{:.2f}".format(v)
        assert r.r == round(v, 1)


def test_py_round_half_way_cases(spark):
    vals = [7.25, 6.85, 0.35, 2.675, None]
    got = [r[0] for r in one_col(spark, vals, "double").select(py_round("x", 1)).collect()]
    assert got == [None if v is None else round(v, 1) for v in vals]


def py_year(text):
    if not text:
        return 0
    try:
        return int(text.split("-")[0])
    except ValueError:
        return 0


def test_year_from_text(spark):
    vals = ["2024-01-15", "", "20x", "1999", "-5", None, "1-URGENT", "O", "2021-"]
    got = [r[0] for r in one_col(spark, vals, "string").select(year_from_text("x")).collect()]
    assert got == [py_year(v) for v in vals]


def test_clamps(spark):
    years = [None, 1899, 1900, 2030, 2031, -1]
    got = [r[0] for r in one_col(spark, years, "int").select(clamp_range("x", 1900, 2030, 0)).collect()]
    assert got == [0, 0, 1900, 2030, 0, 0]
    ratings = [None, -0.1, 0.0, 10.0, 10.1, float("nan")]
    got = [r[0] for r in one_col(spark, ratings, "double").select(clamp_range("x", 0.0, 10.0, 0.0)).collect()]
    assert got == [0.0, 0.0, 0.0, 10.0, 0.0, 0.0]
    votes = [None, -1, 0, 1]
    got = [r[0] for r in one_col(spark, votes, "int").select(floor_at("x", 0, 0)).collect()]
    assert got == [0, 0, 0, 1]


def test_bucket_label(spark):
    expected = [(0.1, "0-2"), (2.0, "2-4"), (3.99, "2-4"), (4.0, "4-6"), (6.0, "6-8"), (7.99, "6-8"), (8.0, "8-10"),
                (11.0, "8-10"), (float("nan"), "8-10")]
    got = [r[0] for r in one_col(spark, [v for v, _ in expected], "double").select(
        bucket_label("x", (2.0, 4.0, 6.0, 8.0), ("0-2", "2-4", "4-6", "6-8", "8-10"))).collect()]
    assert got == [label for _, label in expected]


def test_percent_of_zero_total(spark):
    df = spark.createDataFrame([(1, 3), (0, 0), (5, 0)], "n long, t long")
    got = [r[0] for r in df.select(percent_of("n", "t")).collect()]
    assert math.isclose(got[0], 1 / 3 * 100) and got[1] == 0.0 and got[2] == 0.0


def test_text_shapes(spark):
    df = spark.createDataFrame([("A Title", 7, 1234567, "Now Playing", ["a", None, "b", "c"])],
                               "t string, v int, n long, s string, g array<string>")
    r = df.select(pad_right("t", 10).alias("p"), zero_pad("v", 10).alias("z"), thousands("n").alias("k"),
                  slug("s").alias("s"), join_first("g", 3).alias("j"), unknown_name(F.lit(None).cast("int")).alias("u"),
                  unknown_name("v").alias("u2")).first()
    assert r.p == f"{'A Title':<10}" and r.z == f"{7:010d}" and r.k == f"{1234567:,}"
    assert r.s == "now_playing" and r.j == "a, b" and r.u == "Unknown_None" and r.u2 == "Unknown_7"


def test_count_distinct_with_null(spark):
    df = spark.createDataFrame([(1,), (None,), (1,), (2,), (None,)], "x int")
    assert df.agg(count_distinct_with_null("x")).first()[0] == df.select("x").distinct().count() == 3
    empty = spark.createDataFrame([], "x int")
    assert empty.agg(count_distinct_with_null("x")).first()[0] == 0


def test_timestamp_text_is_wall_clock_in_any_session_zone(spark):
    # 1995-10-15 00:00 does not exist in São Paulo (clocks jumped to 01:00)
    df = spark.createDataFrame([("1995-10-15 00:00:00.000250",), ("2024-01-02 03:04:05",)], "s string") \
              .select(F.col("s").cast("timestamp_ntz").alias("t"))
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        got = [tuple(r) for r in df.select(stamp_text("t"), date_text("t"), micros_text("t")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == [("1995-10-15 00:00:00", "1995-10-15", "1995-10-15 00:00:00.000250"),
                   ("2024-01-02 03:04:05", "2024-01-02", "2024-01-02 03:04:05.000000")]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.datetimes(min_value=datetime.datetime(1900, 1, 1),
                             max_value=datetime.datetime(2100, 12, 31)), min_size=1, max_size=40))
def test_timestamp_text_matches_strftime(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "t timestamp_ntz")
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        got = [tuple(r) for r in df.select(stamp_text("t"), date_text("t"), micros_text("t")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == [(v.strftime("%Y-%m-%d %H:%M:%S"), v.strftime("%Y-%m-%d"), v.strftime("%Y-%m-%d %H:%M:%S.%f"))
                   for v in values]
