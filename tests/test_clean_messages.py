"""ETL cleaning, profile, message decode/encode (FIXTURES §3 edge rows)."""

import json

from pyspark.sql import functions as F

from marquee.operators.clean import keep_nonempty, profile, project_typed, silver_from_stored
from marquee.operators.messages import decode_messages, encode_messages
from marquee.schemas import MESSAGE, MESSAGE_FIELDS, SILVER_FIELDS


def stored_df(spark, docs):
    """Documents as text JSON → typed stored rows (what the stream appends)."""
    values = spark.createDataFrame([(json.dumps(d),) for d in docs], "value string")
    return decode_messages(values, stamp=True)


def test_decode_edge_rows(spark):
    msgs = [json.dumps({"id": 1, "title": "ok", "genres": ["a"]}), "{bad", '{"id": 2, "title": "tr', "", None,
            json.dumps([{"id": 3}]), json.dumps({"id": 4, "year": "2020"}), json.dumps({"id": 5, "votes": 3.9}),
            json.dumps({"id": 6, "rating": 7}), json.dumps({"id": 7, "rating": "7.5"}),
            json.dumps({"id": 99999999999}), json.dumps({"id": 8, "genres": "x"}),
            json.dumps({"id": 9, "genres": ["x", None]}), json.dumps({"id": 10})]
    df = spark.createDataFrame([(m,) for m in msgs], "value string")
    out = decode_messages(df, stamp=False)
    assert out.columns == MESSAGE_FIELDS
    got = out.collect()
    assert len(got) == len(msgs)                                    # one row per message
    by_id = {r.id: r for r in got if r.id is not None}
    assert sum(1 for r in got if all(v is None for v in r)) == 5    # bad, truncated, "", NULL, array
    assert by_id[1].title == "ok" and by_id[1].genres == ["a"]
    assert by_id[4].year is None and by_id[5].votes is None        # wrong JSON type -> NULL field only
    assert by_id[6].rating == 7.0 and by_id[7].rating is None
    assert by_id[8].genres is None and by_id[9].genres == ["x", None]
    assert by_id[10].title is None


def test_decode_stamp_and_quarantine(spark):
    df = spark.createDataFrame([(json.dumps({"id": 1}),), ("{bad",)], "value string")
    good, dead = decode_messages(df, quarantine=True)
    assert "processed_at" in good.columns
    assert [r.id for r in good.collect()] == [1] and dead.count() == 1


def test_encode_writes_nulls_and_roundtrips(spark):
    row = {f: None for f in MESSAGE_FIELDS}
    row.update(id=1, title="t", genres=["a", "b"], rating=7.3)
    df = spark.createDataFrame([row], MESSAGE)
    enc = encode_messages(df)
    text = enc.first().value
    assert json.loads(text)["overview"] is None and '"overview":null' in text
    back = decode_messages(enc, stamp=False).first().asDict()
    assert back == row


def test_cast_edges(spark):
    docs = [{"id": "abc", "year": "2020.7", "rating": "7.5", "votes": 2 ** 40, "genres": ["g"]},
            {"id": 2, "year": 2020.7, "rating": 7, "votes": "12", "genres": ["g"]}]
    # stored documents as read from a schemaless store: every scalar as text
    raw = spark.createDataFrame([(json.dumps(d),) for d in docs], "value string").select(
        *[F.get_json_object("value", f"$.{c}").alias(c) for c in ("id", "year", "rating", "votes", "popularity")],
        F.from_json(F.get_json_object("value", "$.genres"), "array<string>").alias("genres"),
        *[F.lit(None).cast("string").alias(c) for c in ("title", "original_title", "overview", "original_language",
                                                        "release_date", "source", "fetched_at")])
    got = project_typed(raw).orderBy(F.col("votes").asc_nulls_first()).collect()
    # the whole part of a decimal text counts; a number beyond the type's range is NULL
    assert got[0].movie_id is None and got[0].year == 2020 and got[0].rating == 7.5 and got[0].votes is None
    assert got[1].movie_id == 2 and got[1].year == 2020 and got[1].rating == 7.0 and got[1].votes == 12


def test_clean_filter_explode(spark):
    docs = [{"id": 1, "year": 1899, "rating": 10.1, "votes": -1, "genres": None},
            {"id": 2, "year": 1900, "rating": 10.0, "votes": 0, "genres": []},
            {"id": 3, "year": 2030, "rating": -0.1, "votes": 1, "genres": ["a"]},
            {"id": 4, "year": 2031, "rating": None, "votes": None, "genres": ["a", "b", "a", None]}]
    silver = silver_from_stored(stored_df(spark, docs))
    assert silver.columns == SILVER_FIELDS
    got = [(r.movie_id, r.year, r.rating, r.votes, r.genre) for r in silver.collect()]
    assert sorted(got, key=repr) == sorted([(3, 2030, 0.0, 1, "a"), (4, 0, 0.0, 0, "a"), (4, 0, 0.0, 0, "b"),
                                           (4, 0, 0.0, 0, "a"), (4, 0, 0.0, 0, None)], key=repr)


def test_profile(spark):
    docs = [{"id": 1, "genres": ["a", "b"]}, {"id": None, "genres": ["a"]}, {"id": 2, "genres": []},
            {"id": 3, "genres": [None]}, {"id": 1, "genres": ["b"]}]
    st = stored_df(spark, docs)
    p = profile(st).first().asDict()
    silver = silver_from_stored(st)
    assert p == {"rows_in": 5, "rows_valid": 4, "rows_silver": silver.count(),
                 "distinct_ids": silver.select("movie_id").distinct().count(),
                 "distinct_genres": silver.select("genre").distinct().count()}
    empty = stored_df(spark, [{"id": 1}]).limit(0)
    assert profile(empty).first().asDict() == {"rows_in": 0, "rows_valid": 0, "rows_silver": 0,
                                               "distinct_ids": 0, "distinct_genres": 0}


def test_keep_nonempty_and_explode_order(spark):
    df = spark.createDataFrame([(1, ["x", "y", "x"]), (2, []), (3, None)], "movie_id int, genres array<string>")
    assert [r.movie_id for r in keep_nonempty(df).collect()] == [1]
