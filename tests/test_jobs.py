"""Batch job entry points: the ETL with observed counts, the analytics with TSV results."""

import glob
import json
import os
import tempfile

from marquee.operators.clean import profile
from marquee.operators.messages import decode_messages
from marquee.plans.jobs import read_result, run_analytics, run_etl


def fresh(prefix):
    return tempfile.mkdtemp(prefix=f"marquee-{prefix}-")


def stored_df(spark, docs):
    values = spark.createDataFrame([(json.dumps(d) if isinstance(d, dict) else d,) for d in docs], "value string")
    return decode_messages(values, stamp=True)


def test_etl_counts_match_profile_and_preview_is_ordered(spark):
    docs = [{"id": 1, "title": "A", "year": 2001, "rating": 7.0, "votes": 5, "genres": ["x", "y"]},
            {"id": None, "title": "B", "genres": ["x"]},
            {"id": 2, "title": "C", "genres": []},
            {"id": 3, "title": "D", "genres": None},
            {"id": 4, "title": "E", "year": 1899, "rating": 11.0, "votes": -3, "genres": [None, "z"]},
            "{bad"]
    st = stored_df(spark, docs)
    out = os.path.join(fresh("etl"), "silver")
    rep = run_etl(spark, st, out, preview_n=3)
    assert rep.counts() == profile(st).first().asDict()
    assert (rep.rows_in, rep.rows_valid, rep.rows_silver) == (6, 3, 5)
    assert [(p["title"], p["genre"]) for p in rep.preview] == [("B", "x"), ("A", "x"), ("A", "y")]
    # the written silver omits NULL fields and keeps the clamped sentinels
    lines = [json.loads(x) for f in glob.glob(f"{out}/*.json") for x in open(f) if x.strip()]
    e = sorted((d for d in lines if d.get("movie_id") == 4), key=lambda d: d.get("genre", ""))
    assert [(d.get("genre"), d["year"], d["rating"], d["votes"]) for d in e] == [(None, 0, 0.0, 0), ("z", 0, 0.0, 0)]


def test_etl_unordered_preview_reads_any_rows(spark):
    docs = [{"id": i, "title": f"t{i}", "genres": ["x"]} for i in range(20)]
    rep = run_etl(spark, stored_df(spark, docs), os.path.join(fresh("etl-u"), "silver"), preview_n=5,
                  preview_order=None)
    assert len(rep.preview) == 5 and {p["genre"] for p in rep.preview} == {"x"}
    assert rep.rows_silver == 20


def test_etl_on_empty_store(spark):
    st = stored_df(spark, [{"id": 1}]).limit(0)
    rep = run_etl(spark, st, os.path.join(fresh("etl-empty"), "silver"))
    assert rep.counts() == {"rows_in": 0, "rows_valid": 0, "rows_silver": 0, "distinct_ids": 0,
                            "distinct_genres": 0}
    assert rep.preview == []


def test_analytics_job_writes_one_ordered_file_per_result(spark):
    docs = []
    for i in range(60):  # genre g0 reaches the minimum group size, g1 does not
        docs.append({"id": i, "title": f"t{i}", "year": 2000 + i % 2, "rating": 1.0 + (i % 9), "votes": 100 + i,
                     "genres": ["g0"] + (["g1"] if i < 10 else []), "fetched_at": "2024-01-01 00:00:00"})
    rep = run_etl(spark, stored_df(spark, docs), os.path.join(fresh("etl-a"), "silver"))
    paths = run_analytics(spark, rep.path, fresh("results"))
    for name, p in paths.items():
        assert len(glob.glob(f"{p}/part-*")) == 1, name
    avg = read_result(spark, paths["avg_rating_by_genre"], "avg_rating_by_genre").collect()
    assert [(r.genre, r.n) for r in avg] == [("g0", 60)]
    top = read_result(spark, paths["top10_by_year"], "top10_by_year").collect()
    assert [(r.year, r.rank) for r in top] == [(2000, k) for k in range(1, 11)] + [(2001, k) for k in range(1, 11)]
    assert top[0].votes == 158 and top[10].votes == 159
    hist = read_result(spark, paths["rating_buckets"], "rating_buckets").collect()
    assert [r.bucket for r in hist] == ["0-2", "2-4", "4-6", "6-8", "8-10"]
    assert sum(r.n for r in hist) == 70


def test_columnar_silver_gives_the_same_results(spark):
    docs = [{"id": i, "title": f"t{i}", "year": 2000 + i % 3, "rating": 0.5 + (i % 19) / 2, "votes": 7 + i,
             "genres": ["g0", "g1"] if i % 4 else ["g0", None], "fetched_at": "2024-01-01 00:00:00"}
            for i in range(120)]
    st = stored_df(spark, docs)
    rj = run_etl(spark, st, os.path.join(fresh("etl-j"), "silver"))
    rp = run_etl(spark, st, os.path.join(fresh("etl-p"), "silver"), fmt="parquet")
    assert rj.counts() == rp.counts() and rj.preview == rp.preview
    pj = run_analytics(spark, rj.path, fresh("res-j"))
    pp = run_analytics(spark, rp.path, fresh("res-p"), fmt="parquet")
    for name in pj:
        assert read_result(spark, pj[name], name).collect() == read_result(spark, pp[name], name).collect(), name
