"""User mappers and reducers over sorted runs; lines in input order."""

from pyspark.sql import functions as F

from marquee.operators.analytics import avg_by_group, bucket_histogram, topk_by_group
from marquee.operators.dedup import dedup_first
from marquee.operators.reducers import map_records, reduce_runs
from marquee.plans import reducers
from marquee.sources.readers import read_lines_in_order


def silver(spark, n=9000):
    """One genre, one id and one year hold a third of all rows."""
    k = F.col("id")
    hot = k % 3 == 0
    return spark.range(n).select(
        F.when(hot, F.lit(7)).otherwise(k).alias("movie_id"), F.when(hot, F.lit(" Hot ")).otherwise(F.concat(F.lit("g"), (k % 40).cast("string"))).alias("genre"),
        F.when(hot, F.lit(2000)).otherwise(F.lit(1990) + k % 20).cast("int").alias("year"), (k * 7919 % 1000).cast("int").alias("votes"),
        F.concat(F.lit("t"), k.cast("string")).alias("title"), (F.pmod(k * 31, F.lit(101)) / 10).alias("rating"),
        F.concat(F.lit("2024-01-"), F.lpad((k % 28).cast("string"), 2, "0")).alias("fetched_at")).repartition(7)


def same(a, b):
    assert sorted(a.columns) == sorted(b.columns)
    return sorted(map(tuple, a.select(b.columns).collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)


def test_analytics_as_reducers_equal_the_built_ins(spark):
    rows = silver(spark).persist()
    assert same(reducers.avg_by_genre(rows), avg_by_group(rows, exact_scale=1))
    assert same(reducers.top_by_year(rows), topk_by_group(rows))
    assert same(reducers.rating_buckets(rows), bucket_histogram(rows))


def test_a_reducer_streams_its_rows(spark):
    """A run of many batches is never held: the reducer sees an iterator, in order, and may stop."""
    df = spark.range(60_000).select(F.when(F.col("id") % 3 > 0, F.lit(1)).alias("k"), F.col("id").alias("v"), F.lit("w").alias("w"))

    def ordered(key, rows):
        assert not isinstance(rows, (list, tuple))
        n, last = 0, -1
        for r in rows:
            assert r["v"] > last
            n, last = n + 1, r["v"]
        yield key[0], n, last
    got = reduce_runs(df, ["k"], ordered, "k int, n long, last long", order_by=["v"])
    assert sorted(map(tuple, got.collect()), key=repr) == [(1, 40_000, 59_999), (None, 20_000, 59_997)]
    first = reduce_runs(df, ["k"], lambda key, rows: [(key[0], next(rows)["v"])], "k int, v long", order_by=[F.col("v").desc()])
    assert sorted(map(tuple, first.collect()), key=repr) == [(1, 59_999), (None, 59_997)]


def test_keys_of_many_columns_and_an_empty_table(spark):
    df = spark.createDataFrame([(float("nan"), "a", 1), (float("nan"), "a", 2), (0.5, None, 3), (0.5, "a", 4)], "x double, y string, v long")
    def total(key, rows):
        yield len(key), sum(r["v"] for r in rows)
    got = reduce_runs(df, ["x", "y"], total, "n int, s long")
    assert sorted(map(tuple, got.collect())) == [(2, 3), (2, 3), (2, 4)]
    assert reduce_runs(df.filter("false"), ["x", "y"], total, "n int, s long").collect() == []
    assert map_records(df, lambda r: [(r["v"],)] * int(r["v"] - 1), "v long").count() == 6


def test_the_combiner_leaves_little_of_a_hot_key(spark):
    rows = silver(spark)

    def first(key, items):
        yield tuple(next(items).values())
    df = rows.select("movie_id", "title")
    combined = reduce_runs(df, ["movie_id"], first, df.schema, order_by=["title"], combiner=first)
    assert combined.filter("movie_id = 7").collect()[0]["title"] == rows.filter("movie_id = 7").agg(F.min("title")).first()[0]
    assert combined.count() == rows.select("movie_id").distinct().count()


def test_lines_keep_their_place_through_shuffles(spark, tmp_path):
    lines = []
    for f in range(3):
        mine = [f"{f},{i},{'x' * (i % 37)}" for i in range(700)]
        (tmp_path / f"part-{f}.txt").write_text("\n".join(mine) + "\n")
        lines += mine
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")  # several splits a file
    try:
        read = read_lines_in_order(spark, str(tmp_path))
        assert read.select("input_pos.split").distinct().count() > 5
        shuffled = read.repartition(5, "value")
        assert [r["value"] for r in shuffled.orderBy("input_pos").collect()] == lines
        keyed = shuffled.select(F.length("value").alias("k"), "value", "input_pos")
        first = {}
        for line in lines:
            first.setdefault(len(line), line)
        assert {r["k"]: r["value"] for r in dedup_first(keyed, ["k"], ["input_pos"]).collect()} == first
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
