"""The three analytics written as user mappers, combiners and reducers."""

from __future__ import annotations

from itertools import islice

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.operators.analytics import RATING_EDGES, RATING_LABELS
from marquee.operators.reducers import map_records, reduce_runs

MIN_COUNT = 50
TOP = 10


def avg_by_genre(rows: DataFrame) -> DataFrame:
    """``(genre, avg_rating, n)``; ratings carry one decimal and are summed as whole tenths."""
    def mapper(r):
        genre = (r["genre"] or "").strip()
        if genre and r["rating"] is not None and r["rating"] > 0:
            yield genre, round(r["rating"] * 10), 1

    def summed(key, parts):
        units = n = 0
        for p in parts:
            units, n = units + p["units"], n + p["n"]
        yield key[0], units, n

    def reducer(key, parts):
        _, units, n = next(iter(summed(key, parts)))
        if n >= MIN_COUNT:
            yield key[0], f"{units / (n * 10.0):.2f}", n
    mapped = map_records(rows.select("genre", "rating"), mapper, "genre string, units long, n long")
    return reduce_runs(mapped, ["genre"], reducer, "genre string, avg_rating string, n long", combiner=summed)


def top_by_year(rows: DataFrame) -> DataFrame:
    """First row of each item, then the ten with most votes of each year."""
    rows = rows.select("movie_id", "fetched_at", "genre", "year", "votes", "title", "rating")
    names = rows.columns

    def first(key, items):
        for r in islice(items, 1):
            yield tuple(r[c] for c in names)

    def best(key, items):
        for r in islice(items, TOP):
            yield tuple(r[c] for c in names)

    def ranked(key, items):
        for rank, r in enumerate(islice(items, TOP), 1):
            yield key[0], rank, (r["title"] or "").strip()[:50], r["votes"], f"{r['rating'] or 0.0:.1f}"
    # then every other column, as the built-in de-duplication orders them
    once = reduce_runs(rows, ["movie_id"], first, rows.schema, combiner=first,
                       order_by=[F.col(c).asc_nulls_last() for c in ("fetched_at", "genre", "year", "votes", "title", "rating")])
    valid = once.filter((F.col("year") > 0) & (F.col("votes") > 0))
    return reduce_runs(valid, ["year"], ranked, "year int, rank int, title string, votes int, rating string",
                       order_by=[F.col("votes").desc(), F.col("movie_id").asc_nulls_last()], combiner=best)


def rating_buckets(rows: DataFrame) -> DataFrame:
    """All five buckets with their counts and shares; one key, which the combiner makes small."""
    def mapper(r):
        v = r["rating"]
        if v is not None and not v <= 0:
            yield "", next((i for i, edge in enumerate(RATING_EDGES) if v < edge), len(RATING_EDGES)), 1

    def counts(parts):
        n = [0] * len(RATING_LABELS)
        for p in parts:
            n[p["bucket"]] += p["n"]
        return n

    def combiner(key, parts):
        for i, n in enumerate(counts(parts)):
            if n:
                yield key[0], i, n

    def reducer(key, parts):
        n = counts(parts)
        for label, k in zip(RATING_LABELS, n, strict=True):
            yield label, k, f"{k / sum(n) * 100:.2f}"
    mapped = map_records(rows.select("rating"), mapper, "all string, bucket int, n long")
    return reduce_runs(mapped, ["all"], reducer, "bucket string, n long, pct string", combiner=combiner)
