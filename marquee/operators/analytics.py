"""The three catalogue analytics: average by group, top-k per group, bucket histogram."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions.text import fixed, prefix, strip_text
from marquee.functions.values import bucket_index, percent_of
from marquee.operators.dedup import dedup_first

# Fixed values of the rating histogram: lower edges (inclusive) and bucket labels.
RATING_EDGES = (2.0, 4.0, 6.0, 8.0)
RATING_LABELS = ("0-2", "2-4", "4-6", "6-8", "8-10")


def _line_tail(c):
    # A key holding a line break is cut by a line-oriented shuffle; only its last line
    # survives as the key (after the whole-line trim).
    return strip_text(F.regexp_extract(c, r"([^\n\r]*)\z", 1))


def _without_bad(df: DataFrame, *fields: str) -> DataFrame:
    """Rows without a value that did not convert in one of ``fields`` (the lenient reader
    names them in ``bad_fields``)."""
    if "bad_fields" not in df.columns:
        return df
    return df.filter(~F.arrays_overlap("bad_fields", F.array(*map(F.lit, fields))))


def avg_by_group(df: DataFrame, key: str = "genre", value: str = "rating", min_count: int = 50,
                 decimals: int = 2, avg_name: str = "avg_rating", count_name: str = "n",
                 compat_delimiters: bool = False, ordered: bool = True,
                 exact_scale: int | None = None) -> DataFrame:
    """Average of ``value`` per trimmed ``key`` over rows with a non-empty key and a
    positive value, kept when the group has at least ``min_count`` rows.

    Output ``(key, avg_name: text with `decimals` places, count_name)`` ordered by key.
    Partial aggregation runs before the shuffle, so a hot key costs one row per task.

    ``exact_scale=s`` declares that values carry ``s`` decimals: they are summed as exact
    integers of ``10**-s`` units, so the average does not depend on how rows were split
    across tasks (a float sum does, in its last bits, which can flip a rounded digit).
    A group with a value off that scale falls back to the float sum.
    """
    k = strip_text(F.col(key))
    if compat_delimiters:
        k = _line_tail(k)
    v = F.col(value).cast("double")
    rows = _without_bad(df, key, value).select(k.alias(key), v.alias(value))
    cond = (F.col(key) != "") & (F.col(value) > 0)
    if compat_delimiters:
        cond = cond & ~F.col(key).contains("\t")
    if exact_scale is None:
        agg = rows.filter(cond).groupBy(key).agg(F.sum(value).alias("__sum"),
                                                 F.count(F.lit(1)).alias(count_name))
        mean = F.col("__sum") / F.col(count_name).cast("double")
    else:
        scale = float(10 ** exact_scale)
        # NaN and infinities have no fixed-point form; they decide the average on their own.
        special = F.when(F.isnan(F.col(value)) | (F.abs(F.col(value)) == F.lit(float("inf"))), F.col(value))
        scaled = F.when(special.isNull(), F.col(value) * F.lit(scale))
        units = F.round(scaled).try_cast("long")
        # A group holding a value off the declared scale (or too large for a long) keeps the
        # plain float mean instead of a rounded one.
        off_scale = (F.abs(scaled - F.round(scaled)) > F.lit(1e-6)) | (scaled.isNotNull() & units.isNull())
        agg = rows.filter(cond).groupBy(key).agg(F.sum(units).alias("__sum"), F.count(F.lit(1)).alias(count_name),
                                                 F.sum(special).alias("__special"),
                                                 F.sum(F.col(value)).alias("__fsum"),
                                                 F.max(off_scale).alias("__off"))
        n = F.col(count_name).cast("double")
        mean = F.coalesce(F.col("__special"),
                          F.when(F.col("__off"), F.col("__fsum") / n)
                           .otherwise(F.col("__sum").cast("double") / (n * F.lit(scale))))
    out = agg.filter(F.col(count_name) >= min_count).select(
        key, fixed(mean, decimals).alias(avg_name), count_name)
    return out.orderBy(key) if ordered else out


def topk_by_group(df: DataFrame, id_col: str = "movie_id", group: str = "year", score: str = "votes",
                  title: str = "title", rating: str = "rating", k: int = 10, title_len: int = 50,
                  first_by: Sequence[str] = ("fetched_at", "genre"), dedup: bool = True,
                  compat_delimiters: bool = False, ordered: bool = True) -> DataFrame:
    """Top ``k`` rows per ``group`` by ``score`` descending, ranked 1..n.

    Rows are first de-duplicated by ``id_col`` (first by ``first_by``) *before* validation,
    then rows with ``group``/``score`` NULL or not positive are dropped.  Silver lines omit
    NULL fields, so a NULL title reads as ``""`` and a NULL rating as ``0``, and such rows
    stay.  Ties on ``score`` are broken by ``id_col`` ascending.  Output
    ``(group, rank, title cut to title_len, score, rating text with 1 place)``.

    ``row_number() <= k`` lets Catalyst place a partial group limit before the shuffle,
    so at most ``k`` rows per group leave each task.
    """
    # only what the result or the order needs is sorted and shuffled; rows that tie on all of
    # it give the same line
    need = dict.fromkeys([id_col, *first_by, title, group, score, rating, *(["bad_fields"] if "bad_fields" in df.columns else [])])
    df = df.select(*[c for c in need if c in df.columns])
    base = dedup_first(df, [id_col], [c for c in first_by if c in df.columns]) if dedup else df
    base = _without_bad(base, title, group, score, rating)  # the first row counts as seen, bad or not
    t = strip_text(F.coalesce(F.col(title), F.lit("")))
    r = F.coalesce(F.col(rating).cast("double"), F.lit(0.0))
    base = base.select(F.col(id_col), F.col(group), F.col(score), t.alias(title), r.alias(rating))
    cond = (F.col(group) > 0) & (F.col(score) > 0)
    if compat_delimiters:
        cond = cond & ~F.col(title).rlike(r"[|\n\r]")
    w = Window.partitionBy(group).orderBy(F.col(score).desc(), F.col(id_col).asc_nulls_last())
    ranked = base.filter(cond).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    out = ranked.select(group, "rank", prefix(F.col(title), title_len).alias(title), score,
                        fixed(F.col(rating), 1).alias(rating))
    return out.orderBy(group, "rank") if ordered else out


def bucket_histogram(df: DataFrame, value: str = "rating", edges: Sequence[float] = RATING_EDGES,
                     labels: Sequence[str] = RATING_LABELS, decimals: int = 2,
                     id_col: str | None = None, first_by: Sequence[str] = ()) -> DataFrame:
    """Zero-filled histogram of positive ``value`` over fixed buckets with percentages.

    One global aggregate of conditional counts (partial per task, one row at the end)
    that is unfolded into one row per bucket, so every bucket appears — also for empty
    input — and the total is the global one.  ``id_col`` counts each id once (first by
    ``first_by``) instead of each row.  Output ``(bucket, n, pct)`` in bucket order.
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("need one more label than edges")
    if id_col is not None:
        df = dedup_first(df.select(id_col, value, *first_by, *(["bad_fields"] if "bad_fields" in df.columns else [])),
                         [id_col], first_by)
    v = F.col(value).cast("double")
    df = _without_bad(df, value)
    b = df.select(bucket_index(v, edges).alias("__b"), v.alias("__v")).filter(F.col("__v") > 0)
    counts = b.agg(*[F.count_if(F.col("__b") == i).alias(f"__n{i}") for i in range(len(labels))])
    total = sum((F.col(f"__n{i}") for i in range(len(labels))), F.lit(0))
    rows = F.array(*[F.struct(F.lit(i).alias("bucket_idx"), F.lit(lbl).alias("bucket"),
                              F.col(f"__n{i}").alias("n")) for i, lbl in enumerate(labels)])
    unfolded = counts.select(F.inline(rows), total.alias("__total"))
    return unfolded.select("bucket", "n", fixed(percent_of(F.col("n"), F.col("__total")), decimals).alias("pct"))
