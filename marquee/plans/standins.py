"""Catalogue-shaped inputs derived from the driver's star-schema tables.

The tables are not films, so each catalogue role is played by a column whose shape
matches it (documented in README):

* category words  — the words of ``part.p_name``; rating — ``p_size / 5``
* an item listed once per category — an order listed once per line item
* category ids    — the nations on both ends of a line: ``[supplier nation, customer nation + 5]``
* category names  — ``nation.n_name``; the customer side of a line looks up its nation key
  plus 5, so that ids beyond the last nation take the ``Unknown_<id>`` fallback
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.functions.dates import date_text, stamp_text
from marquee.operators.dedup import first_candidates
from marquee.sources.readers import table

# Fixed value: added to a customer's nation key, which leaves some ids without a name.
BEYOND = 5


def part_ratings(spark: SparkSession, root: str) -> DataFrame:
    """One row per (part, name word): ``movie_id, genre, rating = p_size / 5``."""
    p = table(spark, root, "part")
    return p.select(F.col("p_partkey").alias("movie_id"),
                    F.explode(F.split("p_name", " ")).alias("genre"),
                    (F.col("p_size") / F.lit(5.0)).alias("rating"))


def order_lines(spark: SparkSession, root: str, first_only: bool = False) -> DataFrame:
    """Silver-like rows, one per line item of an order: the order is the listed item.

    ``movie_id`` order key, ``title`` order priority, ``year`` order year, ``votes``
    whole part of the total price, ``rating`` line discount in percent, ``genre`` line
    return flag, ``fetched_at`` ship-date text.

    ``first_only`` keeps only the first line of each order (smallest ``fetched_at``, then
    ``genre``, then discount, as the top-k's de-duplication orders the lines of one order)
    before the order join: that join keeps or drops all lines of an order together, and sees
    one row per order, limited per task before any shuffle.
    """
    li = table(spark, root, "lineitem").select("l_orderkey", "l_discount", "l_returnflag", "l_shipdate")
    if first_only:
        li = first_candidates(li, ["l_orderkey"], [stamp_text(F.col("l_shipdate")), F.col("l_returnflag")])
    o = table(spark, root, "orders").select(
        "o_orderkey", "o_orderpriority", "o_orderdate", "o_totalprice")
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"])
    return j.select(
        F.col("l_orderkey").alias("movie_id"),
        F.col("o_orderpriority").alias("title"),
        F.year("o_orderdate").alias("year"),
        (F.col("l_discount") * F.lit(100.0)).alias("rating"),
        F.col("o_totalprice").cast("int").alias("votes"),
        F.col("l_returnflag").alias("genre"),
        stamp_text(F.col("l_shipdate")).alias("fetched_at"))


def nation_names(spark: SparkSession, root: str) -> DataFrame:
    """Category dimension ``(id, name)``: every nation."""
    return table(spark, root, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))


def part_names(spark: SparkSession, root: str) -> DataFrame:
    """A dimension that grows with the data: ``(id, name)`` of every part."""
    return table(spark, root, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))


def shipments(spark: SparkSession, root: str) -> DataFrame:
    """Line items with both parties: order, customer and supplier columns attached.

    Customers join orders first, a quarter as many rows as line items.  All are
    equi-joins on keys of tables that grow with the data, so no side is
    forced to broadcast: the planner broadcasts a side only when its file statistics are
    under ``spark.sql.autoBroadcastJoinThreshold`` and AQE re-checks actual sizes at run
    time; otherwise they are sort-merge joins on the key.
    """
    li = table(spark, root, "lineitem")
    s = table(spark, root, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    o = orders_of_customers(spark, root)
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"])
    return j.join(s, j["l_suppkey"] == s["s_suppkey"])


def orders_of_customers(spark: SparkSession, root: str) -> DataFrame:
    """Orders with their customer, joined at the grain of orders: line items then meet both in
    one join on the order key."""
    o = table(spark, root, "orders")
    c = table(spark, root, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    return o.join(c, o["o_custkey"] == c["c_custkey"])


def raw_catalogue(spark: SparkSession, root: str, first_only: bool = False) -> DataFrame:
    """Raw listing records (one per line item; an order appears once per line).

    ``genre_ids`` = ``[supplier nation, customer nation + 5]`` (order and repeats matter),
    ``vote_average`` = discount % + tax × 10 (some above 10, so cleaning fires),
    ``listing`` = order priority (the source label), ``landed_at`` = ship-date stamp and
    ``line_no`` the line number: "first seen" is (landed_at, line_no, …).

    ``first_only`` keeps only the first line of each order (``RAW_FIRST_BY``, a line number
    being unique in its order) before any join with line items, so those joins move one row
    per order instead of one per line.  The filter limits each key partially before its shuffle
    (skew-safe) and leaves the lines partitioned by order key for the order join.  It is
    exact because no join drops a single line: the order and its customer come with the
    order key (all lines of an order stay or go together) and the supplier join is a left
    join.
    """
    li = table(spark, root, "lineitem")
    o = orders_of_customers(spark, root)
    s = table(spark, root, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    if first_only:
        li = first_candidates(li, ["l_orderkey"], [stamp_text(F.col("l_shipdate")), F.col("l_linenumber")])
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"])
    j = j.join(s, j["l_suppkey"] == s["s_suppkey"], "left")
    return j.select(
        F.col("l_orderkey").cast("long").alias("id"),
        F.col("c_name").alias("title"),
        F.col("s_name").alias("original_title"),
        F.array(F.col("s_nationkey"), F.col("c_nationkey") + BEYOND).cast("array<int>").alias("genre_ids"),
        date_text("o_orderdate").alias("release_date"),
        (F.col("l_discount") * F.lit(100.0) + F.col("l_tax") * F.lit(10.0)).alias("vote_average"),
        F.col("o_totalprice").cast("int").alias("vote_count"),
        F.col("c_mktsegment").alias("overview"),
        F.col("l_extendedprice").alias("popularity"),
        (F.col("l_returnflag") == F.lit("R")).alias("adult"),
        F.lower("l_linestatus").alias("original_language"),
        F.col("o_orderpriority").alias("listing"),
        stamp_text(F.col("l_shipdate")).alias("landed_at"),
        F.col("l_linenumber").alias("line_no"))


# Order that defines "first seen" for the raw stand-in (then every other column).
RAW_FIRST_BY = ("landed_at", "line_no")
