"""Physical-plan guards for the scale properties the operators rely on."""

import contextlib
import io
import re

import pytest

from marquee.operators.analytics import avg_by_group, topk_by_group
from marquee.operators.dedup import dedup_first
from marquee.operators.lookup import lookup_names
from marquee.plans.standins import raw_catalogue
from conftest import SF_SMALL


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


@pytest.fixture
def static_plans(spark):
    """Plans without AQE, so the text shows the whole static plan."""
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.enabled", old)


def hot_rows(spark, n=3000):
    # one key holds a third of all rows
    rows = [(0 if i % 3 == 0 else i, f"t{i}", 2000 + i % 5, float(i % 10), i, "g", f"2024-01-{1 + i % 28:02d}")
            for i in range(n)]
    return spark.createDataFrame(rows, "movie_id int, title string, year int, rating double, votes int, "
                                       "genre string, fetched_at string")


def _below_exchange(text: str, op: str) -> bool:
    """``op`` occurs in the lines under the first hash exchange of the plan."""
    lines = text.splitlines()
    ex = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line)
    return any(op in line for line in lines[ex + 1:])


def test_dedup_limits_each_key_before_the_shuffle(static_plans):
    p = plan(dedup_first(hot_rows(static_plans), ["movie_id"], ["fetched_at"]))
    assert re.search(r"WindowGroupLimit .*row_number\(\), 1, Partial", p)
    assert _below_exchange(p, "Partial")
    assert "SortAggregate" not in p


def test_topk_limits_each_group_before_the_shuffle(static_plans):
    p = plan(topk_by_group(hot_rows(static_plans), k=10))
    assert re.search(r"WindowGroupLimit \[year.*row_number\(\), 10, Partial", p)


def test_average_is_a_partial_hash_aggregate(static_plans):
    p = plan(avg_by_group(hot_rows(static_plans), exact_scale=1))
    assert "partial_sum" in p and "HashAggregate" in p and "SortAggregate" not in p
    assert _below_exchange(p, "partial_sum")


def test_lookup_of_arrays_reads_its_input_once(static_plans):
    df = static_plans.createDataFrame([(1, [28, 99])], "id int, genre_ids array<int>")
    dim = static_plans.createDataFrame([(28, "Action")], "id int, name string")
    p = plan(lookup_names(df, "genre_ids", dim, "id", "name", "genres"))
    assert "Exchange" not in p and "Join" not in p  # a short dimension is a map in the expression
    large = dim.unionByName(static_plans.range(1000, 2000).selectExpr("cast(id as int) as id", "'x' as name"))
    p = plan(lookup_names(df, "genre_ids", large, "id", "name", "genres"))
    assert p.count("SortMergeJoin") == 1 and "__salt" in p
    assert p.count("Generate posexplode") == 0  # elements come from the table written once


def test_topk_reads_only_what_it_needs(static_plans, tmp_path):
    from marquee.schemas import SILVER
    path = str(tmp_path / "silver")
    static_plans.createDataFrame([], SILVER).write.parquet(path)
    p = plan(topk_by_group(static_plans.read.parquet(path)))
    schema = p[p.index("ReadSchema"):].splitlines()[0]
    assert all(c in schema for c in ("movie_id", "year", "votes", "title", "rating", "fetched_at", "genre"))
    assert not any(c in schema for c in ("overview", "popularity", "release_date", "original_title", "source"))


def test_customers_join_at_the_grain_of_orders(static_plans):
    static_plans.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(raw_catalogue(static_plans, SF_SMALL))
    finally:
        static_plans.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert p.count("Exchange hashpartitioning(o_custkey") == 1 and "Exchange hashpartitioning(l_orderkey" in p
    lines = p.splitlines()
    customer = next(i for i, line in enumerate(lines) if "Join" in line and "o_custkey" in line)
    assert not any("Join" in line and "l_orderkey" in line for line in lines[customer:])  # below the line items' join


def test_first_line_candidates_sit_below_the_joins(static_plans):
    p = plan(raw_catalogue(static_plans, SF_SMALL, first_only=True))
    lines = p.splitlines()
    order_join = next(i for i, line in enumerate(lines) if "Join" in line and "l_orderkey" in line)
    assert any("row_number(" in line and "l_orderkey" in line for line in lines[order_join:])
