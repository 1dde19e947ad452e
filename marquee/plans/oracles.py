"""DuckDB SQL equal in result to each registered query (tables are pre-registered views).

Independent formulations: window ``row_number`` where the library aggregates, joins where
it uses an in-expression map, ``format`` where it uses ``format_number``.
"""

from __future__ import annotations

# Python's whitespace set (str.isspace) as an RE2 class.
_SP = (r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
       r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")


def _strip(e: str) -> str:
    return f"regexp_replace({e}, '^{_SP}+|{_SP}+$', '', 'g')"


def _year(e: str) -> str:
    return f"COALESCE(TRY_CAST(split_part({e}, '-', 1) AS INTEGER), 0)"


def _round1(e: str) -> str:
    return f"CAST(format('{{:.1f}}', {e}) AS DOUBLE)"


def _avg_sql(src: str) -> str:
    return f"""
SELECT genre,
       format('{{:.2f}}', CAST(sum(CAST(rating AS DECIMAL(18, 1))) AS DOUBLE) / count(*)) AS avg_rating,
       count(*) AS n
FROM (SELECT {_strip('genre')} AS genre, rating FROM {src})
WHERE genre <> '' AND rating > 0
GROUP BY genre HAVING count(*) >= 50"""


def _hist_sql(src: str) -> str:
    return f"""
b AS (SELECT CASE WHEN rating < 2 THEN 0 WHEN rating < 4 THEN 1 WHEN rating < 6 THEN 2
                  WHEN rating < 8 THEN 3 ELSE 4 END AS i
      FROM {src} WHERE rating > 0),
lab AS (SELECT * FROM (VALUES (0, '0-2'), (1, '2-4'), (2, '4-6'), (3, '6-8'), (4, '8-10')) AS t(i, bucket)),
c AS (SELECT i, count(*) AS n FROM b GROUP BY i),
tot AS (SELECT count(*) AS total FROM b)
SELECT lab.bucket, COALESCE(c.n, 0) AS n,
       format('{{:.2f}}', CASE WHEN tot.total > 0
                             THEN CAST(COALESCE(c.n, 0) AS DOUBLE) / CAST(tot.total AS DOUBLE) * 100.0
                             ELSE 0.0 END) AS pct
FROM lab LEFT JOIN c ON lab.i = c.i CROSS JOIN tot"""


def _topk_sql(src: str, order_rest: str) -> str:
    return f"""
d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY movie_id
                                ORDER BY fetched_at, genre, {order_rest}) AS rn FROM {src}) WHERE rn = 1),
v AS (SELECT movie_id, year, votes, {_strip("COALESCE(title, '')")} AS title,
             COALESCE(CAST(rating AS DOUBLE), 0.0) AS rating FROM d),
k AS (SELECT *, row_number() OVER (PARTITION BY year ORDER BY votes DESC, movie_id) AS rk
      FROM v WHERE year > 0 AND votes > 0)
SELECT year, CAST(rk AS INTEGER) AS rank, left(title, 50) AS title, votes,
       format('{{:.1f}}', rating) AS rating
FROM k WHERE rk <= 10"""


PART_WORDS = """
pw AS (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS genre, p_size FROM part),
pr AS (SELECT p_partkey AS movie_id, genre, CAST(p_size AS DOUBLE) / 5.0 AS rating FROM pw)"""

DIM = """
dim AS (SELECT n_nationkey AS id, n_name AS name FROM nation)"""

SHIP = """
ship AS (SELECT l.*, o.*, c.c_name, c.c_nationkey, c.c_mktsegment, s.s_name, s.s_nationkey
         FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
         JOIN customer c ON o.o_custkey = c.c_custkey
         JOIN supplier s ON l.l_suppkey = s.s_suppkey)"""

# Raw listing records: the supplier is a left join (a line is never dropped by it).
RAW_SHIP = """
rship AS (SELECT l.*, o.*, c.c_name, c.c_nationkey, c.c_mktsegment, s.s_name, s.s_nationkey
          FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
          JOIN customer c ON o.o_custkey = c.c_custkey
          LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey)"""

# raw → first per id → message → silver, as in the catalogue flow.
CHAIN = f"""{DIM},{RAW_SHIP},
raw AS (SELECT CAST(l_orderkey AS BIGINT) AS id, c_name AS title, s_name AS original_title,
               [CAST(s_nationkey AS INTEGER), CAST(c_nationkey + 5 AS INTEGER)] AS genre_ids,
               strftime(o_orderdate, '%Y-%m-%d') AS release_date,
               l_discount * CAST(100.0 AS DOUBLE) + l_tax * CAST(10.0 AS DOUBLE) AS vote_average,
               CAST(trunc(o_totalprice) AS INTEGER) AS vote_count, c_mktsegment AS overview,
               l_extendedprice AS popularity, l_returnflag = 'R' AS adult,
               lower(l_linestatus) AS original_language, o_orderpriority AS listing,
               strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS landed_at, l_linenumber AS line_no,
               l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus
        FROM rship),
firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY landed_at, line_no, l_partkey,
                          l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) AS rn FROM raw) WHERE rn = 1),
msg AS (SELECT f.id, f.title, f.original_title, {_year('f.release_date')} AS year,
               {_round1('f.vote_average')} AS rating, f.vote_count AS votes,
               [COALESCE(d1.name, 'Unknown_' || COALESCE(CAST(f.genre_ids[1] AS VARCHAR), 'None')),
                COALESCE(d2.name, 'Unknown_' || COALESCE(CAST(f.genre_ids[2] AS VARCHAR), 'None'))] AS genres,
               f.genre_ids, f.overview, f.popularity, f.adult, f.original_language,
               '' AS poster_path, '' AS backdrop_path, f.release_date,
               replace(lower(f.listing), ' ', '_') AS source, f.landed_at AS fetched_at
        FROM firsts f LEFT JOIN dim d1 ON d1.id = f.genre_ids[1] LEFT JOIN dim d2 ON d2.id = f.genre_ids[2]),
clean AS (SELECT id AS movie_id, title, original_title,
                 CASE WHEN year BETWEEN 1900 AND 2030 THEN year ELSE 0 END AS year,
                 CASE WHEN rating >= 0 AND rating <= 10 THEN rating ELSE 0.0 END AS rating,
                 CASE WHEN votes >= 0 THEN votes ELSE 0 END AS votes,
                 genres, overview, popularity, original_language, release_date, source, fetched_at
          FROM msg),
silver AS (SELECT movie_id, title, original_title, year, rating, votes, unnest(genres) AS genre, overview,
                  popularity, original_language, release_date, source, fetched_at
           FROM clean WHERE len(genres) > 0)"""

MSG_SELECT = """
SELECT id, title, original_title, year, rating, votes, array_to_string(genres, '|') AS genres,
       array_to_string(genre_ids, '|') AS genre_ids, overview, popularity, adult, original_language,
       poster_path, backdrop_path, release_date, source, fetched_at FROM msg"""

SILVER_REST = "title, year, votes, rating"

PROFILE_SQL = f"""WITH {CHAIN}
SELECT (SELECT count(*) FROM clean) AS rows_in,
       (SELECT count(*) FROM clean WHERE len(genres) > 0) AS rows_valid,
       (SELECT count(*) FROM silver) AS rows_silver,
       (SELECT count(DISTINCT movie_id) + COALESCE(max(CASE WHEN movie_id IS NULL THEN 1 ELSE 0 END), 0)
        FROM silver) AS distinct_ids,
       (SELECT count(DISTINCT genre) + COALESCE(max(CASE WHEN genre IS NULL THEN 1 ELSE 0 END), 0)
        FROM silver) AS distinct_genres"""

TAB = "chr(9)"
ANALYTICS_SQL = f"""
SELECT 'avg_rating_by_genre' AS result, concat_ws({TAB}, genre, avg_rating, CAST(n AS VARCHAR)) AS line
FROM (WITH {CHAIN} {_avg_sql('silver')}) a
UNION ALL
SELECT 'top10_by_year', concat_ws({TAB}, CAST(year AS VARCHAR), CAST(rank AS VARCHAR), title,
                                  CAST(votes AS VARCHAR), rating)
FROM (WITH {CHAIN}, {_topk_sql('silver', SILVER_REST)}) t
UNION ALL
SELECT 'rating_buckets', concat_ws({TAB}, bucket, CAST(n AS VARCHAR), pct)
FROM (WITH {CHAIN}, {_hist_sql('silver')}) h"""

# The lines of the lenient silver, as the map scripts read them: a row is dropped where a value
# they convert does not convert; a missing value is 0 or empty.
BAD = """
bad AS (SELECT o_orderkey AS movie_id, o_orderkey % 12 AS k, CASE WHEN o_orderkey % 12 = 10 THEN 'odd' ELSE o_orderpriority END AS genre, o_orderstatus AS title,
               CASE WHEN o_orderkey % 12 = 10 THEN 'NaN'::DOUBLE ELSE (o_custkey % 50) / 5.0 + 0.2 END AS rating, CAST(year(o_orderdate) AS INTEGER) AS year,
               CASE WHEN o_orderkey % 12 = 5 THEN 0 ELSE CAST(trunc(o_totalprice) AS INTEGER) END AS votes,
               '2024-01-01 00:00:00' AS fetched_at
        FROM orders WHERE o_orderkey % 12 <> 0),
rated AS (SELECT * FROM bad WHERE k NOT IN (2, 3, 11)),
listed AS (SELECT * FROM rated WHERE k NOT IN (1, 6, 7))"""

# The average as fixed-point text of an exact decimal sum.
ORACLES = {
    "avg_by_group": f"WITH {PART_WORDS} {_avg_sql('pr')}",
    "topk_by_group": f"""WITH t AS (
  SELECT l.l_orderkey AS movie_id, o.o_orderpriority AS title, CAST(year(o.o_orderdate) AS INTEGER) AS year,
         l.l_discount * CAST(100.0 AS DOUBLE) AS rating, CAST(trunc(o.o_totalprice) AS INTEGER) AS votes,
         l.l_returnflag AS genre, strftime(l.l_shipdate, '%Y-%m-%d %H:%M:%S') AS fetched_at
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
{_topk_sql('t', 'title, year, votes, rating')}""",
    "bucket_histogram": f"WITH {PART_WORDS}, {_hist_sql('pr')}",
    "id_name_lookup": f"""WITH {DIM}
SELECT c_custkey, c_nationkey + 5 AS nation_id,
       COALESCE(dim.name, 'Unknown_' || CAST(c_nationkey + 5 AS VARCHAR)) AS nation_name
FROM customer LEFT JOIN dim ON c_nationkey + 5 = dim.id""",
    "array_lookup": f"""WITH {DIM},{SHIP}
SELECT l_orderkey, l_linenumber,
       COALESCE(d1.name, 'Unknown_' || CAST(s_nationkey AS VARCHAR)) || ' > ' ||
       COALESCE(d2.name, 'Unknown_' || CAST(c_nationkey + 5 AS VARCHAR)) AS route
FROM ship LEFT JOIN dim d1 ON d1.id = s_nationkey LEFT JOIN dim d2 ON d2.id = c_nationkey + 5""",
    "year_from_text": f"""
SELECT o_orderkey, {_year("strftime(o_orderdate, '%Y-%m-%d')")} AS year_of_date,
       {_year('o_orderpriority')} AS year_of_priority, {_year('o_orderstatus')} AS year_of_status
FROM orders""",
    "round_1dp": f"""
SELECT l_orderkey, l_linenumber, {_round1('l_extendedprice / l_quantity')} AS unit_price_1dp FROM lineitem""",
    "dedup_first": """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey,
             l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) AS rn
      FROM lineitem) WHERE rn = 1""",
    "json_encode_decode": """
SELECT event_id, user_id, event_type, value, props, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts FROM events""",
    "json_malformed": """
SELECT 'event' AS src, event_id AS src_id,
       CASE WHEN json_valid(props) AND json_type(props, '$.k') IN ('UBIGINT', 'BIGINT')
            THEN TRY_CAST(json_extract(props, '$.k') AS INTEGER) END AS k FROM events
UNION ALL
SELECT 'document', doc_id,
       CASE WHEN json_valid(text) AND json_type(text) = 'OBJECT'
                 AND json_type(text, '$.k') IN ('UBIGINT', 'BIGINT')
            THEN TRY_CAST(json_extract(text, '$.k') AS INTEGER) END FROM documents
UNION ALL
SELECT 'mistyped', event_id, CAST(NULL AS INTEGER) FROM events""",
    "typed_projection": """
SELECT event_id AS movie_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS votes,
       TRY_CAST(event_type AS INTEGER) AS year, CAST(event_id AS INTEGER) AS whole, value AS rating FROM events""",
    "clamp_year": f"""
SELECT o_orderkey,
       CASE WHEN year(o_orderdate) BETWEEN 1900 AND 2030 THEN CAST(year(o_orderdate) AS INTEGER) ELSE 0 END AS year,
       CASE WHEN year(o_orderdate) + 34 <= 2030 THEN CAST(year(o_orderdate) + 34 AS INTEGER) ELSE 0 END AS later_year,
       CASE WHEN {_year('o_orderpriority')} BETWEEN 1900 AND 2030 THEN {_year('o_orderpriority')} ELSE 0 END
         AS priority_year
FROM orders""",
    "clamp_rating": """
SELECT event_id, CASE WHEN value >= 0 AND value <= 10 THEN value ELSE 0.0 END AS rating FROM events""",
    "clamp_votes": """
SELECT c_custkey, CASE WHEN CAST(trunc(c_acctbal) AS INTEGER) >= 0 THEN CAST(trunc(c_acctbal) AS INTEGER)
                       ELSE 0 END AS votes FROM customer""",
    "nonempty_array": """
SELECT doc_id, CAST(len(regexp_extract_all(text, '[0-9]+')) AS INTEGER) AS n_numbers FROM documents
WHERE len(regexp_extract_all(text, '[0-9]+')) > 0""",
    "explode_rows": "SELECT p_partkey, unnest(string_split(p_name, ' ')) AS genre FROM part",
    "preview_rows": """
WITH f AS (SELECT * FROM part ORDER BY p_partkey LIMIT 10),
n AS (SELECT count(*) AS batch_rows FROM part)
SELECT CAST(row_number() OVER (ORDER BY p_partkey) AS INTEGER) AS idx,
       rpad(left(p_name, 45), 45, ' ') AS title_line,
       array_to_string(string_split(p_name, ' ')[1:3], ', ') AS genres_line,
       batch_rows, greatest(batch_rows - 10, 0) AS more_rows
FROM f CROSS JOIN n""",
    "delimiter_compat": f"""
WITH v AS (SELECT doc_id, doc_id % 7 + 2000 AS year, n_chars AS votes, {_strip("COALESCE(text, '')")} AS title FROM documents),
k AS (SELECT *, row_number() OVER (PARTITION BY year ORDER BY votes DESC, doc_id) AS rk
      FROM v WHERE votes > 0 AND NOT regexp_matches(title, '[|\\n\\r]'))
SELECT CAST(year AS INTEGER) AS year, CAST(rk AS INTEGER) AS rank, left(title, 50) AS title, CAST(votes AS INTEGER) AS votes,
       '5.0' AS rating
FROM k WHERE rk <= 10""",
    "catalogue_messages": f"WITH {CHAIN} {MSG_SELECT}",
    "message_roundtrip": f"WITH {CHAIN} {MSG_SELECT}",
    "silver_etl": f"WITH {CHAIN} SELECT * FROM silver",
    "dataset_profile": PROFILE_SQL,
    "jsonl_roundtrip": f"WITH {CHAIN} SELECT * FROM silver",
    "silver_avg_by_genre": f"WITH {CHAIN} {_avg_sql('silver')}",
    "silver_top10_by_year": f"WITH {CHAIN}, {_topk_sql('silver', SILVER_REST)}",
    "silver_rating_buckets": f"WITH {CHAIN}, {_hist_sql('silver')}",
    "tsv_roundtrip": f"WITH {PART_WORDS} {_avg_sql('pr')}",
    "catalog_pages": f"""WITH {CHAIN}
SELECT r.id AS page, 0 AS pos, r.id, r.title,
       COALESCE(d1.name, 'Unknown_' || COALESCE(CAST(r.genre_ids[1] AS VARCHAR), 'None')) || '|' ||
       COALESCE(d2.name, 'Unknown_' || COALESCE(CAST(r.genre_ids[2] AS VARCHAR), 'None')) AS genres
FROM raw r LEFT JOIN dim d1 ON d1.id = r.genre_ids[1] LEFT JOIN dim d2 ON d2.id = r.genre_ids[2]""",
    "etl_job": PROFILE_SQL,
    "analytics_job": ANALYTICS_SQL,
    "analytics_job_columnar": ANALYTICS_SQL,
    "silver_lenient_avg": f"WITH {CHAIN} {_avg_sql('silver')}",
    "stream_append": """
SELECT event_id, user_id, event_type, value, props, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts FROM events""",
    "stream_dedup": """
SELECT DISTINCT event_id, user_id, event_type, value, props, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts
FROM events""",
    "stream_first_by_order": """
WITH c AS (SELECT * REPLACE (unnest([ts, ts, ts + INTERVAL 1 DAY]) AS ts, unnest([event_type, upper(event_type), event_type]) AS event_type)
           FROM events)
SELECT event_id, user_id, event_type, value, props, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts FROM c
QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ts, event_type NULLS LAST, user_id NULLS LAST, value NULLS LAST, props NULLS LAST) = 1
""",
    "stream_progress": """
SELECT 4 * count(*) AS rows, count(*) AS malformed, 2 * count(*) AS repeated, 2 * count(*) AS kept, count(*) AS stored,
       count(*) AS dead_letters FROM events
""",
    "stream_quarantine": """
SELECT (SELECT count(*) FROM events) AS stored_rows,
       (SELECT count(*) FROM documents) + (SELECT count(*) FROM events) AS dead_rows,
       (SELECT sum(length(to_json(struct_pack(title := text)))) FROM documents)
         + (SELECT sum(length(COALESCE(props, ''))) FROM events) AS dead_chars,
       (SELECT count(*) FROM documents) + 2 * (SELECT count(*) FROM events) AS observed_rows,
       (SELECT count(*) FROM documents) + (SELECT count(*) FROM events) AS observed_malformed""",
    "message_sink": """
SELECT CAST(event_id AS VARCHAR) AS key,
       to_json(struct_pack(event_id := event_id, event_type := event_type, value := value)) AS value
FROM events""",
    "stream_metrics": """
SELECT count(*) AS rows, count(*) AS input_rows, count(*) AS callback_rows FROM events""",
    "array_lookup_large": """
SELECT l_orderkey, l_linenumber, COALESCE(p_name, 'Unknown_' || CAST(l_partkey AS VARCHAR)) || ' > Unknown_'
       || CAST(l_partkey + 10000000000 AS VARCHAR) AS parts
FROM lineitem LEFT JOIN part ON p_partkey = l_partkey""",
    "enrich_repeated_ids": """
SELECT l_orderkey AS id, CAST(l_linenumber AS VARCHAR) AS title,
       COALESCE(a.p_name, 'Unknown_' || CAST(l_partkey AS VARCHAR)) || '|'
       || COALESCE(b.p_name, 'Unknown_' || CAST(l_suppkey AS VARCHAR)) AS genres
FROM lineitem LEFT JOIN part a ON a.p_partkey = l_partkey LEFT JOIN part b ON b.p_partkey = l_suppkey""",
    "field_mapping_defaults": f"""
SELECT o_orderkey AS id, CASE WHEN o_orderkey % 2 = 1 THEN o_orderpriority ELSE '' END AS title, '' AS original_title,
       CASE WHEN o_orderkey % 2 = 0 THEN CAST(year(o_orderdate) AS INTEGER) ELSE 0 END AS year,
       CASE WHEN o_orderkey % 2 = 1 THEN {_round1('o_totalprice')} ELSE 0.0 END AS rating,
       CAST(CASE WHEN o_orderkey % 2 = 0 THEN o_custkey ELSE 0 END AS INTEGER) AS votes, '' AS genres, '' AS genre_ids,
       '' AS overview, CAST(0.0 AS DOUBLE) AS popularity, false AS adult, '' AS original_language, '' AS poster_path,
       '' AS backdrop_path,
       CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE '' END AS release_date,
       'top_rated' AS source, '2024-01-01 00:00:00' AS fetched_at
FROM orders""",
    "text_shapes": """
SELECT o_orderkey, lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS padded, format('{:,}', o_orderkey * 1000) AS grouped
FROM orders""",
    "result_order": f"""WITH t AS (
  SELECT l.l_orderkey AS movie_id, o.o_orderpriority AS title, CAST(year(o.o_orderdate) AS INTEGER) AS year,
         l.l_discount * CAST(100.0 AS DOUBLE) AS rating, CAST(trunc(o.o_totalprice) AS INTEGER) AS votes,
         l.l_returnflag AS genre, strftime(l.l_shipdate, '%Y-%m-%d %H:%M:%S') AS fetched_at
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
r AS (SELECT * FROM (WITH {_topk_sql('t', 'title, year, votes, rating').lstrip()}))
SELECT CAST(row_number() OVER (ORDER BY year, rank) - 1 AS INTEGER) AS line_no,
       concat_ws({TAB}, CAST(year AS VARCHAR), CAST(rank AS VARCHAR), title, CAST(votes AS VARCHAR), rating) AS line
FROM r""",
    "numbered_lines": f"""
SELECT row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1 AS line_no,
       concat_ws({TAB}, CAST(o_orderkey AS VARCHAR), o_orderstatus, o_orderpriority) AS line
FROM orders""",
    "etl_preview": f"WITH {CHAIN} SELECT title, year, rating, votes, genre FROM silver ORDER BY movie_id, genre LIMIT 5",
    "preview_ordered": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 20",
    "read_table": f"WITH {CHAIN} {MSG_SELECT}",
    "topic_sink": """
SELECT to_json(struct_pack(event_id := event_id, event_type := event_type, value := value)) AS value FROM events""",
    "lenient_avg": f"""WITH {BAD}, plain AS (SELECT * FROM rated WHERE NOT isnan(rating))
{_avg_sql('plain')}
UNION ALL SELECT genre, 'nan', count(*) FROM rated WHERE isnan(rating) GROUP BY genre HAVING count(*) >= 50""",
    "lenient_topk": f"WITH {BAD}, {_topk_sql('listed', 'title, year, votes, rating')}",
    "lenient_buckets": f"WITH {BAD}, {_hist_sql('rated')}",
}

# The same questions asked of user reducers.
ORACLES |= {f"reducer_{k}": ORACLES[k] for k in ("avg_by_group", "topk_by_group", "bucket_histogram")}
ORACLES["first_in_input_order"] = """
SELECT l_partkey, l_orderkey, l_linenumber FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_partkey
  ORDER BY (l_orderkey * 7919 + l_linenumber * 104729) % 1000003, l_orderkey, l_linenumber) = 1"""
