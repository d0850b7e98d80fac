"""The same queries as plain SQL over the test tables, for an independent engine."""

from __future__ import annotations

WEB_LOGS = r"""
web_logs AS (
  SELECT '10.0.0.' || user_id AS ip,
         ts,
         CASE WHEN event_type IN ('click', 'view') THEN 'GET' WHEN event_type = 'signup' THEN 'POST'
              WHEN event_type = 'purchase' THEN 'PUT' ELSE 'DELETE' END AS method,
         '/' || event_type || '/' || regexp_extract(props, '(\d+)', 1) AS url,
         CASE WHEN event_type = 'error' THEN 404 WHEN event_type = 'purchase' THEN 500
              WHEN event_type = 'signup' THEN 301 ELSE 200 END AS response_code,
         CAST(round(value * 100) AS INTEGER) AS response_size
  FROM events)"""

DAILY = (
    WEB_LOGS
    + r""",
daily AS (
  SELECT strftime(ts, '%Y-%m-%d') AS date,
         CAST(sum(response_size) AS BIGINT) AS total_response_size
  FROM web_logs GROUP BY 1)"""
)

REQUESTS = (
    WEB_LOGS
    + r""",
heads AS (
  SELECT *, ip || ' - - [' || strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' +0000]' AS head FROM web_logs),
lines AS (
  SELECT CASE response_size % 40 WHEN 0 THEN '' WHEN 1 THEN '  ' || ip || ' ' WHEN 2 THEN head
              WHEN 3 THEN head || ' "' || method
              ELSE head || ' "' || method || ' ' || url || ' HTTP/1.1" ' || response_code || ' '
                   || response_size END AS line
  FROM heads),
fields AS (SELECT string_split_regex(trim(line), '\s+') AS f FROM lines),
requests AS (
  SELECT nullif(f[1], '') AS client, replace(f[6], '"', '') AS method, nullif(f[7], '') AS url
  FROM fields),
urls AS (SELECT url, count(*) AS n FROM requests WHERE length(url) > 0 GROUP BY url),
top_url AS (SELECT url, n FROM urls ORDER BY n DESC, url LIMIT 1)"""
)

CLEANED = r"""
register AS (
  SELECT o_orderkey AS house_id,
         o_custkey / 1000.0::DOUBLE AS latitude,
         o_orderkey / 1000.0::DOUBLE AS longitude,
         CASE WHEN o_orderstatus <> 'P' THEN
           CASE o_orderkey % 50 WHEN 0 THEN 205 WHEN 1 THEN 1000 WHEN 2 THEN 1001 WHEN 3 THEN 1999
                WHEN 4 THEN 2000 WHEN 5 THEN 2025
                ELSE year(o_orderdate) - o_orderkey % 12 * 10 END || '.0' END AS maintenance_year,
         CASE o_orderpriority WHEN '1-URGENT' THEN '—'
              WHEN '2-HIGH' THEN regexp_replace(CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR),
                                                '(\d)(\d{3}\.)', '\1 \2')
              WHEN '3-MEDIUM' THEN 'NaN'
              ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) END AS square,
         CASE o_orderpriority WHEN '5-LOW' THEN '—' WHEN '2-HIGH' THEN '1 000'
              ELSE CAST(o_custkey AS VARCHAR) END AS population,
         'R' || o_custkey AS region,
         nullif(o_orderpriority, '4-NOT SPECIFIED') || '/' || o_custkey % 4 AS locality_name,
         'Order ' || o_orderkey AS address,
         'R' || o_custkey || ', Order ' || o_orderkey AS full_address,
         CASE WHEN o_orderstatus = 'O' THEN '' ELSE CAST(o_custkey AS VARCHAR) END
           AS communal_service_id,
         o_orderpriority || chr(10) || o_orderstatus AS description
  FROM orders),
cleaned AS (
  SELECT house_id, latitude, longitude,
         CAST(trunc(try_cast(maintenance_year AS DOUBLE)) AS INTEGER) AS maintenance_year,
         CASE WHEN isnan(try_cast(replace(square, ' ', '') AS FLOAT)) THEN NULL
              ELSE try_cast(replace(square, ' ', '') AS FLOAT) END AS square,
         try_cast(try_cast(population AS DOUBLE) AS INTEGER) AS population,
         region, locality_name, address, full_address,
         try_cast(try_cast(communal_service_id AS DOUBLE) AS INTEGER) AS communal_service_id,
         description
  FROM register),
realistic AS (SELECT * FROM cleaned WHERE maintenance_year > 1000 AND maintenance_year < 2000)"""

PART_SIZES = """
sizes AS (
  SELECT p_brand AS region, CAST(p_retailprice AS FLOAT) AS square, p_name AS address,
         p_partkey AS house_id
  FROM part)"""

PURCHASES = """
purchases AS (
  SELECT CAST(l_partkey AS VARCHAR) AS item, l_returnflag AS category,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS price, CAST(l_quantity AS INTEGER) AS quantity
  FROM lineitem),
by_category AS (
  SELECT category, CAST(sum(quantity) AS BIGINT) AS units,
         CAST(sum(price) AS DOUBLE) / count(price) AS average_price
  FROM purchases GROUP BY category)"""


def _extremes(source: str) -> str:
    """Window form, unlike the aggregate form the Spark side uses."""
    return f"""
ranked AS (
  SELECT region, address, square,
         row_number() OVER (PARTITION BY region ORDER BY square, address NULLS LAST) AS low,
         row_number() OVER (PARTITION BY region ORDER BY square DESC, address NULLS LAST) AS high
  FROM {source} WHERE square IS NOT NULL AND region IS NOT NULL),
extremes AS (
  SELECT a.region, a.address AS min_address, a.square AS min_square,
         b.address AS max_address, b.square AS max_square
  FROM ranked a JOIN ranked b ON a.region = b.region AND a.low = 1 AND b.high = 1)"""


def _widest(source: str) -> str:
    return (
        _extremes(source)
        + """
SELECT *, max_square - min_square AS square_difference FROM extremes
ORDER BY square_difference DESC, region LIMIT 20"""
    )


# The second batch repeats some new keys and has rows without a key, which stay out.
LOADED = """
loaded AS (
  SELECT * FROM cleaned
  UNION ALL SELECT * FROM cleaned WHERE house_id % 89 = 0 AND description NOT LIKE '%F')"""

TOP_BUILDINGS = """
SELECT house_id, latitude, longitude, square, {population} AS population, region, locality_name
FROM cleaned WHERE square > 60 ORDER BY square DESC, house_id LIMIT 25"""

ORACLES: dict[str, str] = {
    "top_clients": f"""WITH {WEB_LOGS}
SELECT ip, count(*) AS request_count FROM web_logs
GROUP BY ip ORDER BY request_count DESC, ip LIMIT 10""",
    "top_parts_by_cells": """
SELECT l_partkey, count(*) AS n_lines FROM lineitem GROUP BY l_partkey ORDER BY n_lines DESC, l_partkey LIMIT 20""",
    "top_users_by_cells": """
SELECT user_id, count(*) AS n_events FROM events GROUP BY user_id ORDER BY n_events DESC, user_id LIMIT 10""",
    "count_by_method": f"""WITH {WEB_LOGS}
SELECT method, count(*) AS method_count FROM web_logs GROUP BY method""",
    "error_count": "SELECT count(*) AS error_count FROM events WHERE event_type = 'error'",
    "not_found_count": f"""WITH {WEB_LOGS}
SELECT count(*) AS "404_count" FROM web_logs WHERE response_code = 404""",
    "bytes_by_day": f"WITH {DAILY} SELECT * FROM daily ORDER BY date",
    "daily_stats": f"""WITH {DAILY}
SELECT min(total_response_size) AS min_response_size, max(total_response_size) AS max_response_size,
       round(avg(total_response_size), 2) AS mean_response_size,
       round(stddev_samp(total_response_size), 2) AS stddev_response_size
FROM daily""",
    "most_active_day": f"""WITH {DAILY}
SELECT * FROM daily ORDER BY total_response_size DESC, date LIMIT 1""",
    "least_active_day": f"""WITH {DAILY}
SELECT * FROM daily ORDER BY total_response_size, date LIMIT 1""",
    "csv_logs": f"""WITH {WEB_LOGS}
SELECT method, count(*) AS method_count FROM web_logs WHERE response_code = 404 GROUP BY method""",
    "access_log_summary": f"""WITH {REQUESTS}
SELECT count(*) AS requests, count(DISTINCT client) AS clients,
       count(*) FILTER (WHERE method = 'GET') AS GET,
       count(*) FILTER (WHERE method = 'POST') AS POST,
       (SELECT url FROM top_url) AS top_url, (SELECT n FROM top_url) AS top_url_requests
FROM requests""",
    "access_log_clients": f"""WITH {REQUESTS}
SELECT count(DISTINCT client) AS clients FROM requests""",
    "access_log_methods": f"""WITH {REQUESTS}
SELECT count(*) FILTER (WHERE method = 'GET') AS GET,
       count(*) FILTER (WHERE method = 'POST') AS POST
FROM requests""",
    "access_log_top_url": f"WITH {REQUESTS} SELECT url, n FROM top_url",
    "access_log_report": f"""WITH {REQUESTS}
SELECT 'requests' AS metric, '' AS key, count(*) AS value FROM requests
UNION ALL SELECT 'clients', '', count(DISTINCT client) FROM requests
UNION ALL SELECT 'method', 'GET', count(*) FROM requests WHERE method = 'GET'
UNION ALL SELECT 'method', 'POST', count(*) FROM requests WHERE method = 'POST'
UNION ALL SELECT 'top_url', url, n FROM top_url""",
    "clean_numeric_text": f"WITH {CLEANED} SELECT house_id, square FROM cleaned",
    "clean_int_text": f"""WITH {CLEANED}
SELECT house_id, maintenance_year, population, communal_service_id FROM cleaned""",
    "clean_register": f"WITH {CLEANED} SELECT * FROM cleaned",
    "empty_rows": """
SELECT count(*) AS empty_rows FROM events WHERE nullif(event_type, 'signup') IS NULL""",
    "duplicate_groups": """
SELECT count(*) AS duplicate_groups
FROM (SELECT text, lang FROM documents GROUP BY text, lang HAVING count(*) > 1)""",
    "quality_report": """
WITH checked AS (SELECT nullif(lang, 'de') AS lang, text, n_chars FROM documents),
repeated AS (SELECT lang FROM checked GROUP BY lang, text, n_chars HAVING count(*) > 1)
SELECT (SELECT count(*) FROM checked) AS rows,
       (SELECT count(*) FROM checked WHERE lang IS NULL) AS empty_rows,
       (SELECT count(*) FROM repeated) AS duplicate_groups""",
    "row_count": "SELECT count(*) AS rows FROM lineitem",
    "realistic_years": f"WITH {CLEANED} SELECT house_id, maintenance_year, square FROM realistic",
    "year_mean_median": f"""WITH {CLEANED}
SELECT round(avg(maintenance_year), 0) AS mean_maintenance_year,
       round(median(maintenance_year), 0) AS median_maintenance_year
FROM realistic""",
    "top_regions": """
SELECT c_nationkey AS region, count(*) AS count FROM customer
GROUP BY region ORDER BY count DESC, region LIMIT 10""",
    "top_localities_labelled": f"""WITH {CLEANED},
counted AS (SELECT locality_name, count(*) AS count FROM realistic GROUP BY locality_name
            ORDER BY count DESC, locality_name NULLS LAST LIMIT 10)
SELECT coalesce(locality_name, 'Неизвестно') AS locality_name, count FROM counted""",
    "extremes_by_group": f"WITH {PART_SIZES}, {_extremes('sizes')} SELECT * FROM extremes",
    "extreme_rows_by_group": f"""WITH {PART_SIZES}
SELECT * FROM sizes
QUALIFY row_number() OVER (PARTITION BY region ORDER BY square, address, house_id) = 1""",
    "largest_rows": f"""WITH {PART_SIZES}
SELECT * FROM sizes
QUALIFY row_number() OVER (PARTITION BY region ORDER BY square DESC, address, house_id) = 1""",
    "spread_top20": f"WITH {PART_SIZES}, {_widest('sizes')}",
    "register_widest_regions": f"WITH {CLEANED}, {_widest('realistic')}",
    "count_by_decade": f"""WITH {CLEANED}
SELECT CAST(floor(maintenance_year / 10) * 10 AS INTEGER) AS decade, count(*) AS building_count
FROM realistic GROUP BY 1 ORDER BY 1 DESC""",
    "decades_since": f"""WITH {CLEANED}
SELECT CAST(floor(maintenance_year / 10) * 10 AS INTEGER) AS decade, count(*) AS building_count
FROM cleaned WHERE maintenance_year >= 1900 GROUP BY 1 ORDER BY 1""",
    "top_by_size": f"WITH {CLEANED} {TOP_BUILDINGS.format(population='population')}",
    "incremental_keys": """
SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""",
    "incremental_load": f"""WITH {CLEANED}, {LOADED}
SELECT house_id, latitude, longitude, maintenance_year, square,
       CAST(population AS BIGINT) AS population, region, locality_name, address, full_address,
       CAST(communal_service_id AS BIGINT) AS communal_service_id, description
FROM loaded""",
    "versioned_load": f"""WITH {CLEANED}, {LOADED}
SELECT house_id, latitude, longitude, maintenance_year, square, population, region, locality_name,
       address, full_address, communal_service_id, description
FROM loaded""",
    "load_by_key_index": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders",
    "warehouse_top_by_size": f"""WITH {CLEANED}, {LOADED}
{TOP_BUILDINGS.format(population='CAST(population AS BIGINT)').replace("cleaned", "loaded")}""",
    "access_log_no_post": f"""WITH {REQUESTS}
SELECT count(*) FILTER (WHERE method = 'GET') AS GET, 0::BIGINT AS POST
FROM requests WHERE method <> 'POST' OR method IS NULL""",
    "empty_row_records": """
SELECT nullif(event_type, 'signup') AS kind, user_id FROM events
WHERE nullif(event_type, 'signup') IS NULL""",
    "repeated_row_records": """
SELECT text, lang, count(*) AS n FROM documents GROUP BY text, lang HAVING count(*) > 1""",
    "quantity_mean_median": """
SELECT round(avg(l_quantity), 2) AS mean_l_quantity, round(median(l_quantity), 2) AS median_l_quantity
FROM lineitem""",
    "price_mean_median": """
SELECT round(avg(l_extendedprice), 2) AS mean_l_extendedprice,
       round(median(l_extendedprice), 2) AS median_l_extendedprice
FROM lineitem""",
    "order_dates_by_customer": f"""WITH dated AS (
  SELECT o_custkey AS region, o_orderdate AS day, 'Order ' || o_orderkey AS address FROM orders),
{_extremes("dated").replace("square", "day")}
SELECT region AS o_custkey, min_address AS min_label, min_day AS min_o_orderdate,
       max_address AS max_label, max_day AS max_o_orderdate FROM extremes""",
    "web_log_report": f"""WITH {DAILY},
top AS (SELECT ip, count(*) AS n FROM web_logs GROUP BY ip ORDER BY n DESC, ip LIMIT 10),
spread AS (SELECT min(total_response_size) AS low, max(total_response_size) AS high,
                  round(avg(total_response_size), 2) AS mean,
                  round(stddev_samp(total_response_size), 2) AS deviation FROM daily)
SELECT 'top_client' AS metric, ip AS key, CAST(n AS DOUBLE) AS value FROM top
UNION ALL SELECT 'method', method, CAST(count(*) AS DOUBLE) FROM web_logs GROUP BY method
UNION ALL SELECT 'not_found', '', CAST(count(*) AS DOUBLE) FROM web_logs WHERE response_code = 404
UNION ALL SELECT 'bytes', date, CAST(total_response_size AS DOUBLE) FROM daily
UNION ALL (SELECT 'most_active_day', date, CAST(total_response_size AS DOUBLE) FROM daily
           ORDER BY total_response_size DESC, date LIMIT 1)
UNION ALL (SELECT 'least_active_day', date, CAST(total_response_size AS DOUBLE) FROM daily
           ORDER BY total_response_size, date LIMIT 1)
UNION ALL SELECT 'min_daily_bytes', '', CAST(low AS DOUBLE) FROM spread
UNION ALL SELECT 'max_daily_bytes', '', CAST(high AS DOUBLE) FROM spread
UNION ALL SELECT 'mean_daily_bytes', '', mean FROM spread
UNION ALL SELECT 'stddev_daily_bytes', '', deviation FROM spread""",
    "register_from_csv": f"WITH {CLEANED}, {_widest('realistic')}",
    "register_from_split_csv": f"WITH {CLEANED}, {_widest('realistic')}",
    "total_revenue": f"""WITH {PURCHASES}
SELECT CAST(coalesce(sum(price * quantity), 0) AS DOUBLE) AS revenue FROM purchases""",
    "items_by_category": "SELECT DISTINCT p_type AS category, p_name AS item FROM part",
    "distinct_items": f"WITH {PURCHASES} SELECT DISTINCT category, item FROM purchases",
    "expensive_purchases": """
SELECT l_orderkey, l_linenumber, l_extendedprice AS price, l_quantity
FROM lineitem WHERE l_extendedprice >= 60000""",
    "avg_price_by_category": f"WITH {PURCHASES} SELECT category, average_price FROM by_category",
    "busiest_category": f"""WITH {PURCHASES}
SELECT category, units FROM by_category ORDER BY units DESC, category LIMIT 1""",
    "purchase_report": f"""WITH {PURCHASES}
SELECT 'total_revenue' AS metric, '' AS key,
       CAST(coalesce(sum(price * quantity), 0) AS DOUBLE) AS value FROM purchases
UNION ALL SELECT 'item_in_category', category || '/' || item, CAST(sum(quantity) AS DOUBLE)
FROM purchases GROUP BY category, item
UNION ALL SELECT 'expensive_purchase', item, CAST(price AS DOUBLE) FROM purchases
WHERE price >= 60000
UNION ALL SELECT 'average_price', category, average_price FROM by_category
UNION ALL (SELECT 'busiest_category', category, CAST(units AS DOUBLE) FROM by_category
           ORDER BY units DESC, category LIMIT 1)""",
    "long_names_upper": "SELECT upper(p_name) AS p_name FROM part WHERE length(p_name) > 3",
    "long_words_upper": """
SELECT p_partkey,
       array_to_string(
         list_transform(list_filter(string_split(p_name, ' '), lambda w: length(w) > 3),
                        lambda w: upper(w)), ' ') AS words
FROM part""",
    "select_sorted": """
SELECT c_name, c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING'
ORDER BY c_acctbal DESC, c_name""",
    "balance_at_least": "SELECT * FROM customer WHERE c_acctbal >= 5000",
    "sql_view_filter": "SELECT * FROM customer WHERE c_acctbal >= 5000",
    "sql_count_not_null": """
SELECT o_orderpriority || '/' || o_custkey % 4 AS locality_name, count(*) AS n FROM orders
WHERE o_orderpriority <> '4-NOT SPECIFIED' GROUP BY 1""",
    "known_population": f"""WITH {CLEANED}
SELECT count(*) AS n FROM cleaned WHERE population IS NOT NULL AND locality_name IS NOT NULL""",
    "parquet_roundtrip": "SELECT * FROM supplier",
    "csv_utf16_roundtrip": "SELECT * FROM documents",
    "preview": "SELECT * FROM supplier ORDER BY s_suppkey LIMIT 5",
}
