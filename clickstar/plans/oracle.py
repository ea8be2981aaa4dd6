"""For each registered query the same result as plain SQL over the benchmark tables.

Where the queries parse text that the adapter wrote, the SQL takes the value the text was written
from, so it does not repeat the parsing.
"""

from __future__ import annotations

from ..operators.candidates import PRODUCT_EVENTS
from ..operators.pages import PRODUCT_FIELDS
from ..sources.seeds import CURRENCY_MAPPING
from . import adapter
from .adapter import DUCK

TODAY = "DATE '2001-12-31'"
EARLY_DAY = "DATE '2001-06-30'"
ORACLE: dict[str, str] = {}


def _select(fields: dict[str, str]) -> str:
    return ", ".join(f"{text} AS {name}" for name, text in fields.items())


def key(text: str) -> str:
    return f"md5({text})"


def stamp(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


def iso(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%dT%H:%M:%S') || '.000000Z'"


def half_up(total: str, n: str) -> str:
    """Average of non-negative whole numbers, rounded half up."""
    return f"((2 * ({total}) + {n}) // (2 * {n}))"


def cents2(x: str) -> str:
    """Two decimals of a double by its decimal text."""
    return f"round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18)), 2)"


MAPPING = "mapping(raw_currency, currency_code, currency_name) AS (VALUES " + ", ".join(
    f"('{raw}', '{code}', '{name}')" for raw, code, name in CURRENCY_MAPPING
) + ")"
RAW = DUCK.pick(adapter.RAW_CURRENCIES, "o_custkey % 37")
RAW_GIFT = DUCK.pick(adapter.RAW_CURRENCIES, "(o_custkey + 1) % 37")

# Orders with typed fields -------------------------------------------------------------------
ORDERS = f"""
ord AS (
  SELECT {_select(adapter.order_fields(DUCK))}, o_orderkey, o_custkey,
         CASE WHEN o_orderkey % 501 <> 0 THEN o_orderdate + to_seconds(o_orderkey % 86400) END AS tm,
         CASE o_custkey % 5 WHEN 0 THEN '.de' WHEN 1 THEN '.com' WHEN 2 THEN '.uk' END AS store_domain,
         'dev' || o_custkey AS device, o_custkey % 32 AS octet
  FROM orders)"""

# Places: nations 7 and 8 have no usable country, region 3 has no city.
PLACES = f"""
place AS (
  SELECT n_nationkey, CASE WHEN n_nationkey NOT IN (7, 8) THEN substr('ABCDEFGHIJKLMNOPQRSTUVWXY', n_nationkey + 1, 1) || substr('VWXYZ', n_regionkey + 1, 1) END AS code,
         CASE WHEN n_nationkey NOT IN (7, 8) AND n_regionkey <> 3 THEN 'City ' || n_nationkey END AS city,
         CASE WHEN n_nationkey NOT IN (7, 8) THEN r_name END AS region,
         CASE WHEN n_nationkey NOT IN (7, 8) THEN n_name END AS country,
         CASE WHEN n_nationkey NOT IN (7, 8) AND n_regionkey <> 2 THEN n_nationkey + 0.5::DOUBLE END AS latitude,
         CASE WHEN n_nationkey NOT IN (7, 8) AND n_regionkey <> 1 THEN -(n_nationkey + 0.25::DOUBLE) END AS longitude
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""

LINES = f"""
item AS (
  SELECT ord.*, l_partkey::VARCHAR AS product_id, {RAW} AS raw_currency, CAST(l_quantity AS BIGINT) AS amount,
         cents::HUGEINT * 10000000 AS nano
  FROM ord JOIN ({adapter.lines_sql()}) ON l_orderkey = o_orderkey
  UNION ALL
  SELECT ord.*, 'gift-' || l_suppkey, {RAW_GIFT}, 1, ((l_suppkey % 90 + 10) * 100 + 50)::HUGEINT * 10000000
  FROM ord JOIN lineitem ON l_orderkey = o_orderkey WHERE l_linenumber % 3 = 0
  UNION ALL
  SELECT ord.*, NULL, NULL, NULL, NULL FROM ord WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)),
line AS (
  SELECT order_id, any_value(device_id) AS device_id, any_value(device) AS device, any_value(user_agent) AS user_agent,
         any_value(user_id_db) AS user_id_db, any_value(email_address) AS email_address, any_value(store_id) AS store_id,
         any_value(store_domain) AS store_domain, any_value(tm) AS tm, any_value(ip) AS ip, any_value(octet) AS octet,
         product_id, raw_currency, sum(amount)::BIGINT AS amount, {half_up('sum(nano)', 'count(nano)')} AS nano
  FROM item GROUP BY order_id, product_id, raw_currency),
placed AS (
  SELECT line.*, coalesce(city, 'XNA') AS location_city_name, coalesce(region, 'XNA') AS location_region_name,
         coalesce(code, 'XNA') AS location_country_code, coalesce(country, 'XNA') AS location_country_name
  FROM line LEFT JOIN place ON octet = n_nationkey)"""

ORACLE["order_lines_normalized"] = f"""
WITH {ORDERS}, {PLACES}, {LINES}
SELECT ip, order_id, device_id, user_agent, user_id_db, email_address, store_id, store_domain,
       {stamp('tm')} AS time_stamp, product_id, raw_currency, amount, nano::DOUBLE / 1e9 AS price,
       location_city_name, location_region_name, location_country_code, location_country_name
FROM placed"""

CUSTOMERS = f"""
state AS (
  SELECT DISTINCT ON (device, tm) device, tm, user_agent, user_id_db, email_address FROM ord WHERE tm IS NOT NULL
  ORDER BY device, tm, email_address IS NULL, user_id_db IS NULL, user_agent IS NULL,
           email_address DESC, user_id_db DESC, user_agent DESC),
marked AS (
  SELECT *, row_number() OVER h = 1 OR user_agent IS DISTINCT FROM lag(user_agent) OVER h
         OR user_id_db IS DISTINCT FROM lag(user_id_db) OVER h
         OR email_address IS DISTINCT FROM lag(email_address) OVER h AS changed
  FROM state WINDOW h AS (PARTITION BY device ORDER BY tm)),
customer_version AS (
  SELECT {key("device || '|' || " + iso('tm'))} AS customer_key, device, tm AS since,
         coalesce(lead(tm) OVER (PARTITION BY device ORDER BY tm), TIMESTAMP '9999-01-01') AS until
  FROM marked WHERE changed)"""

# The last quote of a day is the one with sequence number 1.
CODES = "code AS (SELECT currency_code, row_number() OVER (ORDER BY currency_code) - 1 AS i FROM (SELECT DISTINCT currency_code FROM mapping WHERE currency_code <> 'USD'))"
QUOTES = f"""
quote AS (
  SELECT day, currency_code, 1 + ((i * 13 + dayofyear(day)) % 50 + 1) / CAST(100 AS DOUBLE) AS rate
  FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders WHERE dayofweek(o_orderdate) BETWEEN 1 AND 5), code)"""
DAYS = f"day_known AS (SELECT DISTINCT CAST(tm AS DATE) AS day FROM ord WHERE CAST(tm AS DATE) <= {TODAY})"
CURRENCIES = f"""
currency AS (
  SELECT DISTINCT {key('currency_code')} AS currency_key, currency_code, currency_name
  FROM (SELECT DISTINCT {RAW} AS raw_currency FROM ord WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)) JOIN mapping USING (raw_currency))"""
RATES = f"""
rate AS (
  SELECT day, currency_key, 1 / rate AS to_usd FROM quote JOIN currency USING (currency_code) JOIN day_known USING (day)
  UNION ALL SELECT day, currency_key, 1.0::DOUBLE FROM day_known, currency WHERE currency_code = 'USD')"""

FACT = f"""
keyed AS (
  SELECT p.*, v.customer_key, CASE WHEN product_id NOT LIKE 'gift-%' THEN {key('product_id')} END AS product_key,
         {key("location_city_name || '|' || location_region_name || '|' || location_country_code")} AS location_key,
         c.currency_key, {key("store_id || '|' || store_domain")} AS store_key, d.day AS date_key
  FROM placed p
  LEFT JOIN customer_version v ON v.device = p.device AND p.tm >= since AND p.tm < until
  LEFT JOIN mapping USING (raw_currency) LEFT JOIN currency c USING (currency_code)
  LEFT JOIN day_known d ON CAST(p.tm AS DATE) = d.day),
grouped AS (
  SELECT customer_key, product_key, location_key, currency_key, store_key, date_key, order_id, tm, ip,
         sum(amount)::BIGINT AS sales_amount, {half_up('sum(nano::HUGEINT)', 'count(nano)')} AS nano
  FROM keyed GROUP BY ALL),
fact AS (
  SELECT coalesce(customer_key, '-1') AS customer_key, coalesce(product_key, '-1') AS product_key, location_key,
         coalesce(g.currency_key, '-1') AS currency_key, coalesce(store_key, '-1') AS store_key,
         coalesce(date_key, DATE '1970-01-01') AS date_key, order_id, tm, ip, sales_amount,
         nano::DOUBLE / 1e9 AS sales_local_price, {cents2('nano::DOUBLE / 1e9 * to_usd')} AS usd
  FROM grouped g LEFT JOIN rate r ON r.currency_key = g.currency_key AND r.day = g.date_key)"""
STAR = f"WITH {MAPPING}, {CODES}, {QUOTES}, {ORDERS}, {PLACES}, {LINES}, {CUSTOMERS}, {DAYS}, {CURRENCIES}, {RATES}, {FACT}"

ORACLE["sales_fact"] = f"""{STAR}
SELECT {key("order_id || '|' || product_key || '|' || " + stamp('tm'))} AS detail_key, customer_key, product_key,
       location_key, currency_key, store_key, CAST(date_key AS VARCHAR) AS date_key, order_id, {stamp('tm')} AS time_stamp,
       ip, sales_amount, sales_local_price, usd::DOUBLE AS sales_usd_price FROM fact"""

LOCATION = f"""
dim_location AS (
  SELECT DISTINCT {key("location_city_name || '|' || location_region_name || '|' || location_country_code")} AS location_key,
         location_city_name, location_region_name, location_country_name, location_country_code
  FROM (SELECT coalesce(city, 'XNA') AS location_city_name, coalesce(region, 'XNA') AS location_region_name,
               coalesce(country, 'XNA') AS location_country_name, coalesce(code, 'XNA') AS location_country_code
        FROM ord LEFT JOIN place ON octet = n_nationkey)
  UNION ALL SELECT '-1', 'Unknown', 'Unknown', 'Unknown', 'Unknown')"""

ORACLE["fact_increment"] = ORACLE["sales_fact"]
ORACLE["revenue_by_country"] = f"""{STAR}, {LOCATION}
SELECT location_country_name, location_country_code, sum(usd)::DOUBLE AS Revenue
FROM fact JOIN dim_location USING (location_key) GROUP BY 1, 2"""

ORACLE["revenue_by_weekday"] = f"""{STAR}
SELECT CASE WHEN date_key = DATE '1970-01-01' THEN 0 ELSE dayofweek(date_key) + 1 END AS day_of_week,
       CASE WHEN date_key = DATE '1970-01-01' THEN 'Unknown' ELSE dayname(date_key) END AS day_name,
       sum(usd)::DOUBLE AS total_sales, count(DISTINCT order_id) AS total_orders
FROM fact GROUP BY 1, 2"""

ORACLE["units_by_product"] = f"""{STAR}
SELECT product_key, trim(p_name) AS product_name, count(*) AS unit_sold
FROM fact JOIN part ON product_key = {key('p_partkey::VARCHAR')} GROUP BY 1, 2"""

ORACLE["revenue_mom"] = f"""{STAR},
month AS (
  SELECT year(date_key) AS y, month(date_key) AS m, any_value(monthname(date_key)) AS month_name,
         count(DISTINCT order_id) AS orders, sum(usd) AS revenue
  FROM fact WHERE date_key <> DATE '1970-01-01' GROUP BY 1, 2),
pair AS (SELECT *, lag(revenue) OVER w AS before, lag(orders) OVER w AS orders_before FROM month WINDOW w AS (ORDER BY y, m))
SELECT y AS year_number, m AS month_number, month_name, CAST(make_date(y, m, 1) AS VARCHAR) AS month_start_date,
       printf('%04d-%02d', y, m) AS year_month, orders AS total_orders, revenue::DOUBLE AS current_month_revenue,
       before::DOUBLE AS previous_month_revenue, (revenue - coalesce(before, 0))::DOUBLE AS mom_growth_amount,
       round(CAST((revenue - before)::DOUBLE / nullif(before, 0)::DOUBLE AS DECIMAL(28,9)) * 100, 2)::DOUBLE AS mom_growth_rate_pct,
       orders - coalesce(orders_before, 0) AS mom_order_growth_amount
FROM pair"""

ORACLE["aov_summary"] = f"""{STAR}
SELECT sum(usd * sales_amount)::DOUBLE AS Revenue, count(DISTINCT order_id) AS Orders,
       round(sum(usd * sales_amount)::DOUBLE / greatest(count(DISTINCT order_id), 1), 4) AS AOV,
       count(DISTINCT customer_key) AS count_customer FROM fact"""

ORACLE["dq_not_null"] = f"{STAR} SELECT order_id, product_key FROM fact WHERE tm IS NULL"

ORACLE["dq_table_report"] = f"""{STAR}
SELECT 'detail_key' AS column_name, 'not_null' AS "check", count(*) FILTER (tm IS NULL) AS violations FROM fact
UNION ALL SELECT 'time_stamp', 'not_null', count(*) FILTER (tm IS NULL) FROM fact
UNION ALL SELECT 'sales_amount', 'not_null', count(*) FILTER (sales_amount IS NULL) FROM fact
UNION ALL SELECT 'sales_usd_price', 'not_null', count(*) FILTER (usd IS NULL) FROM fact
UNION ALL SELECT 'customer_key', 'not_null', count(*) FILTER (customer_key IS NULL) FROM fact
UNION ALL SELECT 'detail_key', 'unique', count(*) FROM (
  SELECT 1 FROM fact WHERE tm IS NOT NULL GROUP BY order_id, product_key, tm HAVING count(*) > 1)"""

ORACLE["dq_warehouse"] = f"""{STAR},
report AS (
  SELECT 'detail_key' AS column_name, 'not_null' AS "check", count(*) FILTER (tm IS NULL) AS violations FROM fact
  UNION ALL SELECT 'detail_key', 'unique', count(*) FROM (
    SELECT 1 FROM fact WHERE tm IS NOT NULL GROUP BY order_id, product_key, tm HAVING count(*) > 1)
  UNION ALL SELECT 'order_id, product_key, time_stamp', 'compound_unique', count(*) FROM (
    SELECT 1 FROM fact GROUP BY order_id, product_key, tm HAVING count(*) > 1))
SELECT 'fact_sales_order_detail' AS table_name, * FROM report WHERE violations > 0"""

# Dimensions ---------------------------------------------------------------------------------
EVENTS = f"""
ev AS (
  SELECT {_select(adapter.event_fields(DUCK))}, event_id, user_id, event_type, ts, value,
         date_trunc('second', ts) AS tm, {DUCK.json_k} AS k
  FROM events)"""

VERSIONS = f"""
state AS (
  SELECT DISTINCT ON (device_id, tm) device_id, tm, user_agent, user_id_db, email_address FROM ev
  ORDER BY device_id, tm, email_address IS NULL, user_id_db IS NULL, user_agent IS NULL,
           email_address DESC, user_id_db DESC, user_agent DESC),
marked AS (
  SELECT *, row_number() OVER h = 1 OR user_agent IS DISTINCT FROM lag(user_agent) OVER h
         OR user_id_db IS DISTINCT FROM lag(user_id_db) OVER h
         OR email_address IS DISTINCT FROM lag(email_address) OVER h AS changed
  FROM state WINDOW h AS (PARTITION BY device_id ORDER BY tm)),
version AS (
  SELECT {key("device_id || '|' || " + iso('tm'))} AS customer_key, *, lead(tm) OVER (PARTITION BY device_id ORDER BY tm) AS later
  FROM marked WHERE changed)"""

ORACLE["scd2_customer"] = f"""WITH {EVENTS}, {VERSIONS}
SELECT customer_key, device_id AS customer_device_id, coalesce(user_agent, 'XNA') AS customer_user_agent,
       coalesce(user_id_db, 'XNA') AS customer_user_id_db, coalesce(email_address, 'XNA') AS customer_email_address,
       {stamp('tm')} AS start_time, coalesce({stamp('later')}, '9999-01-01 00:00:00') AS end_time, later IS NULL AS is_current
FROM version
UNION ALL SELECT '-1', 'Unknown', 'Unknown', 'Unknown', 'Unknown', '1900-01-01 00:00:00', '9999-01-01 00:00:00', FALSE"""

ORACLE["scd2_splice"] = ORACLE["scd2_customer"]
ORACLE["scd2_asof_lookup"] = f"""WITH {EVENTS}, {VERSIONS},
fact AS (SELECT event_id, user_id::VARCHAR AS device, tm + to_seconds((event_id % 7 - 3) * 3600) AS moment FROM ev)
SELECT event_id, coalesce(customer_key, '-1') AS customer_key
FROM fact LEFT JOIN version ON device = device_id AND moment >= tm AND (later IS NULL OR moment < later)"""

ORACLE["latest_value_before"] = f"""
WITH second AS (
  SELECT user_id, date_trunc('second', ts) AS tm, max_by(value, event_id) FILTER (event_type = 'error') AS error_value
  FROM events GROUP BY 1, 2)
SELECT user_id, {stamp('tm')} AS "at", last_value(error_value IGNORE NULLS) OVER (
  PARTITION BY user_id ORDER BY tm ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_error
FROM second"""

ORACLE["dq_active_record"] = f"""WITH {EVENTS}, {VERSIONS},
pair AS (SELECT count(DISTINCT device_id) AS total_unique_customers,
  count(DISTINCT CASE WHEN later IS NULL AND user_agent <> 'error' THEN device_id END) AS total_active_customers FROM version)
SELECT * FROM pair WHERE total_unique_customers <> total_active_customers"""

CALENDAR = """{day}, dayofweek({d}) + 1 AS day_of_week, dayname({d}) AS day_name, dayofmonth({d}) AS day_of_month,
  dayofyear({d}) AS day_of_year, weekofyear({d}) AS week_of_year, month({d}) AS month_number, monthname({d}) AS month_name,
  quarter({d}) AS quarter_number, year({d}) AS year_number, dayofweek({d}) IN (0, 6) AS is_weekend"""

ORACLE["dim_calendar"] = f"""WITH {ORDERS}, {DAYS.replace(TODAY, EARLY_DAY)}
SELECT {CALENDAR.format(day='CAST(day AS VARCHAR) AS date_key', d='day')} FROM day_known
UNION ALL SELECT '1970-01-01', 0, 'Unknown', 0, 0, 0, 0, 'Unknown', 0, 0, FALSE"""

ORACLE["calendar_fields"] = f"""
SELECT {CALENDAR.format(day='CAST(d AS VARCHAR) AS day', d='d')}
FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem)"""

ORACLE["dim_store"] = f"""WITH {ORDERS},
store AS (SELECT DISTINCT coalesce(store_id, 'XNA') AS store_id, coalesce(store_domain, 'XNA') AS store_domain FROM ord)
SELECT {key("store_id || '|' || store_domain")} AS store_key, * FROM store UNION ALL SELECT '-1', 'Unknown', 'Unknown'"""

ORACLE["dim_location"] = f"WITH {ORDERS}, {PLACES}, {LOCATION} SELECT * FROM dim_location"

ORACLE["dim_product"] = f"""
SELECT {key('p_partkey::VARCHAR')} AS product_key, p_partkey::VARCHAR AS product_id, trim(p_name) AS product_name,
       CASE WHEN p_size > 5 THEN p_brand ELSE 'XNA' END AS product_sku,
       CASE WHEN p_size % 2 = 0 THEN 'women' ELSE 'XNA' END AS product_gender,
       CAST(p_retailprice AS DECIMAL(12,2))::DOUBLE AS product_base_price,
       (CAST(p_retailprice AS DECIMAL(12,2)) - 1)::DOUBLE AS product_min_price,
       CASE WHEN p_size < 40 THEN (CAST(p_retailprice AS DECIMAL(12,2)) + p_size)::DOUBLE ELSE 0 END AS product_max_price
FROM part UNION ALL SELECT '-1', 'Unknown', 'Unknown', 'Unknown', 'Unknown', 0, 0, 0"""

ORACLE["dim_currency"] = f"""WITH {MAPPING}, {ORDERS}, {CURRENCIES}
SELECT * FROM currency UNION ALL SELECT '-1', 'Unknown', 'Unknown'"""

# Exchange rates -----------------------------------------------------------------------------
ORACLE["fx_pivot"] = f"""WITH {MAPPING}, {CODES}, {QUOTES}
SELECT CAST(day AS VARCHAR) AS date, 'USD' AS base, count(*) AS n_rates, max(rate) FILTER (currency_code = 'EUR') AS eur,
       max(rate) FILTER (currency_code = 'AUD') AS aud, string_agg(currency_code, ',' ORDER BY currency_code) AS codes
FROM quote GROUP BY day"""

ORACLE["fx_flatten"] = f"""WITH {MAPPING}, {CODES}, {QUOTES}
SELECT CAST(day AS VARCHAR) AS date_key, currency_code, rate AS rate_from_base FROM quote"""

ORACLE["fx_rates"] = f"""WITH {MAPPING}, {CODES}, {QUOTES}, {ORDERS}, {DAYS}, {CURRENCIES}, {RATES}
SELECT {key("CAST(day AS VARCHAR) || '|' || currency_key")} AS exchange_rate_key, CAST(day AS VARCHAR) AS date_key,
       currency_key, to_usd AS rate_to_usd FROM rate"""

ORACLE["fx_rejected_quotes"] = f"""WITH {MAPPING}, {CODES}, {QUOTES}
SELECT CAST(day AS VARCHAR) AS date, 2 * count(*) AS n_rejected FROM quote WHERE currency_code IN ('CHF', 'JPY') GROUP BY 1"""

# Functions ----------------------------------------------------------------------------------
ORACLE["price_parse"] = f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, {adapter.price_text()} AS raw_price,
       (cents / 100.0)::DECIMAL(18,2)::DOUBLE AS price FROM ({adapter.lines_sql()})"""

ORACLE["price_rejects"] = f"""
SELECT l_linenumber, count(*) FILTER (spaced) AS n_bad, count(*) FILTER (NOT spaced) AS n_good
FROM (SELECT l_linenumber, l_quantity > 25 AND contains({adapter.price_text()}, ',') AS spaced FROM ({adapter.lines_sql()}))
GROUP BY 1"""

ORACLE["epoch_parse"] = """
WITH e AS (SELECT event_id, event_id % 6 AS kind, CAST(floor(epoch(ts)) AS BIGINT) AS s, date_trunc('second', ts) AS tm FROM events)
SELECT event_id, CASE kind WHEN 0 THEN s::VARCHAR WHEN 1 THEN ' ' || chr(9) || s || ' ' WHEN 2 THEN s || '.0' WHEN 3 THEN ' '
         WHEN 4 THEN s || '000' ELSE (-s)::VARCHAR END AS raw_time,
       CASE WHEN kind < 2 THEN strftime(tm, '%Y-%m-%d %H:%M:%S')
            WHEN kind = 5 THEN strftime(TIMESTAMP '1970-01-01' - to_seconds(s), '%Y-%m-%d %H:%M:%S') END AS time_stamp
FROM e"""

ORACLE["local_date"] = f"""WITH {EVENTS}
SELECT _id, local_time, CASE WHEN event_id % 7 > 2 THEN CAST(CAST(ts AS DATE) AS VARCHAR) END AS date FROM ev"""

ORACLE["url_domain"] = r"""
SELECT page_id, nullif(regexp_extract(lower(regexp_extract(url, '^https?://([^/:]+)', 1)), '(\.[^.]+)$', 1), '') AS store_domain
FROM pages"""

ORACLE["url_validity"] = f"""WITH {EVENTS}
SELECT _id, CASE event_id % 4 WHEN 0 THEN NULL ELSE trim(current_url) END AS url FROM ev"""

ORACLE["id_clean"] = f"""WITH {EVENTS}
SELECT _id, CASE WHEN event_id % 5 > 1 THEN k END AS product_id,
       event_id % 5 > 1 AND event_id % 13 < 12 AND k = (user_id % 50)::VARCHAR AS same FROM ev"""

ORACLE["surrogate_keys"] = f"""
SELECT p_partkey, {key("p_name || '|' || p_brand")} AS name_key,
       CASE WHEN p_size > 10 THEN {key('p_partkey::VARCHAR')} END AS part_key FROM part"""

CANONICAL = "CASE event_id % 6 WHEN 3 THEN trim(ip) WHEN 4 THEN CASE WHEN k = '0' THEN '2001:db8::1:0' ELSE '2001:db8::1:' || k END WHEN 5 THEN ip END"
ORACLE["ip_canonical"] = f"WITH {EVENTS} SELECT _id, ip, {CANONICAL} AS canonical FROM ev"

PLACE_OUTPUT = """city AS city_name, region AS region_name, code AS country_code, country AS country_name, latitude, longitude"""
ORACLE["place_clean"] = f"""WITH {PLACES}
SELECT 167772160 + n_nationkey * 65536 AS ip_from, {PLACE_OUTPUT} FROM place"""

ORACLE["ip_location"] = f"""WITH {EVENTS}, {PLACES},
ips AS (SELECT DISTINCT {CANONICAL} AS ip, CASE WHEN event_id % 6 <> 4 THEN user_id % 32 END AS octet FROM ev)
SELECT ip, {PLACE_OUTPUT} FROM ips LEFT JOIN place ON octet = n_nationkey WHERE ip IS NOT NULL"""

ORACLE["ip_scan_stats"] = f"""WITH {EVENTS},
raw AS (SELECT DISTINCT ip, {CANONICAL} AS canonical FROM ev),
bad AS (SELECT DISTINCT {CANONICAL} AS ip FROM ev WHERE event_id % 6 <> 4 AND user_id % 32 IN (7, 8))
SELECT count(*) AS mongo_unique, count(DISTINCT canonical) AS valid_unique, count(*) - count(canonical) AS invalid,
       count(canonical) - count(DISTINCT canonical) AS normalized_duplicates, count(DISTINCT canonical) AS written,
       count(DISTINCT canonical) FILTER (canonical IN (SELECT ip FROM bad)) AS lookup_errors FROM raw"""

# The narrowest of all ranges that cover an address, found by trying each.
ORACLE["ip_nested_ranges"] = f"""WITH {EVENTS}, {PLACES},
ips AS (SELECT DISTINCT {CANONICAL} AS ip, CASE WHEN event_id % 6 <> 4 THEN user_id % 32 END AS octet FROM ev),
num AS (
  SELECT ip, CASE WHEN octet IS NOT NULL THEN list_reduce(list_transform(string_split(ip, '.'), lambda d: d::BIGINT), lambda a, b: a * 256 + b) END AS address
  FROM ips WHERE ip IS NOT NULL),
base AS (SELECT *, 167772160 + n_nationkey * 65536 AS low FROM place),
ranges AS (
  SELECT low, low + 65535 AS high, city, region, code, country, latitude, longitude, code IS NULL AS bad FROM base
  UNION ALL SELECT low + l, low + h, name || low, r_name, 'ZZ', n_name, CASE WHEN n_regionkey <> 2 THEN n_nationkey + 0.5::DOUBLE END,
    CASE WHEN n_regionkey <> 1 THEN -(n_nationkey + 0.25::DOUBLE) END, false
  FROM base JOIN nation USING (n_nationkey) JOIN region ON n_regionkey = r_regionkey, (VALUES ('inner ', 10, 29), ('over ', 20, 59)) v(name, l, h)
  UNION ALL SELECT 167772155, 167772160 + 40 * 65536, 'wide', 'all', 'WW', 'World', 1.5, NULL, false)
SELECT ip, city AS city_name, region AS region_name, code AS country_code, country AS country_name, latitude, longitude,
       coalesce(bad, false) AS lookup_error
FROM num LEFT JOIN ranges ON address BETWEEN low AND high
QUALIFY row_number() OVER (PARTITION BY ip ORDER BY high - low, low DESC) = 1"""

ORACLE["uri_split"] = r"""
SELECT page_id, regexp_extract(url, '^(\w+)://', 1) AS scheme, regexp_extract(url, '^\w+://([^/]+)', 1) AS bucket,
       trim(regexp_extract(url, '^\w+://[^/]+/(.*)$', 1), '/') AS prefix FROM pages"""

# Increments ---------------------------------------------------------------------------------
LATE = "(o_totalprice > 400000 AND o_orderdate < DATE '1999-01-01')"
ORACLE["incremental_merge"] = f"""
SELECT o_orderkey AS order_id, {stamp('o_orderdate')} AS time_stamp,
       CASE WHEN o_orderdate >= DATE '1999-01-01' OR {LATE} THEN o_totalprice + 1 ELSE o_totalprice END AS price FROM orders"""
ORACLE["incremental_table"] = ORACLE["incremental_merge"]
ORACLE["late_drop"] = f"""
SELECT o_orderkey AS order_id, {stamp('o_orderdate')} AS time_stamp,
       CASE WHEN o_orderdate >= DATE '1999-01-01' THEN o_totalprice + 1 ELSE o_totalprice END AS price FROM orders"""
ORACLE["incremental_scan"] = f"""WITH {EVENTS}
SELECT collection, count(*) AS n, max(_id) AS next_mark FROM ev WHERE event_id > 4321 GROUP BY 1"""

# Enrichment ---------------------------------------------------------------------------------
SIGHTINGS = f"""
sighting AS (
  SELECT _id, collection AS source,
         CASE WHEN collection = 'product_view_all_recommend_clicked' OR event_id % 5 < 2 THEN viewing_product_id ELSE k END AS product_id,
         CASE WHEN collection = 'product_view_all_recommend_clicked' THEN referrer_url
              WHEN event_id % 4 > 0 THEN trim(current_url) END AS url
  FROM ev WHERE collection IN ({", ".join(f"'{name}'" for name in PRODUCT_EVENTS)})),
kept AS (SELECT * FROM sighting WHERE product_id IS NOT NULL),
candidate AS (
  SELECT product_id, url, source, row_number() OVER (PARTITION BY product_id ORDER BY _id) - 1 AS priority
  FROM (SELECT product_id, url, min(_id) AS _id, arg_min(source, _id) AS source FROM kept WHERE url IS NOT NULL GROUP BY 1, 2)
  QUALIFY priority < 3)"""
KNOWN = "(SELECT (n_nationkey * 3)::VARCHAR FROM nation)"

ORACLE["product_sightings"] = f"WITH {EVENTS}, {SIGHTINGS} SELECT product_id, url, source, _id FROM kept"
ORACLE["url_candidates"] = f"WITH {EVENTS}, {SIGHTINGS} SELECT * FROM candidate"
ORACLE["stream_first_n"] = ORACLE["url_candidates"]
ORACLE["new_products"] = f"WITH {EVENTS}, {SIGHTINGS} SELECT DISTINCT product_id FROM kept WHERE product_id NOT IN {KNOWN}"
ORACLE["discovery_counts"] = f"""WITH {EVENTS}, {SIGHTINGS}
SELECT (SELECT count(*) FROM sighting) AS scanned, count(DISTINCT product_id) AS added FROM kept WHERE product_id NOT IN {KNOWN}"""
ORACLE["attempt_urls"] = f"""WITH {EVENTS}, {SIGHTINGS}
SELECT product_id, url, min(priority) AS priority FROM (
  SELECT product_id, url, priority FROM candidate
  UNION ALL SELECT DISTINCT product_id, 'https://shop.example.com/p/' || product_id || '?v=1', 2147483647 FROM candidate)
GROUP BY 1, 2"""

ORACLE["value_frequency"] = f"""WITH {MAPPING}, {ORDERS}, {LINES}
SELECT raw_currency, count(*) AS occurrences FROM item WHERE raw_currency IS NOT NULL GROUP BY 1"""

ORACLE["fx_dates"] = f"""WITH {EVENTS}
SELECT DISTINCT CAST(CAST(ts AS DATE) AS VARCHAR) AS date FROM ev WHERE event_id % 7 > 2 AND event_type = 'purchase'"""
ORACLE["date_scan_stats"] = f"""
SELECT count(*) AS scanned, count(DISTINCT CASE WHEN event_id % 7 > 2 THEN CAST(ts AS DATE) END) AS unique_dates,
       count(*) FILTER (event_id % 7 <= 2) AS invalid_dates,
       count(*) FILTER (event_id % 7 > 2) - count(DISTINCT CASE WHEN event_id % 7 > 2 THEN CAST(ts AS DATE) END) AS duplicate_dates
FROM events WHERE event_type = 'purchase'"""

ORACLE["failure_ledger"] = f"""
SELECT user_id::VARCHAR AS product_id, 'https://shop.example.com/p/' || user_id || '?v=' || (event_id % 3) AS url,
       right('..........' || max_by(event_id, ts), 10) AS last_error, length(max_by(event_type, ts)) + 2001 + length(max_by(event_id, ts)::VARCHAR) AS error_length, count(*) AS occurrences,
       {stamp('max(ts)')} AS last_failed_at,
       max_by(CASE WHEN event_type = 'view' THEN 'via ' || event_id ELSE '' END, ts) AS via
FROM events GROUP BY user_id, event_id % 3"""
ORACLE["failure_ledger"] = f"SELECT * EXCLUDE (via), nullif(via, '') AS recovered_via FROM ({ORACLE['failure_ledger']})"
ORACLE["stream_failure_ledger"] = ORACLE["failure_ledger"]
ORACLE["stream_new_checkpoint"] = ORACLE["failure_ledger"]
ORACLE["increment_null_marks"] = "SELECT event_type, count(*) AS n FROM events GROUP BY event_type"
ORACLE["ledger_drift"] = "SELECT event_type, 2 * count(*) AS n, count(value) AS n_values FROM events GROUP BY event_type"

ORACLE["status_counts"] = f"""WITH {EVENTS}, {SIGHTINGS}
SELECT count(*) FILTER (o_orderstatus = 'O') AS pending, 0 AS in_progress, count(*) FILTER (o_orderstatus = 'F') AS done,
       count(*) FILTER (o_orderstatus NOT IN ('O', 'F')) AS failed, count(*) FILTER (o_orderstatus = 'F') AS results,
       (SELECT count(*) FROM candidate) AS candidate_urls,
       (SELECT count(*) FROM (SELECT DISTINCT user_id, event_id % 3 FROM events)) AS failed_urls
FROM orders"""
ORACLE["pending_products"] = """
SELECT o_orderkey::VARCHAR AS product_id, 'pending' AS status FROM orders WHERE o_orderstatus = 'O' ORDER BY 1 LIMIT 100"""

ORACLE["script_var_extract"] = r"""
SELECT page_id, url, CASE page_id % 4 WHEN 0 THEN regexp_extract(url, '^(https?://[^/?#]+)', 1) || '/api/p?id=' || page_id || '&a=''x'
         WHEN 1 THEN 'https://data.example.com/' || page_id END AS data_url,
       CASE page_id % 4 WHEN 2 THEN 'script variable holds no http(s) url' WHEN 3 THEN 'script variable not found' END AS error
FROM pages"""

PAYLOADS = """
attempt AS (
  SELECT p_partkey::VARCHAR AS id, p_name, priority, 'u' || priority AS url, priority < p_size % 5 AS bad
  FROM part, (VALUES (0), (1), (2), (3)) t(priority)),
judged AS (
  SELECT *, CASE WHEN bad THEN CASE priority WHEN 1 THEN 'product_id differs (wanted ' || id || ', found ' || id || 'x)'
                                             WHEN 2 THEN 'timeout' ELSE 'no object with product_id in the json' END END AS error,
         min(CASE WHEN NOT bad THEN priority END) OVER (PARTITION BY id) AS won
  FROM attempt)"""
ORACLE["json_object_find"] = f"""WITH {PAYLOADS}
SELECT id AS requested, priority,
       CASE WHEN bad AND priority = 1 THEN id || 'x' WHEN bad THEN NULL WHEN priority % 2 = 0 THEN id ELSE id || '.0' END AS found_id,
       CASE WHEN NOT bad AND priority % 2 = 1 THEN 's' END AS sku,
       CASE WHEN bad AND priority = 1 THEN 'n' WHEN NOT bad THEN p_name END AS name, bad AND priority <> 1 AS missing
FROM attempt"""
ORACLE["fetched_products"] = f"""WITH {PAYLOADS}
SELECT id AS requested, priority, url AS source_url, p_name AS name, CASE WHEN priority % 2 = 1 THEN 's' END AS sku
FROM judged WHERE priority = won"""
ORACLE["fetch_failures"] = f"""WITH {PAYLOADS}
SELECT id AS product_id, priority, url, error, 'u' || won AS recovered_via FROM judged WHERE bad"""
ORACLE["lost_products"] = f"""WITH {PAYLOADS}
SELECT id AS product_id, string_agg(url || ': ' || error, ' | ' ORDER BY priority) AS last_error
FROM judged WHERE won IS NULL GROUP BY id"""

ORACLE["dim_audit"] = f"""WITH {ORDERS},
store AS (SELECT DISTINCT coalesce(store_id, 'XNA') AS store_id, coalesce(store_domain, 'XNA') AS store_domain FROM ord
          UNION ALL SELECT 'Unknown', 'Unknown')
SELECT *, '2001-12-31' AS inserted_date, 'dbt' AS inserted_by, '2001-12-31' AS updated_date, 'dbt' AS updated_by FROM store"""
USED = f"used AS (SELECT raw_currency, count(*) AS occurrences FROM item WHERE raw_currency IS NOT NULL GROUP BY 1)"
ORACLE["seed_usage"] = f"""WITH {MAPPING}, {ORDERS}, {LINES}, {USED}
SELECT raw_currency, currency_code, occurrences FROM used JOIN mapping USING (raw_currency)"""
ORACLE["dq_seed"] = f"""WITH {MAPPING}, {ORDERS}, {PLACES}, {LINES}, {USED},
seed AS (SELECT * FROM used LEFT JOIN mapping USING (raw_currency))
SELECT 'raw_currency' AS column_name, 'not_null' AS "check", count(*) FILTER (raw_currency IS NULL) AS violations FROM seed
UNION ALL SELECT 'raw_currency', 'unique', count(*) FROM (SELECT raw_currency FROM seed GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'currency_code', 'not_null', count(*) FILTER (currency_code IS NULL) FROM seed
UNION ALL SELECT 'currency_name', 'not_null', count(*) FILTER (currency_name IS NULL) FROM seed"""
ORACLE["lost_without_url"] = f"""WITH {PAYLOADS}
SELECT id AS product_id, string_agg(CASE WHEN priority % 2 = 1 THEN url ELSE '' END || ': ' || error, ' | ' ORDER BY priority) AS last_error
FROM judged WHERE won IS NULL GROUP BY id"""
ORACLE["json_object_hard"] = """
SELECT p_partkey, CASE WHEN p_partkey % 40 NOT IN (1, 2) THEN p_partkey::VARCHAR END AS found_id,
       CASE WHEN p_partkey % 40 NOT IN (1, 2) THEN 'a' || chr(65533) END AS name,
       CASE p_partkey % 40 WHEN 1 THEN 'payload is no json' WHEN 2 THEN 'payload is nested too deep' END AS error
FROM part"""

# Landing ------------------------------------------------------------------------------------
ORACLE["string_leaf"] = """
SELECT o_orderkey::VARCHAR AS o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS placed_at,
       strftime(o_orderdate, '%Y-%m-%d') AS day, CASE WHEN o_custkey % 2 = 0 THEN 'true' ELSE 'false' END AS even,
       o_custkey::VARCHAR AS item_id, base64(o_orderstatus::BLOB) AS item_raw, CAST(o_totalprice AS DECIMAL(12,2))::VARCHAR AS total,
       CAST(o_totalprice AS VARCHAR) AS price
FROM orders"""
ORACLE["string_leaf_floats"] = """
SELECT o_orderkey::VARCHAR AS o_orderkey, CAST(o_orderkey * 10245000.0::DOUBLE AS VARCHAR) AS large,
       CAST(o_orderkey / 8589934592.0::DOUBLE AS VARCHAR) AS small FROM orders"""
ORACLE["string_leaf_vectors"] = """
SELECT vec_id::VARCHAR AS vec_id, label::VARCHAR AS label, len(embedding) AS n,
       array_to_string(list_transform(embedding, lambda x: CAST(CAST(x AS DOUBLE) AS VARCHAR)), ',') AS texts FROM embeddings"""
ORACLE["harmonize_rejects"] = """
SELECT event_id, CASE WHEN event_id % 10 > 3 THEN event_id::VARCHAR END AS id, event_id % 10 <= 3 AS rejected FROM events"""
ORACLE["harmonize_documents"] = """
SELECT conv_id::VARCHAR AS id, turn::VARCHAR AS turn, role, CASE WHEN turn % 4 < 3 THEN 1 END AS n_tags,
       CASE WHEN turn % 4 = 2 THEN 'legacy' END AS tag_value,
       CASE turn % 4 WHEN 0 THEN 'a' WHEN 1 THEN 'b' END AS tag_name, CASE WHEN turn % 4 = 0 THEN '1.5' END AS tag_w,
       CASE WHEN turn % 4 = 0 THEN '5' END AS meta_value, CASE WHEN turn % 4 > 0 THEN 'true' END AS meta_x,
       'c' || conv_id || '-' || turn AS own_id, turn::VARCHAR AS own_n
FROM conversations WHERE conv_id % 10 <> 9"""
ORACLE["harmonize_tables"] = """
SELECT c_custkey AS id, c_acctbal AS balance, c_mktsegment AS note FROM customer
UNION ALL SELECT s_suppkey, s_nationkey, s_name FROM supplier"""
ORACLE["bulk_rewrite"] = """
SELECT 'migrated' AS status, count(*) AS rows FROM events UNION ALL SELECT 'skipped', 0
UNION ALL SELECT 'text ' || event_type, count(*) FROM events GROUP BY event_type"""

FOLDERS = DUCK.pick(["mongodb_data_string/", "location_data/", "product_data/", "exchange_rate_data/", "Product_data/"], "event_id % 5")
ENDINGS = DUCK.pick([".jsonl", ".JSONL", ".parquet"], "event_id % 3")
ROUTED = f"""
routed AS (
  SELECT 'landing' AS bucket, {FOLDERS} || (event_id % 1000) || {ENDINGS} AS name, user_id % 3 AS generation,
         CASE event_id % 5 WHEN 0 THEN 'raw_mongo' WHEN 1 THEN 'raw_location' WHEN 2 THEN 'raw_product' ELSE 'raw_exchange_rate' END AS destination
  FROM events WHERE event_type <> 'error' AND event_id % 5 < 4 AND (event_id % 5 = 0) = (event_id % 3 = 2))"""
ORACLE["route_files"] = f"WITH {ROUTED} SELECT * FROM routed"
ORACLE["ledger_append"] = f"""WITH {ROUTED}
SELECT DISTINCT 'gcs_load_' || sha256('landing' || chr(10) || name || chr(10) || generation) AS load_id, name, generation, destination
FROM routed WHERE generation <> 0"""
ORACLE["ledger_load"] = "SELECT event_type, count(*) AS n, max(event_id) AS last_event FROM events GROUP BY 1"

BATCHES = """
batch AS (
  SELECT file_no, min(_id) AS first_id, max(_id) AS last_id, count(*) AS document_count
  FROM (SELECT lpad(event_id::VARCHAR, 24, '0') AS _id, (row_number() OVER (ORDER BY event_id) - 1) // 1500 + 1 AS file_no FROM events)
  GROUP BY 1)"""
ORACLE["batch_manifest"] = f"WITH {BATCHES} SELECT * FROM batch"
ORACLE["batch_object_ids"] = """
SELECT (n - 1) // 1500 + 1 AS file_no, min(_id) AS first_id, max(_id) AS last_id, count(*) AS document_count
FROM (SELECT _id, row_number() OVER (ORDER BY _id) AS n FROM (
  SELECT printf('%08x', floor(epoch(ts))::BIGINT) || printf('%016x', event_id) AS _id FROM events))
GROUP BY 1"""
ORACLE["batch_commit"] = ORACLE["batch_manifest"]
ORACLE["manifest_states"] = f"""WITH {BATCHES}
SELECT file_no, CASE WHEN file_no > 3 THEN 'new' WHEN file_no = 2 THEN 'conflict' ELSE 'recovered' END AS state FROM batch"""
ORACLE["load_state"] = f"""WITH {BATCHES}
SELECT max_by(last_id, file_no) AS last_mongo_id, max(file_no) + 1 AS next_file_number,
       sum(document_count)::BIGINT AS documents_uploaded, 'mongodb_data/' || max(file_no) || '.parquet' AS last_object FROM batch"""
ORACLE["load_report"] = """
SELECT count(*) AS total_rows, position, name, type, mode
FROM embeddings, (VALUES (0, 'vec_id', 'bigint', 'NULLABLE'), (1, 'embedding', 'array<float>', 'REPEATED'),
                         (2, 'label', 'int', 'NULLABLE')) c(position, name, type, mode)
GROUP BY ALL"""
ORACLE["jsonl_roundtrip"] = """
SELECT p_partkey::VARCHAR AS product_id, p_name AS name, CASE WHEN p_size > 5 THEN p_brand END AS sku,
       'https://shop.example.com/p/' || p_partkey AS source_url FROM part"""

ORACLE["stream_ingest"] = "SELECT event_id, user_id, event_type, value FROM events"
ORACLE["stream_routes"] = """
SELECT event_type AS kind, count(*) AS n FROM events GROUP BY 1 UNION ALL SELECT c_mktsegment, count(*) FROM customer GROUP BY 1"""
ORACLE["stream_increments"] = "SELECT event_id, value FROM events"

# Data quality -------------------------------------------------------------------------------
ORACLE["dq_unique"] = "SELECT l_partkey, count(*) AS n_records FROM lineitem GROUP BY 1 HAVING count(*) > 1"
ORACLE["dq_compound_unique"] = """
SELECT l_orderkey, l_partkey, count(*) AS n_records FROM lineitem WHERE l_quantity > 0 GROUP BY 1, 2 HAVING count(*) > 1"""
ORACLE["dq_relationship"] = """
SELECT l_orderkey + 100 AS order_id, count(*) AS n_records FROM lineitem
WHERE l_orderkey + 100 NOT IN (SELECT o_orderkey FROM orders) GROUP BY 1"""
ORACLE["dq_not_in"] = """
SELECT CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS day, count(*) AS n_lines FROM lineitem
WHERE CAST(l_shipdate AS DATE) NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders) GROUP BY 1"""
ORACLE["dq_mapping"] = f"""WITH {MAPPING},
proposed AS (
  SELECT DISTINCT raw_currency, currency_code, currency_name FROM mapping UNION
  SELECT CASE n_nationkey WHEN 1 THEN '€' WHEN 2 THEN 'BTC' WHEN 3 THEN 'points' ELSE n_name END,
         CASE WHEN n_nationkey = 2 THEN 'XBT' ELSE 'P1' END, 'coin' FROM nation),
seen AS (SELECT DISTINCT {RAW} AS raw_currency FROM orders)
SELECT p.*, CASE WHEN raw_currency NOT IN (SELECT raw_currency FROM seen) THEN 'not observed'
                 WHEN NOT regexp_full_match(currency_code, '[A-Z]{{3}}') THEN 'bad code'
                 WHEN count(*) OVER (PARTITION BY raw_currency) > 1 THEN 'conflicting rows' END AS problem
FROM proposed p"""
ORACLE["masked_customer"] = "SELECT c_custkey, sha256(lower(c_name || '@example.com')) AS email_address FROM customer"
ORACLE["key_lookup"] = """
SELECT o_orderkey, coalesce(c_mktsegment, 'Unknown') AS segment FROM orders LEFT JOIN customer ON c_custkey = o_custkey - 100"""


# Further jobs ------------------------------------------------------------------------------
ORACLE["currency_convert"] = f"""WITH {MAPPING}, {CODES}, {QUOTES},
priced AS (
  SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, CAST(o_totalprice AS DECIMAL(18,2))::DOUBLE AS price,
         {DUCK.pick(["EUR", "USD", "SEK", "XXX"], "o_custkey % 4")} AS currency_code FROM orders)
SELECT o_orderkey, {cents2("price * CASE WHEN currency_code = 'USD' THEN 1 ELSE 1 / rate END")}::DOUBLE AS usd
FROM priced LEFT JOIN quote USING (day, currency_code)"""
ORACLE["candidate_sources"] = f"WITH {EVENTS}, {SIGHTINGS} SELECT source, priority, count(*) AS n_urls FROM candidate GROUP BY 1, 2"
ORACLE["dim_views"] = f"""WITH {ORDERS}, {CUSTOMERS}
SELECT count(DISTINCT device) AS customers, count(*) AS versions,
       count(*) FILTER (until = TIMESTAMP '9999-01-01') AS current_versions FROM customer_version"""

# Proof of order, descriptions, zones and whole products ------------------------------------
def _ranked(report: str, key: str, direction: str = "") -> str:
    # Where keys are equal, any of their rows may stand at a place; the key there is the same.
    return f"SELECT '{report}' AS report, row_number() OVER (ORDER BY {key} {direction}) AS place, {key} AS key FROM"


ORACLE["report_order"] = f"""
{_ranked("revenue_by_country", "Revenue", "DESC")} ({ORACLE["revenue_by_country"]})
UNION ALL {_ranked("revenue_by_weekday", "day_of_week::DOUBLE")} ({ORACLE["revenue_by_weekday"]})
UNION ALL {_ranked("units_by_product", "unit_sold::DOUBLE", "DESC")} ({ORACLE["units_by_product"]})
UNION ALL {_ranked("revenue_mom", "(year_number * 100 + month_number)::DOUBLE")} ({ORACLE["revenue_mom"]})
UNION ALL {_ranked("fx_dates", "(date::DATE - DATE '1970-01-01')::DOUBLE")} ({ORACLE["fx_dates"]})
UNION ALL SELECT 'export', row_number() OVER (ORDER BY p_partkey::VARCHAR), p_partkey::DOUBLE FROM part"""

ORACLE["fact_comments"] = f"""{STAR}
SELECT column_name, description, CASE column_name WHEN 'sales_usd_price' THEN count(usd) WHEN 'detail_key' THEN count(tm)
         WHEN 'sales_amount' THEN count(sales_amount) WHEN 'sales_local_price' THEN count(sales_amount) ELSE count(*) END AS n_values
FROM fact, (VALUES ('detail_key', 'Key of an order line.'),
  ('customer_key', 'Key of one version of a customer; -1 is the unknown customer.'),
  ('product_key', 'Key of a product; -1 is the unknown product.'), ('location_key', 'Key of a place; -1 is the unknown place.'),
  ('currency_key', 'Key of a currency; -1 is the unknown currency.'), ('store_key', 'Key of a store; -1 is the unknown store.'),
  ('date_key', 'Calendar day; 1970-01-01 is the unknown day.'), ('sales_amount', 'Units of the product in the order.'),
  ('sales_local_price', 'Unit price in the currency of the order.'),
  ('sales_usd_price', 'Unit price in USD by the rate of the day; empty without a rate.')) AS d(column_name, description)
GROUP BY column_name, description"""

ORACLE["zone_days"] = """
SELECT zone, CAST(CAST(ts + to_minutes(shift) AS DATE) AS VARCHAR) AS day, count(*) AS n
FROM events, (VALUES ('Asia/Saigon', 420), ('Asia/Kolkata', 330), ('UTC', 0)) z(zone, shift) GROUP BY 1, 2"""

ORACLE["product_records"] = "SELECT " + ", ".join(
    f"'v{i}-' || p_partkey AS {name}" if not i else f"CASE WHEN (p_partkey + {i}) % 5 > 1 THEN 'v{i}-' || p_partkey END AS {name}"
    for i, name in enumerate(PRODUCT_FIELDS)
) + " FROM part"
