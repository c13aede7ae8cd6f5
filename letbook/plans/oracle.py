"""SQL twins of the registered queries, for DuckDB on the same tables.

They read the source columns directly: where a query renders and parses text, its twin says
what has to come out.
"""

from __future__ import annotations

from letbook.fixed import ROOM_DOMAIN, ROOM_SEARCH_URL, ROOM_SOURCE, SALE_SEARCH_URL, SALE_VIEW

SALE = """
sale_src AS (
  SELECT 'https://example.test/properties/' || o_orderkey AS url,
         'N' || c_nationkey AS postcode,
         CASE WHEN o_orderkey % 17 <> 0 THEN CAST(floor(o_totalprice) AS BIGINT) END AS price,
         CAST(o_orderkey % 6 AS INTEGER) AS bedrooms,
         c_mktsegment AS property_type,
         c_name AS address,
         o_orderdate AS scraped_at,
         o_orderkey AS listing_no
  FROM orders JOIN customer ON o_custkey = c_custkey
)"""

ROOM = """
room_src AS (
  SELECT 'rooms' AS source,
         'R' || (user_id % 40) AS postcode,
         'Room ' || event_id AS title,
         'https://example.test/rooms/' || event_id AS url,
         CASE WHEN event_id % 13 = 0 THEN 'POA'
              ELSE '£' || CAST(floor(value) AS BIGINT) || ' pcm' END AS price_text,
         'Area ' || (user_id % 40) AS location,
         event_type AS room_type,
         CASE WHEN event_id % 5 <> 0 THEN 'Available now' END AS available,
         ts AS scraped_at,
         CASE WHEN event_id % 13 <> 0 THEN CAST(floor(value) AS BIGINT) END AS price_norm,
         event_id
  FROM events
)"""

DETAIL = """
model_src AS (
  SELECT url, listing_no, address, scraped_at, bedrooms,
         CASE WHEN listing_no % 3 = 0 THEN postcode
              ELSE postcode || ' ' || (listing_no % 7) || 'XX' END AS postcode,
         CASE WHEN listing_no % 5 <> 1 THEN price END AS price,
         price AS any_price,
         CASE WHEN listing_no % 2 = 0 THEN property_type ELSE 'Flat' END AS property_type,
         CASE WHEN listing_no % 4 <> 0 THEN (listing_no % 90) || ' sq m' END AS floor_area,
         listing_no % 23 <> 0 AS has_model,
         listing_no % 19 <> 0 AS fetched
  FROM sale_src
)"""

PAGING = """
paging_src AS (
  SELECT o_custkey, page_idx, count(*) FILTER (WHERE o_orderkey % 7 <> 0) AS n_items, min(o_orderkey) AS first_order,
         CASE WHEN min(o_orderkey) % 11 = 0 THEN 503
              WHEN min(o_orderkey) % 13 = 0 THEN 0 ELSE 200 END AS http_status
  FROM (SELECT o_custkey, o_orderkey,
               CAST(floor((row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) / 5)
                    AS INTEGER) AS page_idx
        FROM orders)
  GROUP BY ALL
)"""

ATTEMPTS = """
ranked AS (
  SELECT user_id || '-' || strftime(ts, '%Y-%m-%d') AS series, ts, event_id, value, event_type <> 'error' AS ok,
         row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) - 1 AS place
  FROM events
), attempts_src AS (
  SELECT series || '-' || CAST(floor(place / 3) AS BIGINT) AS url, CAST(place % 3 + 1 AS INTEGER) AS pass_no,
         CASE WHEN ok THEN '200' WHEN event_id % 3 = 0 THEN '429'
              WHEN event_id % 3 = 1 THEN '404' ELSE 'fail' END AS http_status,
         ts, event_id, value, ok
  FROM ranked
)"""

SERIES = """
series_ev AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events
), series_ev2 AS (
  SELECT *, CAST(floor((rn - 1) / 3) AS INTEGER) AS page_idx FROM series_ev
), series_pages AS (
  SELECT user_id, page_idx, max(ts) AS fetched_at, count(*) FILTER (WHERE event_id % 9 <> 0) AS n_cards,
         CASE WHEN min(event_id) % 11 = 0 THEN 503 WHEN min(event_id) % 13 = 0 THEN 0 ELSE 200 END AS http_status
  FROM series_ev2 GROUP BY user_id, page_idx
), series_stops AS (
  SELECT user_id, min(page_idx) FILTER (
    WHERE CASE WHEN http_status = 200 THEN n_cards < 3 ELSE page_idx = 0 END) AS stop_idx
  FROM series_pages GROUP BY user_id
), series_seen AS (
  SELECT p.* FROM series_pages p JOIN series_stops USING (user_id) WHERE stop_idx IS NULL OR page_idx <= stop_idx
), series_last AS (
  SELECT user_id, coalesce(arg_max(http_status, page_idx) FILTER (WHERE http_status <> 0), 200) AS status,
         bool_or(page_idx = 0 AND http_status = 200) AS first_html
  FROM series_seen GROUP BY user_id
), series_events AS (
  SELECT user_id, CASE WHEN first_html AND status = 200 THEN 'completed' ELSE 'failed' END AS status FROM series_last
), series_urls AS (
  SELECT e.user_id, e.event_id, e.rn, e.event_type, e.value, s.fetched_at
  FROM series_ev2 e JOIN series_seen s ON e.user_id = s.user_id AND e.page_idx = s.page_idx
  WHERE s.http_status = 200 AND e.event_id % 9 <> 0
  QUALIFY row_number() OVER (PARTITION BY e.user_id, e.event_id % 6, CAST(floor(e.event_id / 6) AS BIGINT) % 2
                             ORDER BY e.rn) = 1
), series_rows AS (
  SELECT * FROM series_urls
  QUALIFY row_number() OVER (PARTITION BY user_id, event_id % 6 ORDER BY rn) = 1
)"""

FETCH = """
fetch_src AS (
  SELECT event_type AS worker, event_id, CASE WHEN event_id % 90 <> 0 THEN value / 1000 END AS latency_s,
         CASE WHEN event_id % 90 <> 0 THEN CAST(round(value / 1000 * 1000000) AS BIGINT) END AS micros,
         event_id % 70 = 0 AS failed, ts AS finished_at
  FROM events
), counted AS (
  SELECT *,
         row_number() OVER w AS done,
         count(*) OVER (PARTITION BY worker) AS total,
         min(epoch_us(finished_at) - coalesce(micros, 0)) OVER (PARTITION BY worker) AS started,
         CAST(sum(CASE WHEN failed THEN 1 ELSE 0 END) OVER w AS BIGINT) AS errors,
         coalesce(CAST(sum(micros) OVER r AS DOUBLE) / count(micros) OVER r / 1000000, 0.25) AS mean_latency
  FROM fetch_src
  WINDOW w AS (PARTITION BY worker ORDER BY finished_at, event_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         r AS (PARTITION BY worker ORDER BY finished_at, event_id
               ROWS BETWEEN 299 PRECEDING AND CURRENT ROW)
), timed AS (
  SELECT *, done / total AS fraction,
         (epoch_us(finished_at) - started) / 1000000 AS elapsed_s
  FROM counted
)"""

VARIANTS = """
variants AS (
  SELECT 'https://example.test/c/' || c_custkey AS url, c_name AS address,
         CASE WHEN c_custkey % 4 <> 0 THEN 'N' || c_nationkey ELSE '' END AS postcode,
         CAST(floor(c_acctbal) AS BIGINT) AS price, c_custkey % 5 AS bedrooms,
         c_mktsegment AS property_type,
         CASE WHEN c_custkey % 9 <> 0 THEN 200 END AS status,
         TIMESTAMP '2023-11-14 22:13:20' + to_minutes(c_custkey) AS scraped_at
  FROM customer
  UNION ALL
  SELECT 'https://example.test/s/' || s_suppkey, s_name, 'N' || s_nationkey,
         CAST(floor(s_acctbal) AS BIGINT), NULL, NULL,
         CASE WHEN s_suppkey % 9 <> 0 THEN 200 END, NULL
  FROM supplier
)"""

LEDGER = """
ledger_events AS (
  SELECT 'docs' AS source, CAST(doc_id AS VARCHAR) AS key,
         CASE WHEN quality = 1 THEN 'completed' ELSE 'failed' END AS status,
         'r1' AS run_id, TIMESTAMP '1970-01-01 00:16:40' AS updated_at
  FROM labels
  UNION ALL
  SELECT 'docs', CAST(doc_id AS VARCHAR),
         CASE WHEN toxic = 0 THEN 'completed' ELSE 'failed' END, 'r2', TIMESTAMP '1970-01-01 00:33:20'
  FROM labels WHERE doc_id % 3 = 0
  UNION ALL
  SELECT 'other', CAST(doc_id AS VARCHAR), 'completed', 'r1', TIMESTAMP '1970-01-01 00:50:00'
  FROM labels WHERE doc_id % 2 = 0
), ledger_now AS (
  SELECT * FROM ledger_events
  QUALIFY row_number() OVER (PARTITION BY source, key ORDER BY updated_at DESC, run_id DESC) = 1
)"""

HREFS = """
hrefs AS (
  SELECT page_id, url, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href FROM pages
), links AS (
  SELECT DISTINCT page_id, 'https://example.test' || split_part(href, '#', 1) AS url
  FROM hrefs WHERE contains(href, '/')
)"""


def _progress(done_from: int, early: str, cap: str | None, whole: bool = False) -> str:
    eta = f"CASE WHEN done >= {done_from} THEN elapsed_s / fraction - elapsed_s ELSE {early} END"
    eta = f"CASE WHEN ({eta}) < 0 THEN 0.0 ELSE ({eta}) END"
    if cap:
        eta = f"CASE WHEN ({eta}) > {cap} THEN {cap} ELSE ({eta}) END"
    if whole:
        eta = f"floor({eta})"
    return f"""
WITH {FETCH}, est AS (SELECT *, CAST({eta} AS DOUBLE) AS eta FROM timed)
SELECT event_id, done, total, fraction, elapsed_s,
       eta AS eta_s,
       CASE WHEN eta IS NULL THEN '--:--'
            ELSE format('{{:02d}}:{{:02d}}', CAST(floor(floor(eta) / 60) AS BIGINT),
                        CAST(floor(eta) AS BIGINT) % 60) END AS eta_text
FROM est"""


ORACLE: dict[str, str] = {
    "sale_from_pages": f"""
WITH {SALE}, {DETAIL}, rows AS (
  SELECT nullif(CASE WHEN has_model AND fetched THEN postcode END, '') AS postcode,
         CASE WHEN has_model AND fetched THEN price END AS price
  FROM model_src
)
SELECT postcode, count(*) AS listings, avg(price) AS avg_price
FROM rows GROUP BY postcode ORDER BY listings DESC, postcode NULLS LAST LIMIT 20""",
    "sale_by_postcode": f"""
WITH {SALE}
SELECT postcode, count(*) AS listings, avg(price) AS avg_price
FROM sale_src GROUP BY postcode ORDER BY listings DESC, postcode LIMIT 20""",
    "room_by_postcode": f"""
WITH {ROOM}
SELECT postcode, count(*) AS rooms, avg(price_norm) AS avg_price
FROM room_src GROUP BY postcode ORDER BY rooms DESC, postcode LIMIT 20""",
    "selection_count": f"""
WITH {SALE}
SELECT count(*) AS listings FROM sale_src
WHERE starts_with(postcode, 'N1') AND property_type IN ('BUILDING', 'MACHINERY') AND bedrooms BETWEEN 0 AND 3""",
    "sql_surface": f"""
WITH {SALE}, {ROOM}
SELECT postcode, count(*) AS rooms, avg(price_norm) AS avg_price
FROM room_src WHERE replace(postcode, 'R', 'N') IN (SELECT postcode FROM sale_src)
GROUP BY postcode ORDER BY rooms DESC, postcode LIMIT 20""",
    "location_lookup": """
SELECT r_name, n_name, count(*) AS customers, avg(floor(c_acctbal)) AS avg_balance
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
GROUP BY r_name, n_name""",
    "load_sale": f"""
WITH {VARIANTS}
SELECT url, address, nullif(postcode, '') AS postcode, CAST(price AS DOUBLE) AS price,
       CAST(bedrooms AS DOUBLE) AS bedrooms, property_type, CAST(NULL AS VARCHAR) AS floor_area, status, scraped_at
FROM variants""",
    "sale_view": f"""
WITH {VARIANTS}
SELECT nullif(postcode, '') AS postcode, CAST(price AS DOUBLE) AS price, CAST(bedrooms AS DOUBLE) AS bedrooms,
       property_type, address, url, scraped_at
FROM variants
WHERE scraped_at >= TIMESTAMP '2023-11-15 00:00:00' AND starts_with(postcode, 'N1')
  AND property_type IN ('BUILDING', 'MACHINERY') AND bedrooms <= 3 AND price >= 0
ORDER BY scraped_at DESC NULLS LAST, url""",
    "scan_promote": f"""
WITH {VARIANTS}
SELECT url, postcode, price, bedrooms, property_type, status, scraped_at FROM variants""",
    "load_room": f"""
WITH {ROOM}
SELECT source, postcode, title, url, price_text, location, room_type, available, scraped_at, price_norm
FROM room_src""",
    "coerce_numeric": """
SELECT o_orderkey, CASE WHEN o_orderkey % 5 > 2 THEN o_totalprice END AS price FROM orders""",
    "coerce_time": """
SELECT o_orderkey, CASE WHEN o_orderkey % 4 > 1 THEN date_trunc('second', o_orderdate) END AS scraped_at
FROM orders""",
    "normalize_sale": """
SELECT 'https://example.test/properties/' || o_orderkey AS url,
       CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority ELSE '' END AS address,
       '' AS postcode,
       CASE WHEN o_orderkey % 17 <> 0 THEN CAST(floor(o_totalprice) AS BIGINT) END AS price,
       CASE WHEN o_orderkey % 4 > 1 THEN CAST(o_orderkey % 9 AS INTEGER) END AS bedrooms,
       '' AS property_type, '' AS floor_area,
       CASE WHEN o_orderkey % 5 = 0 THEN 'fail' ELSE '200' END AS status,
       o_orderdate AS scraped_at
FROM orders""",
    "sale_rejects": """
SELECT o_orderkey AS listing_no FROM orders WHERE o_orderkey % 4 = 1 OR o_orderkey % 6 = 0""",
    "normalize_room": f"""
WITH {ROOM}
SELECT '{ROOM_SOURCE}' AS source, postcode, title, url, price_text, location, room_type,
       coalesce(available, '') AS available, scraped_at,
       CASE WHEN length(postcode) = 2 THEN 200 ELSE 0 END AS status
FROM room_src""",
    "filter_prefix": "SELECT * FROM part WHERE starts_with(p_type, 'ECO')",
    "filter_in": "SELECT * FROM part WHERE p_type IN ('ECONOMY', 'LARGE')",
    "filter_range": "SELECT * FROM part WHERE p_size >= 0 AND p_size <= 25 AND p_retailprice >= 905.0",
    "filter_combined": f"""
WITH {SALE}
SELECT url, postcode, price, bedrooms, property_type FROM sale_src
WHERE starts_with(postcode, 'N2') AND property_type IN ('BUILDING', 'AUTOMOBILE')
  AND bedrooms >= 1 AND bedrooms <= 4 AND price >= 50000""",
    "project_tolerant": "SELECT p_brand, p_partkey, p_size FROM part",
    "facets": """
SELECT DISTINCT nullif(p_brand, 'Brand#2') AS p_brand FROM part WHERE p_brand <> 'Brand#2' ORDER BY p_brand""",
    "latest_sale": f"""
WITH {SALE}, rows AS (
  SELECT * REPLACE (CASE WHEN listing_no % 10 <> 0 THEN scraped_at END AS scraped_at) FROM sale_src
)
SELECT postcode, price, bedrooms, property_type, address, url, scraped_at FROM rows
ORDER BY scraped_at DESC NULLS LAST, url""",
    "latest_room": f"""
WITH {ROOM}
SELECT postcode, price_norm, room_type, location, url, scraped_at FROM room_src
ORDER BY scraped_at DESC NULLS LAST, url""",
    "money_extract": """
SELECT o_orderkey, CASE WHEN o_orderkey % 7 > 1 THEN CAST(floor(o_totalprice) AS BIGINT) END AS price_norm
FROM orders""",
    "url_param": r"""
SELECT page_id, nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page,
       nullif(regexp_extract(url, '[?&]utm_source=([^&#]*)', 1), '') AS source,
       'a b ' || page_id AS ref
FROM pages""",
    "url_absolute": f"""
WITH {HREFS}, both_kinds AS (SELECT page_id, href FROM hrefs UNION ALL SELECT page_id, url FROM hrefs)
SELECT DISTINCT page_id,
       CASE WHEN starts_with(href, 'http') THEN href ELSE 'https://example.test' || href END AS link
FROM both_kinds""",
    "url_fragment": r"""
SELECT page_id, 'https://example.test' ||
       split_part(regexp_extract(url, '^https?://[^/]*(.*)$', 1), '#', 1) AS link
FROM pages""",
    "json_path": """
SELECT event_id, json_extract_string(props, '$.k') AS k, CAST(NULL AS VARCHAR) AS leaf,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS k_int
FROM events""",
    "first_truthy": """
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus
                        WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS value
FROM orders""",
    "first_in_array": """
SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL
                        WHEN o_orderkey % 2 = 0 THEN o_orderstatus
                        WHEN o_orderkey % 3 = 0 THEN o_orderpriority END AS floor_area
FROM orders""",
    "digits_int": """
SELECT o_orderkey, CASE WHEN o_orderkey % 4 > 1 THEN o_orderkey END AS price,
       CAST(CASE WHEN o_orderkey % 4 = 0 THEN 3 WHEN o_orderkey % 4 > 1 THEN o_orderkey % 9 END
            AS INTEGER) AS bedrooms
FROM orders""",
    "postcode_compose": """
WITH parts AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 'AB1 ' || (o_orderkey % 10) END AS whole,
         CASE WHEN o_orderkey % 3 <> 0 THEN 'XY9' END AS outcode,
         CASE WHEN o_orderkey % 5 <> 0 THEN (o_orderkey % 10) || 'ZZ' END AS incode
  FROM orders
)
SELECT o_orderkey, coalesce(whole, nullif(trim(coalesce(outcode, '') || ' ' || coalesce(incode, '')), '')) AS postcode
FROM parts""",
    "result_total": """
SELECT o_orderkey, CASE WHEN o_orderkey % 6 > 1 THEN CAST(floor(o_totalprice) AS BIGINT) END AS total
FROM orders""",
    "location_list": """
SELECT upper(n_name) AS key, min(CAST(n_nationkey AS BIGINT)) AS position FROM nation GROUP BY upper(n_name)""",
    "location_csv": "SELECT DISTINCT upper(n_name) AS key FROM nation",
    "url_files": f"""
WITH {ATTEMPTS}
SELECT url FROM attempts_src WHERE length(url) % 3 <> 0 GROUP BY url HAVING max(pass_no) = 3 AND NOT bool_or(ok)""",
    "ledger_state": """
SELECT 'docs' AS source, CAST(doc_id AS VARCHAR) AS key,
       CASE WHEN quality = 1 THEN 'completed' ELSE 'failed' END AS status, 'r0' AS run_id
FROM labels""",
    "location_ids": "SELECT n_nationkey AS outer_code, 'OUTCODE^' || n_nationkey AS location_id FROM nation",
    "search_urls": f"""
SELECT n_nationkey AS outer_code, CAST(p AS INTEGER) AS page_idx,
       '{SALE_SEARCH_URL}?locationIdentifier=OUTCODE^' || n_nationkey
         || '&sortType=1&useLocationIdentifier=true&index=' || (p * 24) AS sale_url,
       '{SALE_SEARCH_URL}?locationIdentifier=OUTCODE^' || n_nationkey
         || '&sortType=1&index=' || (p * 24) AS sale_url_dated,
       '{ROOM_SEARCH_URL}?action=search&flatshare_type=offered&search='
         || upper(n_name) || '&max_per_page=50&offset=' || (p * 50) AS room_url
FROM nation, range(50) AS t(p)""",
    "card_fields": """
WITH items AS (
  SELECT page_id, regexp_extract_all(html, '<li><a href="([^"]*)">[^<]*</a></li>', 1) AS h,
         regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a></li>', 1) AS t
  FROM pages
), card AS (
  SELECT page_id, unnest(h) AS href, unnest(t) AS title, unnest(range(len(h))) AS pos FROM items
)
SELECT page_id, CAST(pos AS INTEGER) AS pos,
       CASE WHEN starts_with(href, 'http') THEN href ELSE 'https://example.test' || href END AS url,
       trim(title) AS title, CAST(NULL AS VARCHAR) AS strong
FROM card""",
    "room_cards": f"""
SELECT 'R' || (user_id % 40) AS postcode, 0 AS page_idx, ts AS fetched_at, 0 AS pos,
       '{ROOM_DOMAIN}/flatshare/detail.pl?flatshare_id=' || event_id || '&search=x' AS url,
       CAST(event_id AS VARCHAR) AS flatshare_id, 'Room & bath ' || event_id AS title,
       CASE WHEN event_id % 13 <> 0 THEN '£' || CAST(floor(value) AS BIGINT) || ' pcm' END AS price_text,
       event_type || 'area' AS location, 'Doubleroom' AS room_type, CAST(NULL AS VARCHAR) AS available,
       '{ROOM_SOURCE}' AS source
FROM events""",
    "links_regex": """
SELECT DISTINCT page_id, 'https://example.test' || unnest(regexp_extract_all(html, '/[A-Za-z]+')) AS url
FROM pages""",
    "links_anchor": f"WITH {HREFS} SELECT page_id, url FROM links",
    "distinct_urls": f"""
WITH {HREFS} SELECT url FROM links UNION SELECT 'https://example.test/' || page_id FROM pages""",
    "urls_per_key": f"WITH {HREFS} SELECT page_id, count(*) AS n_urls FROM links GROUP BY page_id",
    "page_model_regex": f"""
WITH {SALE}, {DETAIL}
SELECT listing_no, CASE WHEN has_model THEN address END AS address,
       CASE WHEN has_model THEN postcode END AS postcode,
       CASE WHEN has_model THEN any_price END AS price,
       CASE WHEN has_model THEN bedrooms END AS bedrooms,
       CASE WHEN has_model THEN property_type END AS property_type,
       CASE WHEN has_model THEN floor_area END AS floor_area
FROM model_src""",
    "page_model_variant": f"""
WITH {SALE}, {DETAIL}
SELECT listing_no, CASE WHEN has_model THEN address END AS address,
       CASE WHEN has_model THEN postcode END AS postcode,
       CASE WHEN has_model THEN any_price END AS price,
       CASE WHEN has_model THEN bedrooms END AS bedrooms,
       CASE WHEN has_model THEN property_type END AS property_type,
       CASE WHEN has_model THEN floor_area END AS floor_area
FROM model_src""",
    "model_paths": f"""
WITH {SALE}, {DETAIL}
SELECT listing_no, CASE WHEN has_model THEN split_part(postcode, ' ', 1) END AS outcode,
       CASE WHEN has_model THEN floor_area END AS second_size, CAST(NULL AS VARCHAR) AS no_leaf,
       CAST(NULL AS VARCHAR) AS below_a_leaf, CAST(NULL AS INTEGER) AS mistyped,
       CASE WHEN has_model THEN bedrooms END AS bedrooms,
       CASE WHEN has_model THEN CAST(any_price AS DOUBLE) END AS price
FROM model_src""",
    "page_model_balanced": f"""
WITH {SALE}, {DETAIL}
SELECT listing_no, CASE WHEN has_model THEN address END AS address,
       CASE WHEN has_model THEN postcode END AS postcode,
       CASE WHEN has_model THEN price END AS price,
       CASE WHEN has_model THEN bedrooms END AS bedrooms,
       CASE WHEN has_model THEN property_type END AS property_type,
       CASE WHEN has_model THEN floor_area END AS floor_area
FROM model_src""",
    "detail_rows": f"""
WITH {SALE}, {DETAIL}, flagged AS (SELECT *, has_model AND fetched AS ok FROM model_src)
SELECT url, CASE WHEN ok THEN address END AS address, CASE WHEN ok THEN postcode END AS postcode,
       CASE WHEN ok THEN price END AS price, CASE WHEN ok THEN bedrooms END AS bedrooms,
       CASE WHEN ok THEN property_type END AS property_type,
       CASE WHEN ok THEN floor_area END AS floor_area,
       CASE WHEN fetched THEN 200 ELSE 503 END AS status, scraped_at
FROM flagged""",
    "pages_ok": """
SELECT page_id, CASE page_id % 5 WHEN 0 THEN 404 WHEN 1 THEN 0 ELSE 200 END AS http_status,
       page_id % 5 > 1 AS has_html,
       CASE WHEN page_id % 5 > 1 THEN CAST(length(html) AS INTEGER) END AS n_chars
FROM pages""",
    "page_plan": """
WITH totals AS (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY c_nationkey), plan AS (
  SELECT c_nationkey, CASE WHEN c_nationkey % 5 <= 1 THEN 30
                           ELSE greatest(1, CAST(ceil(n / 50) AS INTEGER)) END AS n_pages
  FROM totals
)
SELECT c_nationkey, CAST(p AS INTEGER) AS page_idx, CAST(p * 50 AS INTEGER) AS "offset"
FROM (SELECT c_nationkey, unnest(range(n_pages)) AS p FROM plan)""",
    "page_truncate": f"""
WITH {PAGING}, stops AS (
  SELECT o_custkey, min(page_idx) FILTER (WHERE n_items < 5) AS stop_idx FROM paging_src GROUP BY o_custkey
)
SELECT o_custkey, page_idx, n_items FROM paging_src JOIN stops USING (o_custkey)
WHERE n_items > 0 AND (stop_idx IS NULL OR page_idx <= stop_idx)""",
    "page_truncate_sales": f"""
WITH {PAGING}, src AS (
  SELECT *, CASE WHEN http_status = 200 THEN n_items ELSE 0 END AS n FROM paging_src
), stops AS (
  SELECT o_custkey,
         min(page_idx) FILTER (WHERE n < 5 AND (page_idx > 0 OR n > 0)) AS stop_idx
  FROM src GROUP BY o_custkey
)
SELECT o_custkey, page_idx, n_items FROM src JOIN stops USING (o_custkey)
WHERE n > 0 AND (stop_idx IS NULL OR page_idx <= stop_idx)""",
    "status_tag": f"""
WITH {PAGING}, last AS (
  SELECT o_custkey, arg_max(http_status, page_idx) AS status FROM paging_src WHERE http_status <> 0
  GROUP BY o_custkey
)
SELECT o_custkey, page_idx, first_order, coalesce(status, 200) AS status
FROM paging_src LEFT JOIN last USING (o_custkey)""",
    "room_run": f"""
WITH {SERIES}
SELECT '{ROOM_SOURCE}' AS source, CAST(user_id AS VARCHAR) AS postcode, 'Room ' || event_id AS title,
       '{ROOM_DOMAIN}/flatshare/detail.pl?flatshare_id=' || (event_id % 6) || '&search='
         || (CAST(floor(event_id / 6) AS BIGINT) % 2) AS url,
       CASE WHEN event_id % 13 <> 0 THEN '£' || CAST(floor(value) AS BIGINT) || ' pcm' ELSE '' END AS price_text,
       event_type AS location, '' AS room_type, '' AS available, fetched_at AS scraped_at,
       CAST(status AS INTEGER) AS status
FROM series_rows JOIN series_last USING (user_id)""",
    "room_events": f"""
WITH {SERIES}
SELECT '{ROOM_SOURCE}' AS source, CAST(user_id AS VARCHAR) AS key, status, 'r1' AS run_id,
       TIMESTAMP '2024-05-01 00:00:00' AS updated_at
FROM series_events""",
    "room_summary": f"""
WITH {SERIES}
SELECT (SELECT count(*) FROM series_events) AS processed, (SELECT count(*) FROM series_urls) AS total_rows,
       (SELECT count(*) FROM series_urls) - (SELECT count(*) FROM series_rows) AS dropped,
       (SELECT count(*) FROM series_events WHERE status = 'failed') AS failed""",
    "room_stream": f"""
WITH {SERIES}
SELECT CAST(user_id AS VARCHAR) AS postcode, e.status AS outcome, title, url, CAST(r.status AS INTEGER) AS status
FROM series_events e LEFT JOIN (
  SELECT user_id, 'Room ' || event_id AS title, series_last.status,
         '{ROOM_DOMAIN}/flatshare/detail.pl?flatshare_id=' || (event_id % 6) || '&search='
           || (CAST(floor(event_id / 6) AS BIGINT) % 2) AS url
  FROM series_rows JOIN series_last USING (user_id)
) r USING (user_id)""",
    "sale_links_run": f"""
WITH {HREFS}, counted AS (
  SELECT page_id, page_id % 20 AS key, CAST(floor(page_id / 20) AS INTEGER) AS page_idx,
         (SELECT count(*) FROM links WHERE links.page_id = pages.page_id) AS n
  FROM pages
), stops AS (
  SELECT key, min(page_idx) FILTER (WHERE n < 5 AND (page_idx > 0 OR n > 0)) AS stop_idx FROM counted GROUP BY key
)
SELECT key, url FROM counted JOIN stops USING (key) JOIN links USING (page_id)
WHERE stop_idx IS NULL OR page_idx <= stop_idx""",
    "sale_collection": f"""
WITH {HREFS}, sale_counted AS (
  SELECT page_id, page_id % 20 AS key, CAST(floor(page_id / 20) AS INTEGER) AS page_idx,
         (SELECT count(*) FROM links WHERE links.page_id = pages.page_id) AS n
  FROM pages
), sale_stops AS (
  SELECT key, min(page_idx) FILTER (WHERE n < 5 AND (page_idx > 0 OR n > 0)) AS stop_idx FROM sale_counted GROUP BY key
), sale_found AS (
  SELECT key, url FROM sale_counted JOIN sale_stops USING (key) JOIN links USING (page_id)
  WHERE stop_idx IS NULL OR page_idx <= stop_idx
)
SELECT url, CASE WHEN min(key) < 10 THEN 'r1' ELSE 'r2' END AS run_id FROM sale_found GROUP BY url""",
    "sale_collection_events": f"""
SELECT DISTINCT '{SALE_VIEW}' AS source, CAST(page_id % 20 AS VARCHAR) AS key, 'completed' AS status,
       CASE WHEN page_id % 20 < 10 THEN 'r1' ELSE 'r2' END AS run_id
FROM pages""",
    "sale_retry_run": f"""
WITH {SALE}, {DETAIL}, tried AS (SELECT *, has_model AND listing_no % 76 <> 0 AS ok FROM model_src)
SELECT url, CASE WHEN ok THEN address ELSE '' END AS address, CASE WHEN ok THEN postcode ELSE '' END AS postcode,
       CASE WHEN ok THEN price END AS price, CASE WHEN ok THEN bedrooms END AS bedrooms,
       CASE WHEN ok THEN property_type ELSE '' END AS property_type,
       CASE WHEN ok THEN coalesce(floor_area, '') ELSE '' END AS floor_area,
       CASE WHEN listing_no % 76 <> 0 THEN '200' ELSE '503' END AS status, scraped_at
FROM tried""",
    "sale_retry_failures": f"WITH {SALE} SELECT url FROM sale_src WHERE listing_no % 76 = 0",
    "dedup_listing": """
SELECT * FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity,
  l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) = 1""",
    "dedup_counts": """
WITH k AS (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)
SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_kept, CAST(sum(n - 1) AS BIGINT) AS n_dropped FROM k""",
    "dedup_url": """
SELECT *, strftime(o_orderdate, '%Y-%m') AS url FROM orders WHERE o_orderkey % 8 <> 0
QUALIFY row_number() OVER (PARTITION BY o_custkey, strftime(o_orderdate, '%Y-%m') ORDER BY o_orderkey) = 1""",
    "remaining_work": """
SELECT CAST(doc_id AS VARCHAR) AS key, doc_id AS position FROM documents
WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
    "work_limit": """
SELECT CAST(doc_id AS VARCHAR) AS key, doc_id AS position
FROM (SELECT doc_id FROM documents ORDER BY doc_id LIMIT 200)
WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
    "ledger_read": f"WITH {LEDGER} SELECT * FROM ledger_events",
    "ledger_update": f"WITH {LEDGER} SELECT source, key, status, run_id, updated_at FROM ledger_now",
    "ledger_completed": f"""
WITH {LEDGER} SELECT DISTINCT source, key FROM ledger_events WHERE status = 'completed'
ORDER BY source, key""",
    "retry_mode": f"WITH {LEDGER} SELECT key FROM ledger_now WHERE status = 'failed' AND source = 'docs'",
    "work_list_plain": f"""
WITH {LEDGER} SELECT CAST(doc_id AS VARCHAR) AS key FROM documents
WHERE CAST(doc_id AS VARCHAR) NOT IN (SELECT key FROM ledger_events WHERE status = 'completed' AND source = 'docs')""",
    "room_outcomes": f"""
WITH {PAGING}, src AS (
  SELECT *, http_status = 200 AS has_html, CASE WHEN http_status = 200 THEN n_items ELSE 0 END AS n
  FROM paging_src
), stops AS (
  SELECT o_custkey, min(page_idx) FILTER (WHERE n < 5 AND (page_idx = 0 OR has_html)) AS stop_idx
  FROM src GROUP BY o_custkey
), seen AS (
  SELECT src.* FROM src JOIN stops USING (o_custkey) WHERE stop_idx IS NULL OR page_idx <= stop_idx
), last AS (
  SELECT o_custkey, coalesce(arg_max(http_status, page_idx) FILTER (WHERE http_status <> 0), 200) AS status,
         coalesce(bool_or(page_idx = 0 AND has_html), false) AS first_html
  FROM seen GROUP BY o_custkey
)
SELECT o_custkey, CASE WHEN first_html AND status = 200 THEN 'completed' ELSE 'failed' END AS status FROM last""",
    "retry_set": f"""
WITH {ATTEMPTS}
SELECT url, pass_no AS after_pass FROM attempts_src WHERE pass_no <= 2
GROUP BY url, pass_no HAVING NOT bool_or(ok)""",
    "final_failures": f"""
WITH {ATTEMPTS}
SELECT url FROM attempts_src GROUP BY url HAVING max(pass_no) = 3 AND NOT bool_or(ok)""",
    "resolve_attempts": f"""
WITH {ATTEMPTS}
SELECT url, pass_no, http_status, ts, event_id, value FROM attempts_src
QUALIFY row_number() OVER (PARTITION BY url ORDER BY ok DESC, pass_no DESC) = 1""",
    "failure_classes": f"""
WITH {ATTEMPTS}
SELECT pass_no, CASE http_status WHEN '200' THEN 'ok' WHEN '429' THEN 'throttled'
                                 WHEN '404' THEN 'http_error' ELSE 'network' END AS failure_class,
       count(*) AS attempts
FROM attempts_src GROUP BY ALL""",
    "run_summary": f"""
WITH {ATTEMPTS}, k AS (
  SELECT url, count(*) AS n, max(pass_no) AS last_pass, bool_or(ok) AS ok FROM attempts_src GROUP BY url
)
SELECT count(*) AS processed, CAST(sum(n) AS BIGINT) AS total_rows, CAST(sum(n - 1) AS BIGINT) AS dropped,
       count(*) FILTER (WHERE NOT ok AND last_pass = 3) AS failed
FROM k""",
    "url_list": f"""
WITH {ATTEMPTS}
SELECT url FROM attempts_src GROUP BY url HAVING max(pass_no) = 3 AND NOT bool_or(ok)
UNION SELECT event_type FROM events WHERE event_id % 3 <> 0""",
    "rolling_latency": f"WITH {FETCH} SELECT event_id, mean_latency FROM counted",
    "error_rate": f"""
WITH {FETCH} SELECT event_id, done, errors, errors / done AS error_rate FROM counted""",
    "progress_eta": _progress(300, "NULL", "7200.0"),
    "progress_eta_urls": _progress(10, "99999.0", "7200.0"),
    "progress_eta_rooms": _progress(6, "0.0", None, whole=True),
    "load_signal": f"""
WITH {FETCH}
SELECT event_id, done,
       CASE WHEN done < 500 THEN 'warmup'
            WHEN mean_latency < 0.18 AND errors / done < 0.01 THEN 'raise'
            WHEN mean_latency > 0.30 OR errors / done > 0.015 THEN 'lower'
            ELSE 'hold' END AS signal
FROM counted""",
    "work_chunks": "SELECT o_orderkey, CAST(o_orderkey % 8 AS INTEGER) AS chunk FROM orders",
    "shard_sink": f"""
WITH {SALE} SELECT count(*) AS n_rows, CAST(sum(listing_no) AS BIGINT) AS sum_no, CAST(0 AS BIGINT) AS over_limit
FROM sale_src""",
    "snapshot_sink": f"""
WITH {SALE}, runs AS (
  SELECT 'full' AS run_id, * FROM sale_src UNION ALL SELECT 'retry', * FROM sale_src WHERE price IS NULL
)
SELECT strftime(date_trunc('year', scraped_at), '%Y-%m-%d') AS snapshot_date, run_id,
       count(*) AS n_rows, CAST(sum(listing_no) AS BIGINT) AS sum_no
FROM runs GROUP BY ALL""",
    "stream_shards": """
SELECT event_type, count(*) AS n_rows, CAST(sum(event_id) AS BIGINT) AS sum_id FROM events GROUP BY event_type""",
    "stream_dedup": """
SELECT event_type, user_id, event_id FROM events
QUALIFY row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts, event_id) = 1""",
    "stream_dedup_state": "SELECT DISTINCT event_type, user_id FROM events",
    "stream_resume": """
SELECT o_orderstatus, count(*) AS n_rows, count(DISTINCT o_orderkey) AS n_keys, count(*) AS n_logged
FROM orders GROUP BY o_orderstatus""",
}
