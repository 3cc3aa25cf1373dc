"""DuckDB SQL for every named query, written independently of the Spark operators."""

from __future__ import annotations

_UVA = """
k_events AS (
    SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
uva AS (
    SELECT strftime(ts, '%Y-%m-%d') AS date,
           user_id,
           user_id || '-' || strftime(ts, '%Y-%m-%d') AS session_id,
           k % 8 + 1 AS page_id,
           strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS action_time,
           'null' AS search_keyword,
           CASE WHEN event_type = 'click' THEN k % 20 ELSE -1 END AS click_category_id,
           CASE WHEN event_type = 'click' THEN event_id % (SELECT count(*) FROM part) ELSE -1 END AS click_product_id,
           CASE WHEN event_type = 'purchase' OR (event_type = 'click' AND k % 10 = 0)
                THEN (k % 20) || ',' || ((k + 7) % 20) ELSE 'null' END AS order_category_ids,
           CASE WHEN event_type = 'purchase' OR (event_type = 'click' AND k % 10 = 0)
                THEN (event_id % (SELECT count(*) FROM part)) || ',' || ((event_id + 7) % (SELECT count(*) FROM part)) ELSE 'null' END AS order_product_ids,
           CASE WHEN event_type = 'signup'
                THEN (k % 18) || ',' || ((k + 5) % 18) ELSE 'null' END AS pay_category_ids,
           CASE WHEN event_type = 'signup'
                THEN (event_id % (SELECT count(*) FROM part)) || ',' || ((event_id + 5) % (SELECT count(*) FROM part)) ELSE 'null' END AS pay_product_ids,
           user_id % 25 AS city_id
    FROM k_events)"""

_CITY = """
city_info AS (
    SELECT CAST(n_nationkey AS BIGINT) AS city_id, n_name AS city_name, r_name AS area
    FROM nation JOIN region ON n_regionkey = r_regionkey)"""

_CATEGORY = """
clicks AS (
    SELECT CAST(click_category_id AS VARCHAR) AS categoryId, count(*) AS n
    FROM uva WHERE click_category_id <> -1 GROUP BY 1),
orders AS (
    SELECT categoryId, count(*) AS n
    FROM (SELECT unnest(string_split(order_category_ids, ',')) AS categoryId
          FROM uva WHERE order_category_ids <> 'null') GROUP BY 1),
pays AS (
    SELECT categoryId, count(*) AS n
    FROM (SELECT unnest(string_split(pay_category_ids, ',')) AS categoryId
          FROM uva WHERE pay_category_ids <> 'null') GROUP BY 1),
strict10 AS (
    SELECT c.categoryId, c.n AS clickCount, o.n AS orderCount, p.n AS payCount
    FROM clicks c JOIN orders o USING (categoryId) JOIN pays p USING (categoryId)
    ORDER BY clickCount DESC, orderCount DESC, payCount DESC, categoryId LIMIT 10)"""

_FIRST = """
firsts AS (
    SELECT CAST(click_category_id AS VARCHAR) AS categoryId, 'click' AS action
    FROM uva WHERE click_category_id <> -1
    UNION ALL
    SELECT unnest(string_split(order_category_ids, ',')), 'order'
    FROM uva WHERE click_category_id = -1 AND order_category_ids <> 'null'
    UNION ALL
    SELECT unnest(string_split(pay_category_ids, ',')), 'pay'
    FROM uva WHERE click_category_id = -1 AND order_category_ids = 'null' AND pay_category_ids <> 'null'),
wide AS (
    SELECT categoryId,
           count(*) FILTER (WHERE action = 'click') AS clickCount,
           count(*) FILTER (WHERE action = 'order') AS orderCount,
           count(*) FILTER (WHERE action = 'pay') AS payCount
    FROM firsts GROUP BY categoryId)"""

_SESSIONS = """
session10 AS (
    SELECT categoryId, sessionId, clickCount FROM (
        SELECT *, row_number() OVER (PARTITION BY categoryId ORDER BY clickCount DESC, sessionId) AS rn
        FROM (SELECT CAST(click_category_id AS VARCHAR) AS categoryId, session_id AS sessionId,
                     count(*) AS clickCount
              FROM uva WHERE CAST(click_category_id AS VARCHAR) IN (SELECT categoryId FROM strict10)
              GROUP BY 1, 2)) WHERE rn <= 10),
nested AS (
    SELECT categoryId,
           '[' || string_agg('{"sessionId":"' || sessionId || '","clickCount":' || clickCount || '}', ','
                             ORDER BY clickCount DESC, sessionId) || ']' AS sessions
    FROM session10 GROUP BY categoryId)"""

_PAGES = """
steps AS (
    SELECT page_id, lead(page_id) OVER (PARTITION BY session_id ORDER BY action_time, page_id) AS next_page
    FROM uva),
jumps AS (
    SELECT page_id, page_id || '->' || next_page AS jump, count(*) AS n
    FROM steps WHERE page_id BETWEEN 1 AND 5 AND next_page = page_id + 1 GROUP BY 1, 2),
visits AS (
    SELECT page_id, count(*) AS visits FROM uva WHERE page_id BETWEEN 1 AND 6 GROUP BY 1)"""

_AREA = """
t1 AS (
    SELECT city_id, city_name, area, p_name AS product_name, click_category_id
    FROM uva JOIN part ON click_product_id = p_partkey JOIN city_info USING (city_id))"""


def _remark(by: str) -> str:
    return f"""
mix AS (
    SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY n DESC, city_name) AS rn,
           sum(n) OVER (PARTITION BY {by}) AS total, count(*) OVER (PARTITION BY {by}) AS cities
    FROM (SELECT {by}, city_name, count(*) AS n FROM t1 GROUP BY {by}, city_name)),
shares AS (
    SELECT {by}, CAST(sum(n) AS BIGINT) AS click_count, any_value(cities) AS cities,
           max(city_name) FILTER (WHERE rn = 1) AS c1,
           CAST(max(n) FILTER (WHERE rn = 1) AS DOUBLE) / CAST(any_value(total) AS DOUBLE) AS r1,
           max(city_name) FILTER (WHERE rn = 2) AS c2,
           CAST(max(n) FILTER (WHERE rn = 2) AS DOUBLE) / CAST(any_value(total) AS DOUBLE) AS r2
    FROM mix GROUP BY {by}),
t2 AS (
    SELECT {by}, click_count,
           c1 || ':' || printf('%.2f%%', r1 * 100)
           || CASE WHEN cities >= 2 THEN ',' || c2 || ':' || printf('%.2f%%', r2 * 100) ELSE '' END
           || CASE WHEN cities > 2 THEN ',其它:' || printf('%.2f%%', (1.0::DOUBLE - r1 - r2) * 100) ELSE '' END
           AS city_remark
    FROM shares)"""


_ADS = """
ads AS (
    SELECT ms AS ts, make_timestamp(ms * 1000) AS timestamp,
           strftime(make_timestamp(ms * 1000), '%Y-%m-%d') AS dayString,
           strftime(make_timestamp(ms * 1000), '%H:%M') AS hmString,
           area, city_name AS city, CAST(user_id AS VARCHAR) AS userId, CAST(ad AS VARCHAR) AS adsId
    FROM (SELECT epoch_us(ts) // 1000 AS ms, user_id,
                 CAST(json_extract_string(props, '$.k') AS BIGINT) % 5 + 1 AS ad, user_id % 25 AS city_id
          FROM events WHERE event_type IN ('click', 'view'))
    JOIN city_info USING (city_id)),
counts AS (SELECT dayString, area, adsId, count(*) AS n FROM ads GROUP BY ALL),
top3 AS (
    SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY dayString, area ORDER BY n DESC, adsId) AS rank FROM counts)
    WHERE rank <= 3),
hour_clicks AS (
    SELECT adsId, hmString, min(ts) // 60000 AS minute, count(*) AS n
    FROM ads WHERE ts >= (SELECT (max(ts) // 5000 + 1) * 5000 - 3600000 FROM ads) GROUP BY adsId, hmString),
listed AS (
    SELECT DISTINCT dayString, userId
    FROM (SELECT dayString, userId, adsId FROM ads GROUP BY ALL HAVING count(*) >= 2))"""

# Clicks arrive by quarters of the day; a user is listed at the end of the quarter that reaches 2 clicks on an ad.
_PASSED = """
parted AS (SELECT *, hour(timestamp) // 6 AS quarter FROM ads),
running AS (
    SELECT dayString, userId, quarter,
           sum(n) OVER (PARTITION BY dayString, userId, adsId ORDER BY quarter) AS clicks
    FROM (SELECT dayString, userId, adsId, quarter, count(*) AS n FROM parted GROUP BY ALL)),
since AS (SELECT dayString, userId, min(quarter) AS listed_in FROM running WHERE clicks >= 2 GROUP BY ALL)"""

_RATES = """
        SELECT jump, n, visits, round(CAST(n AS DOUBLE) / visits, 6) AS rate,
               regexp_replace(printf('%.2f%%', CAST(n AS DOUBLE) / visits * 100), '^0', '') AS rate_text
        FROM jumps JOIN visits USING (page_id)"""

_ORDER10 = "ORDER BY clickCount DESC, orderCount DESC, payCount DESC, categoryId LIMIT 10"

_TOP3_JSON = """
SELECT 'area:ads:top3:' || dayString AS key, area AS field,
       '[' || string_agg('{"' || adsId || '":' || n || '}', ',' ORDER BY rank) || ']' AS value
FROM top3 GROUP BY dayString, area"""

_HOUR_JSON = """
SELECT 'last_hour_click' AS key, adsId AS field,
       '[' || string_agg('{"' || hmString || '":' || n || '}', ',' ORDER BY minute) || ']' AS value
FROM hour_clicks GROUP BY adsId"""

_AREA_TOP3 = """
SELECT area, product_name, click_count, city_remark
FROM (SELECT *, rank() OVER (PARTITION BY area ORDER BY click_count DESC) AS rank FROM t2)
WHERE rank <= 3"""


def _with(*parts: str, select: str) -> str:
    return f"WITH {', '.join(parts)}\n{select}"


def _category(select: str) -> str:
    return _with(_UVA, _CATEGORY, select=select)


def _first(select: str) -> str:
    return _with(_UVA, _FIRST, select=select)


def _sessions(select: str) -> str:
    return _with(_UVA, _CATEGORY, _SESSIONS, select=select)


def _pages(select: str) -> str:
    return _with(_UVA, _PAGES, select=select)


def _area(select: str, by: str = "area, product_name") -> str:
    return _with(_UVA, _CITY, _AREA, _remark(by), select=select)


def _ads(select: str) -> str:
    return _with(_CITY, _ADS, select=select)


ORACLES: dict[str, str] = {
    "uva_parse": _with(_UVA, select="SELECT * FROM uva"),
    "category_click_counts": _category("SELECT * FROM clicks"),
    "category_order_counts": _category("SELECT * FROM orders"),
    "category_pay_counts": _category("SELECT * FROM pays"),
    "category_top10_strict": _category("SELECT * FROM strict10"),
    "category_top10_single_pass": _first(
        f"SELECT * FROM wide WHERE clickCount > 0 AND orderCount > 0 AND payCount > 0 {_ORDER10}"
    ),
    "category_top10_lenient": _first(f"SELECT * FROM wide {_ORDER10}"),
    "category_action_counts": _first(
        "SELECT categoryId, action, count(*) AS n FROM firsts GROUP BY categoryId, action"
    ),
    "category_session_top10": _sessions("SELECT * FROM session10"),
    "category_session_top10_nested": _sessions("SELECT * FROM nested"),
    "category_session_top10_ranked": _sessions("""
        SELECT CAST(row_number() OVER (
                   ORDER BY clickCount DESC, orderCount DESC, payCount DESC, categoryId) AS INTEGER)
                   AS category_rank,
               categoryId, coalesce(sessions, '[]') AS sessions
        FROM strict10 LEFT JOIN nested USING (categoryId)"""),
    "page_visit_counts": _pages("SELECT * FROM visits"),
    "page_transition_counts": _pages("SELECT jump, n FROM jumps"),
    "page_conversion_catalog": _with(
        _UVA.replace("FROM events)", "FROM events WHERE CAST(ts AS DATE) BETWEEN '2024-01-03' AND '2024-01-12')"),
        _PAGES,
        select=_RATES,
    ),
    "page_conversion_rate": _pages(_RATES),
    "area_product_clicks": _with(_UVA, _CITY, _AREA, select="SELECT * FROM t1"),
    "area_product_counts": _area("SELECT * FROM t2"),
    "area_product_top3": _area(_AREA_TOP3),
    "area_product_top3_sql": _area(_AREA_TOP3),
    "city_remark": _area("SELECT area, city_remark FROM t2", by="area"),
    "ads_log_parse": _ads("SELECT * FROM ads"),
    "ads_rejected_lines": _ads("""
        SELECT concat_ws(',', ts, area, city, userId) AS value, 'missing field' AS reason
        FROM ads WHERE CAST(userId AS BIGINT) % 10 = 0
        UNION ALL
        SELECT 'at ' || concat_ws(',', ts, area, city, userId, adsId), 'bad time'
        FROM ads WHERE CAST(userId AS BIGINT) % 10 = 1"""),
    "ads_line_counts_stream": _ads("""
        SELECT CASE CAST(userId AS BIGINT) % 10 WHEN 0 THEN 'missing field' WHEN 1 THEN 'bad time' ELSE 'good' END AS what,
               count(*) AS n
        FROM ads GROUP BY ALL"""),
    "ads_daily_area_counts": _ads("SELECT * FROM counts"),
    "ads_area_top3": _ads("SELECT dayString, area, adsId, n, CAST(rank AS INTEGER) AS rank FROM top3"),
    "ads_area_top3_json": _ads(_TOP3_JSON),
    "ads_last_hour_clicks": _ads("SELECT adsId, hmString, n FROM hour_clicks"),
    "ads_last_hour_json": _ads(_HOUR_JSON),
    "ads_blacklist_build": _ads("SELECT * FROM listed"),
    "ads_blacklist_filter": _ads("SELECT * FROM ads ANTI JOIN listed USING (dayString, userId)"),
    "ads_raw_append": _ads("SELECT * FROM ads"),
    "ads_daily_area_counts_stream": _ads("SELECT * FROM counts"),
    "ads_area_top3_stream": _ads("SELECT dayString, area, adsId, n, CAST(rank AS INTEGER) AS rank FROM top3"),
    "ads_area_top3_json_stream": _ads(_TOP3_JSON),
    "ads_last_hour_clicks_stream": _ads("SELECT adsId, hmString, n FROM hour_clicks"),
    "ads_last_hour_json_stream": _ads(_HOUR_JSON),
    # Quarters arrive 25 minutes apart, so the last three are in the hour.
    "ads_last_hour_arrival_stream": _ads("""
        SELECT adsId, date_trunc('minute', timestamp) AS minute, count(*) AS n
        FROM ads WHERE hour(timestamp) >= 6 GROUP BY ALL"""),
    "ads_blacklist_build_stream": _ads("SELECT * FROM listed"),
    "ads_blacklist_loop_stream": _ads("SELECT * FROM listed"),
    "ads_blacklist_passed_stream": _with(
        _CITY,
        _ADS,
        _PASSED,
        select="""
        SELECT p.* EXCLUDE (quarter)
        FROM parted p LEFT JOIN since USING (dayString, userId)
        WHERE listed_in IS NULL OR quarter <= listed_in""",
    ),
}
