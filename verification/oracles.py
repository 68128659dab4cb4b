"""DuckDB SQL for the registered queries, written independently of the operators."""

from __future__ import annotations

from sessionloom.schemas import USER_VISIT_ACTION
from verification.fixtures import VIEWS, with_views
from verification.queries import FILTER as PARAMETERS
from verification.queries import ON_RICH_INPUT, RATIO, TASK_ID

ACTIONS = "user_visit_action"

# Written out, so that a wrong bound in the operator shows.
VISIT_LENGTH_BUCKETS = [
    ("1s_4s", 1_000, 4_000), ("4s_7s", 4_000, 7_000), ("7s_10s", 7_000, 10_000), ("10s_30s", 10_000, 30_000),
    ("30s_60s", 30_000, 60_000), ("1m_3m", 60_000, 180_000), ("3m_10m", 180_000, 600_000),
    ("10m_30m", 600_000, 1_800_000), ("30m", 1_800_000, None),
]
STEP_LENGTH_BUCKETS = [
    ("1_3", 1, 3), ("4_6", 4, 6), ("7_9", 7, 9), ("10_29", 10, 29), ("30_59", 30, 59), ("60", 60, None),
]

FILTER = """
    a.date >= '2024-01-03' AND a.date <= '2024-01-25'
    AND u.sex = 'male' AND u.professional IN ('BUILDING', 'MACHINERY')"""

# A session's part of one hour, and whole sessions.
PARTS = """,
parts AS (
  SELECT session_id, substr(action_time, 1, 10) AS day,
    CAST(substr(action_time, 12, 2) AS INTEGER) AS hour, count(*) AS n,
    epoch_ms(max(CAST(action_time AS TIMESTAMP)))
      - epoch_ms(min(CAST(action_time AS TIMESTAMP))) AS length_ms
  FROM user_visit_action GROUP BY ALL)"""
LENGTHS = """,
lengths AS (
  SELECT session_id, count(*) AS steps,
    epoch_ms(max(CAST(action_time AS TIMESTAMP)))
      - epoch_ms(min(CAST(action_time AS TIMESTAMP))) AS length_ms
  FROM user_visit_action GROUP BY session_id)"""
LEVEL = """CASE WHEN length_ms < 5000 THEN 'A' WHEN length_ms < 11000 THEN 'B'
    WHEN length_ms < 31000 THEN 'C' WHEN length_ms < 60000 THEN 'D'
    WHEN length_ms < 180000 THEN 'E' WHEN length_ms < 360000 THEN 'F' ELSE 'G' END"""


def _sample(ratio: float, kind: str = "bernoulli", seed: int = 42, name: str = "sample") -> str:
    n = "CAST(n AS DOUBLE)"
    if kind == "poisson":
        chance = f"1 - exp(-CAST({ratio} AS DOUBLE) * {n})"
    else:
        chance = f"1 - pow(CAST(1 AS DOUBLE) - CAST({ratio} AS DOUBLE), {n})"
    hashed = f"md5(concat('{seed}|', day, '|', hour, '|', session_id))"
    return f""",
{name} AS (
  SELECT day, hour, session_id, n FROM (
    SELECT *, count(*) OVER (PARTITION BY day, hour) AS sessions,
      row_number() OVER (PARTITION BY day, hour ORDER BY priority, session_id) AS rank
    FROM (SELECT *, CAST(('0x' || substr({hashed}, 1, 8)) AS BIGINT)
                    / CAST(4294967296 AS DOUBLE) / ({chance}) AS priority FROM parts))
  WHERE priority < 1
     OR rank <= least(greatest(3, floor(sessions * CAST({ratio} AS DOUBLE))), 50))"""


TOP_SAMPLE = """,
top_sample AS (
  SELECT day, hour, session_id, n FROM sample
  QUALIFY row_number() OVER (PARTITION BY day, hour ORDER BY n DESC, session_id) <= 5)"""
TIMED = """,
timed AS (
  SELECT *, substr(action_time, 1, 10) AS day,
    CAST(substr(action_time, 12, 2) AS INTEGER) AS hour FROM user_visit_action)"""

EVENTS = """,
ops AS (
  SELECT session_id, click_category_id AS category_id, 0 AS flag
  FROM user_visit_action WHERE trim(click_category_id) <> ''
  UNION ALL
  SELECT session_id, unnest(list_filter(string_split(order_category_ids, '|'), lambda i: trim(i) <> '')), 1
  FROM user_visit_action
  WHERE trim(click_category_id) = '' AND trim(order_category_ids) <> ''
  UNION ALL
  SELECT session_id, unnest(list_filter(string_split(pay_category_ids, '|'), lambda i: trim(i) <> '')), 2
  FROM user_visit_action
  WHERE trim(click_category_id) = '' AND trim(order_category_ids) = ''
    AND trim(pay_category_ids) <> ''),
counts AS (
  SELECT category_id, flag, count(*) AS op_count FROM ops GROUP BY ALL),
top_per_op AS (
  SELECT * FROM counts
  QUALIFY row_number() OVER (PARTITION BY flag ORDER BY op_count DESC, category_id) <= 10)"""
PIVOT = """
SELECT category_id,
  CAST(coalesce(sum(op_count) FILTER (flag = 0), 0) AS BIGINT) AS click_count,
  CAST(coalesce(sum(op_count) FILTER (flag = 1), 0) AS BIGINT) AS order_count,
  CAST(coalesce(sum(op_count) FILTER (flag = 2), 0) AS BIGINT) AS pay_count"""
SESSION_COUNTS = EVENTS + """,
session_counts AS (
  SELECT category_id, flag, session_id, count(*) AS op_count FROM ops
  WHERE category_id IN (SELECT category_id FROM top_per_op) GROUP BY ALL),
top_sessions AS (
  SELECT * FROM session_counts
  QUALIFY row_number() OVER (
    PARTITION BY category_id, flag ORDER BY op_count DESC, session_id) <= 10)"""

CLICKS = """,
clicks AS (
  SELECT click_product_id, city_id FROM user_visit_action
  WHERE trim(click_product_id) <> '' AND lower(trim(click_product_id)) <> 'null')"""
FILTERED_CLICKS = f""",
clicks AS (
  SELECT a.click_product_id, a.city_id
  FROM user_visit_action a JOIN user_info u ON a.user_id = u.user_id
  WHERE trim(click_product_id) <> '' AND lower(trim(click_product_id)) <> 'null' AND {FILTER})"""
AREA_CLICKS = """,
area_clicks AS (
  SELECT area, click_product_id, CAST(sum(c) AS BIGINT) AS click_count,
    string_agg(concat(city_id, ':', city_name, ':', c), ',' ORDER BY city_id, city_name)
      AS city_infos
  FROM (SELECT area, click_product_id, k.city_id, city_name, count(*) AS c
        FROM clicks k JOIN city_info i ON k.city_id = i.city_id GROUP BY ALL)
  GROUP BY area, click_product_id)"""
AREA_TOP = AREA_CLICKS + """
SELECT CASE WHEN area IN ('AFRICA', 'AMERICA') THEN 'A'
    WHEN area IN ('ASIA', 'EUROPE') THEN 'B'
    WHEN area = 'MIDDLE EAST' THEN 'C' ELSE 'D' END AS area_level,
  click_product_id AS product_id, area, click_count, city_infos, product_name,
  CASE json_extract_string(extend_info, '$.product_type')
    WHEN '1' THEN '第三方商品' WHEN '0' THEN '自营商品' ELSE '未知商品' END AS product_type
FROM (SELECT * FROM area_clicks
      QUALIFY row_number() OVER (
        PARTITION BY area ORDER BY click_count DESC, click_product_id) <= 10) t
JOIN product_info p ON TRY_CAST(t.click_product_id AS BIGINT) = p.product_id"""

ALL_COLUMNS = ", ".join(USER_VISIT_ACTION.fieldNames())


def _record(prefix: str = "") -> str:
    """JSON text of an action; no test value needs escaping."""
    items = []
    for i, field in enumerate(USER_VISIT_ACTION):
        comma = "," if i else ""
        quote = '"' if field.dataType.simpleString() == "string" else ""
        items.append(f"'{comma}\"{field.name}\":{quote}', {prefix}{field.name}")
        if quote:
            items.append(f"'{quote}'")
    return "concat('{', " + ", ".join(items) + ", '}')"


# Within a second, records are ordered by page and then by the remaining columns in turn.
RECORD_ORDER = ", ".join(
    ["action_time", "page_id"]
    + [c for c in USER_VISIT_ACTION.fieldNames() if c not in ("action_time", "page_id")]
)


def _half_up(share: str) -> str:
    """Shares are exact fractions here, so the midpoint is decided in whole numbers."""
    return (
        f"CAST((200 * count(*) FILTER ({share}) + count(*)) // (2 * count(*)) AS DOUBLE) / 100"
    )


def _ratios() -> str:
    items = []
    for name, low, high in VISIT_LENGTH_BUCKETS:
        inside = f"length_ms >= {low}" + (f" AND length_ms < {high}" if high else "")
        items.append(f"{_half_up(inside)} AS visit_length_{name}_ratio")
    for name, low, high in STEP_LENGTH_BUCKETS:
        inside = f"steps >= {low}" + (f" AND steps <= {high}" if high else "")
        items.append(f"{_half_up(inside)} AS step_length_{name}_ratio")
    return ",\n  ".join(items)


def _json_list(items: str, source: str, order: str, where: str = "TRUE") -> str:
    return (
        f"(SELECT '[' || coalesce(string_agg(concat({items}), ',' ORDER BY {order}), '') || ']'"
        f" FROM {source} WHERE {where})"
    )


STATISTICS = f""",
levels AS (SELECT {LEVEL} AS level, count(*) AS c FROM lengths GROUP BY ALL),
hours AS (
  SELECT day, hour, count(*) AS c, CAST(sum(length_ms) // 1000 AS BIGINT) AS seconds,
    count(*) FILTER (length_ms < 1000) AS invalid FROM parts GROUP BY day, hour)
SELECT CAST({TASK_ID} AS BIGINT) AS task_id, concat(
  '{{"total_session_count":', (SELECT count(*) FROM lengths),
  ',"total_session_length":"', (SELECT CAST(sum(length_ms) // 1000 AS BIGINT) FROM lengths),
  '","invalid_session_count":', (SELECT count(*) FROM lengths WHERE length_ms < 1000),
  ',"pre_session_type_of_count":',
  {_json_list("'{\"type\":\"', level, '\",\"count\":', c, '}'", "levels", "level")},
  ',"pre_hour_of_session_count":',
  {_json_list("'{\"day\":\"', day, '\",\"hour\":', hour, ',\"count\":', c, '}'",
              "hours", "day, hour")},
  ',"pre_hour_of_session_length":',
  {_json_list("'{\"day\":\"', day, '\",\"hour\":', hour, ',\"length\":', seconds, '}'",
              "hours", "day, hour")},
  ',"pre_hour_of_invalid_session_count":',
  {_json_list("'{\"day\":\"', day, '\",\"hour\":', hour, ',\"invalid\":', invalid, '}'",
              "hours", "day, hour", "invalid > 0")},
  '}}') AS result_json"""


def _category_listing(flag: int, name: str) -> str:
    item = "concat('{\"sessionid\":\"', session_id, '\",\"count\":', op_count, '}')"
    return (
        f"coalesce('[' || string_agg({item}, ',' ORDER BY op_count, session_id)"
        f" FILTER (flag = {flag}) || ']', '') AS {name}_sessions"
    )


PRODUCT_SESSIONS = """,
counted AS (
  SELECT click_product_id, session_id AS value, count(*) AS n
  FROM user_visit_action WHERE click_product_id <> '' GROUP BY ALL)"""

AD_CLICKS = """,
ad_click AS (
  SELECT make_timestamp(CAST(p[1] AS BIGINT) * 1000) AS ts, p[2] AS province, p[3] AS city,
    CAST(p[4] AS BIGINT) AS user_id, CAST(p[5] AS BIGINT) AS ad_id
  FROM (SELECT string_split(value, ' ') AS p FROM ad_message))"""
AD_COUNTS = """
SELECT date_trunc('minute', ts) AS window_start,
  date_trunc('minute', ts) + INTERVAL 1 MINUTE AS window_end,
  province, city, ad_id, count(*) AS click_count
FROM ad_click GROUP BY ALL"""

SCALARS = f"""
SELECT session_id, epoch_ms(ts) AS millis, action_time AS time_text,
  substr(action_time, 1, 10) AS day_text,
  CAST(year(ts) AS INTEGER) AS time_year, CAST(month(ts) AS INTEGER) AS time_month,
  CAST(day(ts) AS INTEGER) AS time_day, CAST(hour(ts) AS INTEGER) AS time_hour,
  CAST(minute(ts) AS INTEGER) AS time_minute, CAST(second(ts) AS INTEGER) AS time_second,
  CAST(5 AS INTEGER) AS time_millisecond,
  search_keyword = '' AS no_search, click_product_id <> '' AS is_click,
  replace(order_product_ids, '|', '+') AS ordered,
  concat(city_id, ':', search_keyword) AS id_name,
  CASE page_id % 3 WHEN 1 THEN '第三方商品' WHEN 0 THEN '自营商品' ELSE '未知商品' END
    AS product_type,
  CASE page_id % 3 WHEN 1 THEN 'A' ELSE 'D' END AS area_level,
  {LEVEL.replace('length_ms', 'page_id * 4000')} AS level,
  regexp_replace(printf('%.3f', CAST(page_id AS DOUBLE) / 8), '[.]?0+$', '') AS plain,
  round(CAST(page_id AS DOUBLE) / 7, 2) AS rounded,
  {_record()} AS record,
  ts < CAST(date || ' 12:00:00' AS TIMESTAMP) AS before_noon,
  ts > CAST(date || ' 12:00:00' AS TIMESTAMP) AS after_noon,
  CAST(date_diff('second', CAST(date || ' 12:00:00' AS TIMESTAMP), ts) AS INTEGER)
    AS since_noon,
  strftime(ts, '%Y-%m-%d_%H') AS hour_key, strftime(ts, '%Y%m%d%H%M') AS minute_key,
  search_keyword AS trimmed,
  CASE WHEN page_id BETWEEN 10 AND 99 THEN CAST(page_id AS VARCHAR)
       ELSE concat('0', page_id) END AS padded,
  CAST(user_id AS VARCHAR) AS field_b, CAST(NULL AS VARCHAR) AS field_c,
  concat('a=z|b=', user_id, '|c=') AS field_set
FROM (SELECT *, CAST(action_time AS TIMESTAMP) AS ts FROM user_visit_action)"""


def all_oracles() -> dict[str, str]:
    plain = _oracles()
    rich = {f"{name}_rich": plain[name].replace(VIEWS[ACTIONS], VIEWS["rich_action"]) for name in ON_RICH_INPUT}
    levels = rich["area_top10_products_rich"].replace("IN ('ASIA', 'EUROPE') THEN 'B'", "= 'ASIA' THEN 'B'")
    return plain | rich | {"area_levels_rich": levels.replace("area = 'MIDDLE EAST'", "area = 'EUROPE'")}


def _oracles() -> dict[str, str]:
    actions = ACTIONS
    task = f"CAST({TASK_ID} AS BIGINT) AS task_id"
    products = (actions, "city_info", "product_info")
    return {
        "scan_user_info": with_views("SELECT * FROM user_info", "user_info"),
        "scan_user_visit_action": with_views("SELECT * FROM user_visit_action", actions),
        "scan_product_info": with_views("SELECT * FROM product_info", "product_info"),
        "export_roundtrip": with_views(
            f"SELECT concat_ws(',', {ALL_COLUMNS}) AS value FROM user_visit_action", actions
        ),
        "sql_functions": with_views(
            """SELECT session_id, concat(c.city_id, ':', city_name) AS city,
                 click_product_id <> '' AS is_click,
                 CASE page_id % 3 WHEN 1 THEN '第三方商品' WHEN 0 THEN '自营商品'
                   ELSE '未知商品' END AS product_type
               FROM user_visit_action a JOIN city_info c ON a.city_id = c.city_id""",
            actions,
            "city_info",
        ),
        "scan_city_info_jdbc": with_views("SELECT * FROM city_info", "city_info"),
        "task_lookup": with_views(f"SELECT * FROM tb_task WHERE task_id = {TASK_ID}", "tb_task"),
        "sink_top10_category_jdbc": with_views(
            EVENTS + PIVOT + f", {task} FROM top_per_op GROUP BY category_id", actions
        ),
        "sink_sample_session_jdbc": with_views(
            PARTS + _sample(RATIO) + TOP_SAMPLE + TIMED + f"""
            SELECT {task}, session_id, day, hour, CAST(0 AS BIGINT) AS part,
              '[' || string_agg({_record()}, ',' ORDER BY {RECORD_ORDER}) || ']' AS record
            FROM timed JOIN top_sample USING (session_id, day, hour)
            GROUP BY session_id, day, hour""",
            actions,
        ),
        "sample_session_json": with_views(
            PARTS + _sample(RATIO) + TIMED + f"""
            SELECT concat('{{"session_id":"', session_id, '","day":"', day, '","hour":', hour,
              ',"record":', {_record()}, '}}') AS value
            FROM timed SEMI JOIN sample USING (session_id, day, hour)""",
            actions,
        ),
        "top_session_records_json": with_views(
            SESSION_COUNTS + f"""
            SELECT {_record()} AS value FROM user_visit_action
            WHERE session_id IN (SELECT session_id FROM top_sessions)""",
            actions,
        ),
        "filter_actions": with_views(
            f"""SELECT a.* FROM user_visit_action a JOIN user_info u ON a.user_id = u.user_id
                WHERE {FILTER}""",
            actions,
            "user_info",
        ),
        "filter_actions_by_date": with_views(
            """SELECT * FROM user_visit_action
               WHERE date >= '2024-01-03' AND date <= '2024-01-25'""",
            actions,
        ),
        "filter_actions_extended": with_views(
            """SELECT a.* FROM user_visit_action a JOIN user_info u ON a.user_id = u.user_id
               WHERE a.date >= '2024-01-02' AND u.age BETWEEN 20 AND 50
                 AND u.city IN ('NATION_1', 'NATION_2', 'NATION_3', 'NATION_5', 'NATION_8',
                                'NATION_13')
                 AND a.search_keyword IN ('kw_1', 'kw_2', 'kw_3', 'kw_4')""",
            actions,
            "user_info",
        ),
        "filter_clicks": with_views(
            FILTERED_CLICKS + " SELECT * FROM clicks", actions, "user_info"
        ),
        "filter_clicks_extended": with_views(
            """SELECT a.click_product_id, a.city_id
               FROM user_visit_action a JOIN user_info u ON a.user_id = u.user_id
               WHERE u.age BETWEEN 18 AND 45 AND a.click_product_id <> ''
                 AND a.click_category_id IN ('1', '3', '5', '7', '11', '13', '17', '19', '23', '29', '31',
                                             '37', '41', '43', '47')""",
            actions,
            "user_info",
        ),
        "filter_fields": with_views(
            """SELECT session_id, concat('page=', page_id, '|city=', city_id, '|kw=', search_keyword) AS fields
               FROM user_visit_action
               WHERE page_id BETWEEN 10 AND 70 AND city_id IN (1, 3, 5, 7, 9, 11) AND search_keyword = 'kw_3'""",
            actions,
        ),
        "log_table_range": with_views(
            """SELECT a.* FROM user_visit_action a
               WHERE date BETWEEN '2024-01-03' AND '2024-01-05'""",
            actions,
        ),
        "session_lengths": with_views(
            LENGTHS + " SELECT session_id, length_ms FROM lengths", actions
        ),
        "session_totals": with_views(
            LENGTHS + """
            SELECT count(*) AS total_session_count,
              CAST(sum(length_ms) AS DOUBLE) / 1000 AS total_session_length,
              count(*) FILTER (length_ms < 1000) AS invalid_session_count FROM lengths""",
            actions,
        ),
        "session_length_levels": with_views(
            LENGTHS + f"""
            SELECT {LEVEL} AS level, count(*) AS session_count FROM lengths GROUP BY ALL""",
            actions,
        ),
        "session_hour_lengths": with_views(
            PARTS + " SELECT day, hour, session_id, length_ms FROM parts", actions
        ),
        "hour_session_count": with_views(
            PARTS + """
            SELECT day, hour, count(*) AS session_count FROM parts GROUP BY day, hour""",
            actions,
        ),
        "hour_session_length": with_views(
            PARTS + """
            SELECT day, hour, CAST(sum(length_ms) // 1000 AS BIGINT) AS session_length
            FROM parts GROUP BY day, hour""",
            actions,
        ),
        "hour_invalid_count": with_views(
            PARTS + """
            SELECT day, hour, count(*) AS invalid_count FROM parts
            WHERE length_ms < 1000 GROUP BY day, hour""",
            actions,
        ),
        "session_aggr_json": with_views(PARTS + LENGTHS + STATISTICS, actions),
        "session_ratio_stats": with_views(
            LENGTHS + f" SELECT count(*) AS session_count, {_ratios()} FROM lengths", actions
        ),
        "sink_statistics_jdbc": with_views(PARTS + LENGTHS + STATISTICS, actions),
        "session_aggr_json_daily": with_views(PARTS + LENGTHS + STATISTICS, actions),
        "session_ratio_stats_daily": with_views(
            LENGTHS.replace(
                "FROM user_visit_action",
                f"FROM user_visit_action WHERE date BETWEEN '{PARAMETERS["startDate"]}' AND '{PARAMETERS["endDate"]}'",
            ) + f" SELECT count(*) AS session_count, {_ratios()} FROM lengths",
            actions,
        ),
        "sample_quota": with_views(
            PARTS + f"""
            SELECT day, hour, count(*) AS session_count,
              CAST(least(greatest(3, floor(count(*) * CAST({RATIO} AS DOUBLE))), 50)
                AS INTEGER) AS quota
            FROM parts GROUP BY day, hour""",
            actions,
        ),
        "request_parameters": with_views(
            PARTS + """,
            requests(request, ratio, kind) AS (VALUES
              (0, 0.01, 'bernoulli'), (1, 0.05, 'bernoulli'), (2, 0.1, 'poisson'), (3, 0.01, 'bernoulli'),
              (4, 0.02, 'bernoulli'), (5, 0.01, 'bernoulli'), (6, 0.01, 'bernoulli')),
            hours AS (SELECT day, hour, count(*) AS n FROM parts GROUP BY day, hour)
            SELECT CAST(request AS INTEGER) AS request, CAST(ratio AS DOUBLE) AS ratio, kind,
              CAST(sum(n) AS BIGINT) AS sessions,
              CAST(sum(least(greatest(3, floor(n * CAST(ratio AS DOUBLE))), 50)) AS BIGINT) AS quota
            FROM requests, hours GROUP BY request, ratio, kind""",
            actions,
        ).replace(VIEWS[ACTIONS], VIEWS["rich_action"]),
        "sample_sessions": with_views(
            PARTS + _sample(RATIO) + " SELECT * FROM sample", actions
        ),
        "sample_sessions_poisson": with_views(
            PARTS + _sample(RATIO, "poisson") + " SELECT * FROM sample", actions
        ),
        "sample_union_distinct": with_views(
            PARTS + _sample(0.01, seed=1, name="one") + _sample(0.05, seed=2, name="two") + """
            SELECT day, hour, session_id FROM one
            UNION SELECT day, hour, session_id FROM two""",
            actions,
        ),
        "sample_session_records": with_views(
            PARTS + _sample(RATIO) + TIMED + """
            SELECT timed.* FROM timed SEMI JOIN sample USING (session_id, day, hour)""",
            actions,
        ),
        "sample_top5_sessions": with_views(
            PARTS + _sample(RATIO) + TOP_SAMPLE + " SELECT * FROM top_sample", actions
        ),
        "sample_top5_records": with_views(
            PARTS + _sample(RATIO) + TOP_SAMPLE + TIMED + """
            SELECT timed.* FROM timed SEMI JOIN top_sample USING (session_id, day, hour)""",
            actions,
        ),
        "category_events": with_views(EVENTS + " SELECT * FROM ops", actions),
        "category_op_counts": with_views(EVENTS + " SELECT * FROM counts", actions),
        "category_top10_per_op": with_views(EVENTS + " SELECT * FROM top_per_op", actions),
        "top10_category": with_views(
            EVENTS + PIVOT + " FROM top_per_op GROUP BY category_id", actions
        ),
        "top10_category_full_counts": with_views(
            EVENTS + PIVOT + """
            FROM counts WHERE category_id IN (SELECT category_id FROM top_per_op)
            GROUP BY category_id""",
            actions,
        ),
        "category_session_counts": with_views(
            SESSION_COUNTS + " SELECT * FROM session_counts", actions
        ),
        "category_top10_sessions": with_views(
            SESSION_COUNTS + " SELECT * FROM top_sessions", actions
        ),
        "top10_category_sessions": with_views(
            SESSION_COUNTS + f"""
            SELECT category_id, {_category_listing(0, "click")},
              {_category_listing(1, "order")}, {_category_listing(2, "pay")}
            FROM top_sessions GROUP BY category_id""",
            actions,
        ),
        "sink_category_sessions_jdbc": with_views(
            SESSION_COUNTS + f"""
            SELECT CAST({TASK_ID} AS BIGINT) AS task_id, category_id, {_category_listing(0, "click")},
              {_category_listing(1, "order")}, {_category_listing(2, "pay")}
            FROM top_sessions GROUP BY category_id""",
            actions,
        ),
        "top_session_records": with_views(
            SESSION_COUNTS + """
            SELECT * FROM user_visit_action
            WHERE session_id IN (SELECT session_id FROM top_sessions)""",
            actions,
        ),
        "product_city_clicks": with_views(
            CLICKS + """
            SELECT k.city_id, click_product_id, city_name, area, province_name
            FROM clicks k JOIN city_info i ON k.city_id = i.city_id""",
            actions,
            "city_info",
        ),
        "area_product_clicks": with_views(
            CLICKS + AREA_CLICKS + " SELECT * FROM area_clicks", actions, "city_info"
        ),
        "area_top10_products": with_views(CLICKS + AREA_TOP, *products),
        "area_top10_products_filtered": with_views(
            FILTERED_CLICKS + AREA_TOP, *products, "user_info"
        ),
        "counted_concat": with_views(
            """SELECT date, string_agg(concat(search_keyword, ':', c), ',' ORDER BY search_keyword)
                 AS keywords
               FROM (SELECT date, search_keyword, count(*) AS c FROM user_visit_action
                     WHERE search_keyword <> '' GROUP BY ALL)
               GROUP BY date""",
            actions,
        ),
        "counted_values": with_views(PRODUCT_SESSIONS + " SELECT * FROM counted", actions),
        "counted_concat_parts": with_views(
            PRODUCT_SESSIONS + """,
            dealt AS (
              SELECT *, CAST(concat('0x', substr(md5(value), 1, 8)) AS BIGINT)
                % CAST(ceil(count(*) OVER (PARTITION BY click_product_id) / 3.0) AS BIGINT) AS part
              FROM counted)
            SELECT click_product_id, part, string_agg(concat(value, ':', n), ',' ORDER BY value) AS sessions
            FROM dealt GROUP BY ALL""",
            actions,
        ),
        "area_product_clicks_sql": with_views(
            CLICKS + """,
            counted AS (
              SELECT area, click_product_id, concat(k.city_id, ':', city_name) AS value, count(*) AS n
              FROM clicks k JOIN city_info i ON k.city_id = i.city_id GROUP BY ALL)
            SELECT area, click_product_id, CAST(sum(n) AS BIGINT) AS click_count,
              string_agg(concat(value, ':', n), ',' ORDER BY value) AS city_infos
            FROM counted GROUP BY area, click_product_id""",
            actions,
            "city_info",
        ),
        "scalar_functions": with_views(SCALARS, actions),
        "ad_click_parse": with_views(AD_CLICKS + " SELECT * FROM ad_click", "ad_message"),
        "ad_click_counts": with_views(AD_CLICKS + AD_COUNTS, "ad_message"),
        "ad_click_counts_stream": with_views(AD_CLICKS + AD_COUNTS, "ad_message"),
        "ad_click_refused": with_views(
            """,
            p AS (SELECT string_split(value, ' ') AS p FROM ad_feed)
            SELECT CASE WHEN len(p) <> 5 THEN 'fields'
                WHEN TRY_CAST(p[1] AS BIGINT) IS NULL THEN 'timestamp'
                WHEN TRY_CAST(p[4] AS BIGINT) IS NULL THEN 'user_id'
                WHEN TRY_CAST(p[5] AS BIGINT) IS NULL THEN 'ad_id' ELSE 'accepted' END AS reason,
              count(*) AS messages
            FROM p GROUP BY ALL""",
            "ad_feed",
        ),
        "ad_click_counts_closed": with_views(
            AD_CLICKS + f"""
            SELECT * FROM ({AD_COUNTS})
            WHERE window_end <= (SELECT max(ts) FROM ad_click) - INTERVAL 1 MINUTE""",
            "ad_message",
        ),
    }
