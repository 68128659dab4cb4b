"""The library's input tables, derived from the supplied tables.

One SQL text per table runs unchanged in Spark and in DuckDB; none holds operator logic.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

# Stated, so that opening a table takes no job to look at its files.
SOURCES = {
    "events": (
        "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, "
        "props STRING"
    ),
    "customer": (
        "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"
    ),
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "region": "r_regionkey INT, r_name STRING",
    "part": (
        "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
        "p_retailprice DOUBLE"
    ),
}

VIEWS = {
    # click stays, signup stands for order, purchase for pay, error for search
    "user_visit_action": """
        SELECT CAST(CAST(ts AS DATE) AS VARCHAR(10)) AS date, user_id,
          CASE WHEN event_id % 7 = 0 THEN concat('x', event_id)
               ELSE concat('s', event_id - event_id % 2) END AS session_id,
          k AS page_id, CAST(date_trunc('second', ts) AS VARCHAR(19)) AS action_time,
          CASE WHEN event_type = 'error' THEN concat('kw_', k % 10) ELSE '' END AS search_keyword,
          CASE WHEN event_type = 'click' THEN CAST(k % 50 AS VARCHAR(20)) ELSE '' END
            AS click_category_id,
          CASE WHEN event_type = 'click' THEN CAST(k AS VARCHAR(20)) ELSE '' END
            AS click_product_id,
          CASE WHEN event_type = 'signup'
               THEN concat(k % 50, '|', (k + 7) % 50, '|', (k + 50) % 50) ELSE '' END
            AS order_category_ids,
          CASE WHEN event_type = 'signup'
               THEN concat(k, '|', k + 7, '|', k + 50) ELSE '' END AS order_product_ids,
          CASE WHEN event_type = 'purchase'
               THEN concat(k % 50, '|', (k + 7) % 50, '|', (k + 50) % 50) ELSE '' END
            AS pay_category_ids,
          CASE WHEN event_type = 'purchase'
               THEN concat(k, '|', k + 7, '|', k + 50) ELSE '' END AS pay_product_ids,
          CAST(user_id % 25 AS INT) AS city_id
        FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k
              FROM events) e""",
    # The same columns with few hours, sessions of very different weight, ids that are blank or the word
    # null, list items that are blank, products and cities without an entry, and equal counts.
    "rich_action": """
        SELECT concat('2024-01-0', 1 + event_id % 2) AS date, user_id,
          CASE WHEN event_id % 3 = 0 THEN concat('h', event_id % 7)
               ELSE concat('s', event_id % 997) END AS session_id,
          k AS page_id,
          concat('2024-01-0', 1 + event_id % 2, ' 1', event_id % 3, ':', 10 + k % 50, ':',
                 10 + event_id % 50) AS action_time,
          CASE WHEN event_type = 'error' THEN concat('kw_', k % 10) ELSE '' END AS search_keyword,
          CASE WHEN event_type = 'click' THEN CAST(k % 50 AS VARCHAR(20))
               WHEN event_type = 'view' AND k % 3 = 0 THEN '  ' ELSE '' END AS click_category_id,
          CASE WHEN event_type <> 'click' THEN ''
               WHEN k % 11 = 0 THEN 'null' WHEN k % 11 = 1 THEN ' NULL ' WHEN k % 11 = 2 THEN ' '
               WHEN k % 11 = 3 THEN CAST(k + 100000000 AS VARCHAR(20))
               ELSE CAST(k AS VARCHAR(20)) END AS click_product_id,
          CASE WHEN event_type <> 'signup' THEN ''
               WHEN k % 4 = 0 THEN concat(k % 50, '||', (k + 7) % 50, '| |', k % 50)
               WHEN k % 4 = 1 THEN concat('|', k % 50, '|') ELSE concat(k % 50, '|', (k + 50) % 50) END
            AS order_category_ids,
          '' AS order_product_ids,
          CASE WHEN event_type = 'purchase' THEN concat(k % 5, '| |', (k + 7) % 50) ELSE '' END AS pay_category_ids,
          '' AS pay_product_ids,
          CAST(user_id % 28 AS INT) AS city_id
        FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k
              FROM events) e""",
    "user_info": """
        SELECT c_custkey AS user_id, concat('user_', c_custkey) AS user_name, c_name AS name,
          CAST(15 + c_custkey % 45 AS INT) AS age, c_mktsegment AS professional,
          n_name AS city,
          CASE c_custkey % 3 WHEN 0 THEN 'male' WHEN 1 THEN 'female' ELSE 'unknown' END AS sex
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "product_info": """
        SELECT p_partkey AS product_id, p_name AS product_name,
          concat('{"product_type":"', p_partkey % 3, '"}') AS extend_info
        FROM part""",
    "city_info": """
        SELECT n_nationkey AS city_id, n_name AS city_name, r_name AS area,
          concat('province_', n_nationkey) AS province_name
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    # one analysis request per customer
    "tb_task": """
        SELECT c_custkey AS task_id, concat('task ', c_custkey) AS task_name,
          '2024-01-01 00:00:00' AS create_time, '2024-01-01 00:00:01' AS start_time,
          '2024-01-01 00:00:02' AS finish_time, 'session' AS task_type,
          'done' AS task_status,
          concat('{"sex":"male","professionals":"', c_mktsegment, '"}') AS task_param
        FROM customer""",
    # ad-click messages in their text form
    "ad_message": """
        SELECT concat(epoch, ' province_', user_id % 100, ' city_', user_id % 1000, ' ',
                      user_id, ' ', k) AS value
        FROM (SELECT user_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k,
                EPOCH_MS AS epoch
              FROM events) e""",
    # the same feed with messages that are no clicks: wrong shape, or a broken number
    "ad_feed": """
        SELECT CASE event_id % 12
            WHEN 1 THEN concat(epoch, ' province_', k)
            WHEN 3 THEN concat('x', epoch, ' province_', k, ' city_1 ', user_id, ' ', k)
            WHEN 5 THEN concat(epoch, ' province_', k, ' city_1 u', user_id, ' ', k)
            WHEN 7 THEN concat(epoch, ' province_', k, ' city_1 ', user_id, ' ad', k)
            WHEN 9 THEN concat(epoch, ' province_', k, ' city_1 ', user_id, ' ', k, ' more')
            ELSE concat(epoch, ' province_', user_id % 100, ' city_', user_id % 1000, ' ', user_id,
                        ' ', k) END AS value
        FROM (SELECT event_id, user_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k,
                EPOCH_MS AS epoch
              FROM events) e""",
}

# The one expression the two engines spell differently: milliseconds since 1970.
SPARK_EPOCH_MS = "unix_millis(CAST(ts AS TIMESTAMP))"
DUCKDB_EPOCH_MS = "epoch_us(ts) // 1000"

# The supplied areas in place of the library's default sales areas.
AREA_LEVELS = {
    "AFRICA": "A",
    "AMERICA": "A",
    "ASIA": "B",
    "EUROPE": "B",
    "MIDDLE EAST": "C",
}


# Without an entry for one of the areas.
SOME_AREA_LEVELS = {"AFRICA": "A", "AMERICA": "A", "ASIA": "B", "EUROPE": "C"}


class Tables:
    """The views as attributes, each opened when first used."""

    user_visit_action: DataFrame
    user_info: DataFrame
    product_info: DataFrame
    city_info: DataFrame
    tb_task: DataFrame
    ad_message: DataFrame
    ad_feed: DataFrame
    rich_action: DataFrame

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name not in VIEWS:
            raise AttributeError(name)
        text = VIEWS[name]
        for source, schema in SOURCES.items():
            if re.search(rf"\b{source}\b", text):
                reader = self._spark.read.schema(schema)
                reader.parquet(f"{self._sf_dir}/{source}.parquet").createOrReplaceTempView(source)
        frame = self._spark.sql(text.replace("EPOCH_MS", SPARK_EPOCH_MS))
        setattr(self, name, frame)
        return frame


def load_tables(spark: SparkSession, sf_dir: str) -> Tables:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return Tables(spark, sf_dir)


def with_views(select: str, *names: str) -> str:
    """DuckDB text: the named views as common table expressions before ``select``."""
    views = ", ".join(
        f"{name} AS ({VIEWS[name].replace('EPOCH_MS', DUCKDB_EPOCH_MS)})" for name in names
    )
    return f"WITH {views}{select if select.lstrip().startswith(',') else ' ' + select}"
