"""The scalar functions under SQL names, for callers who write SQL text.

They are SQL functions, so Catalyst inlines them like any other expression.  ``concat_distinct_str``
takes the counted texts of a group, which ``register_counted_values`` provides as a table function.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

from sessionloom.functions.labels import PRODUCT_LABELS, UNKNOWN_PRODUCT

_PRODUCT_CASES = " ".join(f"WHEN '{key}' THEN '{label}'" for key, label in PRODUCT_LABELS.items())

SQL_FUNCTIONS = (
    r"""
    isNotEmpty(str STRING) RETURNS BOOLEAN
    RETURN str IS NOT NULL
      AND str RLIKE '(?is)\\A(?![\\x00-\\x20]*(?:null)?[\\x00-\\x20]*\\z).'
    """,
    """
    concat_id_name(id INT, name STRING) RETURNS STRING
    RETURN concat(id, ':', coalesce(name, 'null'))
    """,
    """
    concat_distinct_str(counted ARRAY<STRUCT<value: STRING, n: BIGINT>>) RETURNS STRING
    RETURN array_join(transform(array_sort(counted), c -> concat(c.value, ':', c.n)), ',')
    """,
    f"""
    fetch_product_type_from_json(json STRING) RETURNS STRING
    RETURN CASE get_json_object(json, '$.product_type') {_PRODUCT_CASES}
      ELSE '{UNKNOWN_PRODUCT}' END
    """,
)


def register_sql_functions(spark: SparkSession) -> None:
    """Make the scalar functions callable from this session's SQL."""
    for definition in SQL_FUNCTIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {definition}")


def register_counted_values(
    spark: SparkSession, name: str, source: str, group: Mapping[str, str], value: str
) -> None:
    """Make ``name()`` a table function of this session: ``group``, ``value`` and its number ``n``.

    ``source`` is a table or view, ``group`` has the columns and their SQL types, ``value`` is an
    SQL expression.  Counting is an aggregation of its own, so it combines before the shuffle, and
    ``concat_distinct_str`` over it holds each distinct text of a group once:

        SELECT area, sum(n) AS clicks, concat_distinct_str(collect_list(struct(value, n))) AS cities
        FROM city_clicks() GROUP BY area
    """
    columns = ", ".join(f"`{column}` {kind}" for column, kind in group.items())
    keys = ", ".join(f"`{column}`" for column in group)
    spark.sql(
        f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}() RETURNS TABLE({columns}, value STRING, n BIGINT)
        RETURN SELECT {keys}, value, count(1) AS n
          FROM (SELECT {keys}, {value} AS value FROM {source}) WHERE value IS NOT NULL
          GROUP BY {keys}, value
        """
    )
