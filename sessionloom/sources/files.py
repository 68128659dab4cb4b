"""Delimited text files.

Lines are split by hand rather than with the CSV reader: fields are never quoted, product
lines hold JSON with commas and quotes, and a line with the wrong number of fields is
dropped whole.  Separators at the end of a line open no further field.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sessionloom import schemas

FIELD_SEPARATOR = ","
PRODUCT_SEPARATOR = "^"


def parse_lines(lines: DataFrame, schema: StructType, separator: str) -> DataFrame:
    """``value`` lines to typed columns; a number that is none fails the query (ANSI mode).

    The fields pass through an explode of none or one item, so that the test of their number
    is not pushed below the split, which would then run twice (a third slower, measured).
    """
    fields = F.col("fields")
    parts = F.split(F.rtrim("value", F.lit(separator)), re.escape(separator))
    return (
        lines.select(parts.alias("fields"))
        .select(F.explode(F.when(F.size(fields) == len(schema), F.array(fields))).alias("fields"))
        .select(
            *[
                fields[i].cast(column.dataType).alias(column.name)
                for i, column in enumerate(schema)
            ]
        )
    )


def read_user_info(spark: SparkSession, path: str, separator: str = FIELD_SEPARATOR) -> DataFrame:
    return parse_lines(spark.read.text(path), schemas.USER_INFO, separator)


def read_user_visit_action(
    spark: SparkSession, path: str, separator: str = FIELD_SEPARATOR
) -> DataFrame:
    return parse_lines(spark.read.text(path), schemas.USER_VISIT_ACTION, separator)


def read_product_info(
    spark: SparkSession, path: str, separator: str = PRODUCT_SEPARATOR
) -> DataFrame:
    return parse_lines(spark.read.text(path), schemas.PRODUCT_INFO, separator)
