"""Text files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionloom.functions.records import record_json
from sessionloom.operators.sampling import sample_lines


def write_lines(lines: DataFrame, path: str) -> None:
    """One line per row of ``value``; what was at the path is replaced."""
    lines.write.mode("overwrite").text(path)


def record_lines(records: DataFrame) -> DataFrame:
    """``value``: each action record as a JSON object."""
    return records.select(record_json().alias("value"))


def write_sample_records(records: DataFrame, path: str) -> None:
    write_lines(sample_lines(records), path)


def write_session_records(records: DataFrame, path: str) -> None:
    write_lines(record_lines(records), path)


def delimited_lines(df: DataFrame, separator: str = ",") -> DataFrame:
    """``value``: all columns joined by the separator; nulls are written as ``null``."""
    texts = [F.coalesce(F.col(name).cast("string"), F.lit("null")) for name in df.columns]
    return df.select(F.concat_ws(separator, *texts).alias("value"))


def write_delimited(df: DataFrame, path: str, separator: str = ",") -> None:
    write_lines(delimited_lines(df, separator), path)
