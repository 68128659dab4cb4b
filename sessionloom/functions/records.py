"""Action records as JSON objects."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sessionloom.schemas import ACTION_COLUMNS


def record_struct() -> Column:
    return F.struct(*ACTION_COLUMNS)


def record_json() -> Column:
    """The thirteen action columns as one JSON object; null fields are left out."""
    return F.to_json(record_struct())
