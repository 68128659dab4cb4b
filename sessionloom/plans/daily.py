"""Session figures over any range of days, kept up to date day by day.

A day of the log is reduced once to its session-hours (``operators.sessions.session_hours``): minimum,
maximum and count of actions, which merge.  A range of days is answered from these rows; a session that crosses
midnight, or an hour whose records lie under two dates, is merged there.  So a day that is added or delivered
again costs one pass over that day, and a request reads no log at all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionloom.operators import sessions
from sessionloom.operators.filters import in_date_range
from sessionloom.workspace import exists

_SCHEMA = "session_id string, day string, hour int, n bigint, last timestamp, first timestamp, date string"


class SessionDays:
    """Session-hours by log date, Parquet in folders ``date=…`` under ``path``."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._spark, self.path = spark, path

    def refresh(self, actions: DataFrame) -> None:
        """Take in the days that ``actions`` has, whole; what was kept of these days is replaced.

        Days without actions stay as they are.
        """
        parts = sessions.session_hours(actions, "date")
        # Rows of a date are put together, and a date with too many of them is split again.
        writer = parts.hint("rebalance", "date").write.mode("overwrite").partitionBy("date")
        writer.option("partitionOverwriteMode", "dynamic").parquet(self.path)

    def days(self) -> DataFrame:
        """``date, session_id, day, hour, n, last, first`` as kept."""
        if not exists(self._spark, self.path):
            return self._spark.createDataFrame([], _SCHEMA)
        return self._spark.read.schema(_SCHEMA).parquet(self.path)

    def session_hours(self, params: dict) -> DataFrame:
        """``operators.sessions.session_hours`` of the log between the dates of the parameters."""
        kept = self.days()
        for condition in in_date_range(params):
            kept = kept.where(condition)
        return kept.groupBy(*sessions.SESSION_HOUR).agg(
            F.sum("n").alias("n"), F.max("last").alias("last"), F.min("first").alias("first")
        )

    def statistics(self, params: dict) -> DataFrame:
        return sessions.statistics_of(self.session_hours(params))

    def ratios(self, params: dict) -> DataFrame:
        return sessions.ratios_of(self.session_hours(params))
