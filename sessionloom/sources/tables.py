"""Catalog tables and temporary views."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from sessionloom.operators.filters import all_user_conditions
from sessionloom.schemas import ACTION_COLUMNS

ACTION_TABLE = "user_visit_action"
USER_TABLE = "user_info"
PRODUCT_TABLE = "product_info"


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_action_tables(spark: SparkSession, params: dict, extended: bool = False) -> tuple[DataFrame, DataFrame | None]:
    """The action log, and the user table where the parameters filter on users."""
    users = read_table(spark, USER_TABLE) if all_user_conditions(params, extended) else None
    return read_table(spark, ACTION_TABLE), users


def register_views(frames: Mapping[str, DataFrame]) -> None:
    """Make frames visible to this session's SQL under their names."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)


def write_log_days(actions: DataFrame, table: str = ACTION_TABLE) -> None:
    """Take the days that ``actions`` has, whole, into a log table partitioned by ``date``.

    The table is created where it is missing; days it had are replaced, other days stay.  Rows of
    a day are put together, so a day is few files, and a day with too many rows for one task is
    split again.  A date filter on the table, or a join with a small table of dates, then reads the
    files of these days only.
    """
    spark = actions.sparkSession
    columns = [c for c in ACTION_COLUMNS if c != "date"]
    rows = actions.select(*columns, "date").hint("rebalance", "date")
    if not spark.catalog.tableExists(table):
        rows.write.partitionBy("date").saveAsTable(table, format="parquet")
    else:
        # A catalog table takes this from the session, not from the writer's options.
        mode = "spark.sql.sources.partitionOverwriteMode"
        before = spark.conf.get(mode)
        spark.conf.set(mode, "dynamic")
        try:
            rows.write.insertInto(table, overwrite=True)
        finally:
            spark.conf.set(mode, before)
