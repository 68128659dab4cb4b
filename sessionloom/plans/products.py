"""Hot products: the most-clicked products of each sales area."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from sessionloom.functions.labels import AREA_LEVELS
from sessionloom.operators import filters, products
from sessionloom.sinks import jdbc
from sessionloom.sources.jdbc import load_task_params, read_city_info
from sessionloom.sources.tables import PRODUCT_TABLE, read_action_tables, read_table
from sessionloom.workspace import temporary_tables


def area_top10_products(
    actions: DataFrame,
    users: DataFrame | None,
    cities: DataFrame,
    product_info: DataFrame,
    params: dict,
    k: int = 10,
    levels: Mapping[str, str] = AREA_LEVELS,
    extended: bool = False,
) -> DataFrame:
    """One lazy plan from the action log to the described top products."""
    filters.refuse_unused(params, extended)
    clicks = filters.filter_clicks(actions, users, params, extended)
    ranked = products.area_top_products(clicks, cities, k)
    return products.describe_products(ranked, product_info, levels)


def run_product_job(
    spark: SparkSession,
    task_id: int,
    url: str,
    properties: Mapping[str, str] | None = None,
    extended: bool = False,
    k: int = 10,
) -> None:
    """The whole job for one task of the task table; cities come from the same database.

    The cities are written out first, as the size of a JDBC table is unknown and a known
    small one is broadcast; so are the wanted users and the ranked products, k an area, so that
    neither the log nor the product table is shuffled for them; and the result, as the few connections of the sink would
    narrow the product scan before it.
    """
    params = load_task_params(spark, url, task_id, properties)
    with temporary_tables(spark) as materialize:
        filters.refuse_unused(params, extended)
        actions, users = read_action_tables(spark, params, extended)
        if users is not None:
            users = materialize(filters.wanted_users(users, params, extended), "users")
        cities = materialize(read_city_info(spark, url, properties), "cities")
        clicks = filters.filter_clicks(actions, users, params, extended)
        ranked = materialize(products.area_top_products(clicks, cities, k), "ranked")
        result = products.describe_products(ranked, read_table(spark, PRODUCT_TABLE))
        jdbc.append_area_products(materialize(result, "area-products"), task_id, url, properties)
