"""The most-clicked products per sales area, with clicks per city."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionloom.functions.labels import AREA_LEVELS, area_level, product_label
from sessionloom.functions.text import concat_id_name


def product_city_clicks(clicks: DataFrame, cities: DataFrame) -> DataFrame:
    """Each click with its city; clicks in unknown cities drop out.

    Spark broadcasts the city table when its size allows; otherwise the join shuffles and
    adaptive execution splits a city that holds too many clicks.
    """
    return clicks.join(cities, "city_id").select(
        "city_id", "click_product_id", "city_name", "area", "province_name"
    )


def _area_product_groups(clicks: DataFrame, cities: DataFrame) -> DataFrame:
    """``area, click_product_id, click_count, city_counts``.

    Clicks are counted per (product, city) before the join, so the join and the second
    grouping see at most one row per pair, however hot a product or a city is, and a group
    of the second holds at most the cities of one area.  A city listed more than once
    multiplies its clicks, as in any join.
    """
    pairs = clicks.groupBy("click_product_id", "city_id").agg(F.count(F.lit(1)).alias("clicks"))
    places = cities.groupBy("city_id", "city_name", "area").agg(
        F.count(F.lit(1)).alias("copies")
    )
    return (
        pairs.join(places, "city_id")
        .select(
            "area", "click_product_id", "city_id", "city_name",
            (F.col("clicks") * F.col("copies")).alias("clicks"),
        )
        .groupBy("area", "click_product_id")
        .agg(
            F.sum("clicks").alias("click_count"),
            F.collect_list(F.struct("city_id", "city_name", "clicks")).alias("city_counts"),
        )
    )


def _with_city_infos(groups: DataFrame) -> DataFrame:
    item = F.transform(
        F.array_sort("city_counts"),
        lambda c: F.concat(
            concat_id_name(c["city_id"], c["city_name"]), F.lit(":"), c["clicks"].cast("string")
        ),
    )
    return groups.select(
        "area", "click_product_id", "click_count", F.array_join(item, ",").alias("city_infos")
    )


def area_product_clicks(clicks: DataFrame, cities: DataFrame) -> DataFrame:
    """``area, click_product_id, click_count, city_infos``, the last as
    ``id:name:clicks`` items joined by commas in city order."""
    return _with_city_infos(_area_product_groups(clicks, cities))


def area_top_products(clicks: DataFrame, cities: DataFrame, k: int = 10) -> DataFrame:
    """The k most-clicked products of each area; ties go to the smaller product id.

    Ranking keeps k rows per area in each task before the shuffle, and the city texts are
    built for the ranked rows only.
    """
    order = Window.partitionBy("area").orderBy(F.desc("click_count"), F.asc("click_product_id"))
    ranked = (
        _area_product_groups(clicks, cities)
        .withColumn("_rank", F.row_number().over(order))
        .where(F.col("_rank") <= k)
    )
    return _with_city_infos(ranked)


def describe_products(
    ranked: DataFrame, products: DataFrame, levels: Mapping[str, str] = AREA_LEVELS
) -> DataFrame:
    """Adds area level, product name and product label; unknown products drop out, so an
    area may end with fewer rows than were ranked."""
    keyed = ranked.withColumn("_key", F.expr("try_cast(click_product_id AS BIGINT)"))
    return keyed.join(products, F.col("_key") == products["product_id"]).select(
        area_level("area", levels).alias("area_level"),
        F.col("click_product_id").alias("product_id"),
        "area",
        "click_count",
        "city_infos",
        "product_name",
        product_label("extend_info").alias("product_type"),
    )


def counted_values(df: DataFrame, group: list[str], value: str) -> DataFrame:
    """``value, n`` per group: each distinct text with its number of rows, one row each.

    The form to use where a group can have any number of values: counts combine on the map side
    and nothing gathers a group.  Nulls are skipped.
    """
    texts = df.select(*group, F.col(value).cast("string").alias("value")).dropna(subset=["value"])
    return texts.groupBy(*group, "value").agg(F.count(F.lit(1)).alias("n"))


def _concat_items(items: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(items), lambda p: F.concat_ws(":", p["value"], p["n"])), ",")


def counted_concat(df: DataFrame, group: list[str], value: str, output: str) -> DataFrame:
    """Per group, each distinct text of ``value`` with its count, as ``text:count`` items
    joined by commas in text order.  Nulls are skipped; a group of nulls has an empty text.

    For values of a bounded table, such as cities: the text of a group is one value, and so is the
    list of its distinct texts.  For others see ``counted_concat_parts``.
    """
    counts = counted_values(df, group, value)
    texts = counts.groupBy(*group).agg(_concat_items(F.collect_list(F.struct("value", "n"))).alias(output))
    void = df.where(F.col(value).isNull()).select(*group).distinct()
    empty = void.select(*group, F.lit("").alias(output))
    return texts.unionByName(empty).groupBy(*group).agg(F.max(output).alias(output))


def counted_concat_parts(
    df: DataFrame, group: list[str], value: str, output: str, items_per_row: int = 10_000
) -> DataFrame:
    """As ``counted_concat``, in rows ``part`` from 0 that hold about ``items_per_row`` items each.

    Items are dealt to the parts of their group by a digest of the text and stand in text order
    inside a part, so no list grows with the group.
    """
    counts = counted_values(df, group, value).withColumn(
        "_digest", F.conv(F.substring(F.md5("value"), 1, 8), 16, 10).cast("bigint")
    )
    sizes = counts.groupBy(*group).agg(F.ceil(F.count(F.lit(1)) / items_per_row).alias("_parts"))
    # Null groups are groups, as in GROUP BY.
    same = reduce(Column.__and__, [F.col(f"c.{g}").eqNullSafe(F.col(f"s.{g}")) for g in group])
    dealt = counts.alias("c").join(sizes.alias("s"), same).select(
        *[F.col(f"c.{g}").alias(g) for g in group], "value", "n", (F.col("_digest") % F.col("_parts")).alias("part")
    )
    items = F.collect_list(F.struct("value", "n"))
    return dealt.groupBy(*group, "part").agg(_concat_items(items).alias(output))
