"""Filtering the action log by a request's parameters.

Filters are plain column comparisons, so they reach the scan of the table they are about.
The user table is joined only when a filter on users is set, after that filter.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionloom import params as P
from sessionloom.functions.text import is_real_id
from sessionloom.schemas import ACTION_COLUMNS


def in_date_range(params: dict, column: str = "date") -> list[Column]:
    """Inclusive bounds, compared as text; each side is optional."""
    start, end = P.get_param(params, P.START_DATE), P.get_param(params, P.END_DATE)
    bounds = []
    if start is not None:
        bounds.append(F.col(column) >= start)
    if end is not None:
        bounds.append(F.col(column) <= end)
    return bounds


def user_conditions(params: dict) -> list[Column]:
    sex, professionals = P.get_param(params, P.SEX), P.get_list(params, P.PROFESSIONALS)
    conditions = []
    if sex is not None:
        conditions.append(F.col("sex") == sex)
    if professionals is not None:
        conditions.append(F.col("professional").isin(professionals))
    return conditions


def shares_item(column: str, items: list[str]) -> Column:
    """Whether the column's comma list and ``items`` have an item in common."""
    wanted = F.array(*[F.lit(item) for item in items])
    return F.arrays_overlap(F.split(F.col(column), ","), wanted)


def extended_user_conditions(params: dict) -> list[Column]:
    """Age and city.  The parameters have names but no stated use; this use is our own."""
    start, end = P.get_param(params, P.START_AGE), P.get_param(params, P.END_AGE)
    cities = P.get_list(params, P.CITIES)
    conditions = []
    if start is not None and end is not None:
        conditions.append(F.col("age").between(int(start), int(end)))
    if cities is not None:
        conditions.append(shares_item("city", cities))
    return conditions


def extended_action_conditions(params: dict) -> list[Column]:
    """Search keywords and clicked categories; own definition, as above."""
    keywords, categories = P.get_list(params, P.KEYWORDS), P.get_list(params, P.CATEGORY_IDS)
    conditions = []
    if keywords is not None:
        conditions.append(shares_item("search_keyword", keywords))
    if categories is not None:
        conditions.append(shares_item("click_category_id", categories))
    return conditions


EXTENDED_PARAMETERS = (P.START_AGE, P.END_AGE, P.CITIES, P.KEYWORDS, P.CATEGORY_IDS)


def all_user_conditions(params: dict, extended: bool) -> list[Column]:
    return user_conditions(params) + (extended_user_conditions(params) if extended else [])


def refuse_unused(params: dict, extended: bool) -> None:
    """No parameter is passed over in silence: those of ``extended`` need it."""
    unused = [name for name in EXTENDED_PARAMETERS if P.get_param(params, name) is not None]
    if unused and not extended:
        raise ValueError(f"parameters {', '.join(unused)} are used with extended=True only")


def wanted_users(users: DataFrame, params: dict, extended: bool = False) -> DataFrame:
    """The users that the parameters ask for, with the columns that filters look at."""
    columns = ["user_id", "age", "professional", "city", "sex"]
    return _where_all(users, all_user_conditions(params, extended)).select(*columns)


def selective(keys: DataFrame, column: str) -> DataFrame:
    """The same rows but those without a key, which join nothing, in a form that invites a runtime filter.

    Where the other side of a join is a large scan, Spark builds a Bloom filter of these keys and applies it to the
    scan, before the shuffle; it does so only where the keys come from a comparison, as they do here.
    """
    least = F.lit("") if dict(keys.dtypes)[column] == "string" else F.lit(-(1 << 63))
    return keys.where(F.col(column) >= least)


def _where_all(df: DataFrame, conditions: list[Column]) -> DataFrame:
    return df.where(reduce(Column.__and__, conditions)) if conditions else df


def _select_actions(
    actions: DataFrame,
    users: DataFrame | None,
    params: dict,
    action_conditions: list[Column],
    on_users: list[Column],
    columns: list[str],
) -> DataFrame:
    kept = _where_all(actions, action_conditions + in_date_range(params))
    if not on_users:
        return kept.select(*columns)
    if users is None:
        raise ValueError("the parameters filter on users, so the user table is needed")
    wanted = _where_all(users, on_users).select("user_id")
    wanted = selective(wanted, "user_id")
    return kept.select(*dict.fromkeys([*columns, "user_id"])).join(wanted, "user_id").select(*columns)


def filter_actions(
    actions: DataFrame, users: DataFrame | None, params: dict, extended: bool = False
) -> DataFrame:
    """Actions that meet the date, sex and profession parameters, all columns.

    With ``extended`` the age, city, keyword and category parameters count as well.
    """
    return _select_actions(
        actions,
        users,
        params,
        extended_action_conditions(params) if extended else [],
        all_user_conditions(params, extended),
        ACTION_COLUMNS,
    )


def filter_clicks(
    actions: DataFrame, users: DataFrame | None, params: dict, extended: bool = False
) -> DataFrame:
    """Product and city of each filtered action that clicked a real product; ``extended`` as above."""
    return _select_actions(
        actions,
        users,
        params,
        [is_real_id("click_product_id"), *(extended_action_conditions(params) if extended else [])],
        all_user_conditions(params, extended),
        ["click_product_id", "city_id"],
    )
