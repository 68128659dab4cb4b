import pytest

from data import action, actions, rows, users
from sessionloom.operators import filters

SMALL = [
    action("a", "2024-01-01 09:00:00", user_id=1, search_keyword="x,y"),
    action("b", "2024-01-02 09:00:00", user_id=2, click_category_id="3", click_product_id="7"),
    action("c", "2024-01-03 09:00:00", user_id=3, click_category_id="4", click_product_id=" NULL "),
    action("d", "2024-01-04 09:00:00", user_id=9, click_product_id="0"),
]
PEOPLE = [(1, 20, "医生", "上海", "male"), (2, 30, "教师", "北京", "female"), (3, 40, " 教师", "", "male")]


@pytest.fixture
def log(spark):
    return actions(spark, *SMALL), users(spark, *PEOPLE)


def kept(log, params, **options):
    return [r[0] for r in rows(filters.filter_actions(*log, params, **options), "session_id")]


def test_dates_are_inclusive_and_optional(log):
    assert kept(log, {}) == ["a", "b", "c", "d"]
    assert kept(log, {"startDate": "2024-01-02"}) == ["b", "c", "d"]
    assert kept(log, {"startDate": "2024-01-02", "endDate": "2024-01-03"}) == ["b", "c"]
    assert kept(log, {"endDate": " "}) == ["a", "b", "c", "d"]


def test_user_filters(log):
    assert kept(log, {"sex": "male"}) == ["a", "c"]
    assert kept(log, {"professionals": "医生,教师"}) == ["a", "b"]
    assert kept(log, {"professionals": "医生, 教师"}) == ["a", "c"]
    assert kept(log, {"sex": "male", "professionals": "教师"}) == []


def test_user_table_is_joined_only_when_needed(log):
    plan = filters.filter_actions(*log, {"startDate": "2024-01-02"})._jdf.queryExecution().toString()
    assert "Join" not in plan
    with pytest.raises(ValueError, match="user table"):
        filters.filter_actions(log[0], None, {"sex": "male"})


def test_extended_filters(log):
    def extended(params):
        return kept(log, params, extended=True)

    assert extended({"startAge": "20", "endAge": "30"}) == ["a", "b"]
    assert extended({"startAge": "20"}) == ["a", "b", "c", "d"]
    assert extended({"cities": "北京,广州"}) == ["b"]
    assert extended({"keywords": "y,z"}) == ["a"]
    assert extended({"categoryIds": "4,5"}) == ["c"]
    assert kept(log, {"keywords": "y"}) == ["a", "b", "c", "d"]


def test_clicks(log):
    assert rows(filters.filter_clicks(*log, {})) == [("0", 1), ("7", 1)]
    assert rows(filters.filter_clicks(*log, {"sex": "female"})) == [("7", 1)]


def test_filters_reach_the_scan(spark, log, tmp_path):
    log[0].write.parquet(str(tmp_path / "actions"))
    stored = spark.read.parquet(str(tmp_path / "actions"))
    clicks = filters.filter_clicks(stored, log[1], {"startDate": "2024-01-02"})
    plan = clicks._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(date,2024-01-02)" in plan
    assert "ReadSchema: struct<date:string,click_product_id:string,city_id:int>" in plan


def test_parameters_that_would_be_passed_over_are_refused():
    with pytest.raises(ValueError, match="startAge"):
        filters.refuse_unused({"startAge": "20", "endAge": "30"}, extended=False)
    filters.refuse_unused({"startAge": "20", "endAge": "30"}, extended=True)
    filters.refuse_unused({"sex": "male"}, extended=False)
