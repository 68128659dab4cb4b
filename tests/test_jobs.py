"""Both jobs from task lookup to result tables."""

import json
import uuid

import pytest

from data import action, actions, cities, rows, users
from sessionloom import schemas
from sessionloom.__main__ import main
from sessionloom.plans.sessions import analyze_sessions, run_session_job
from sessionloom.sinks import jdbc as jdbc_sinks
from sessionloom.sources import jdbc as jdbc_sources
from sessionloom.sources.tables import register_views


def log(spark):
    return actions(
        spark,
        action("a", "2024-01-01 08:00:00", user_id=1, click_category_id="3", click_product_id="7"),
        action("a", "2024-01-01 08:00:09", user_id=1, order_category_ids="3|4"),
        action("b", "2024-01-01 09:00:00", user_id=2, click_category_id="5", click_product_id="7"),
        action("c", "2024-01-01 09:00:00", user_id=3, click_category_id="3", click_product_id="8"),
    )


PEOPLE = [(1, 20, "医生", "上海", "male"), (2, 30, "教师", "北京", "female"), (3, 40, "教师", "", "male")]


def test_jobs(spark, tmp_path):
    url = f"jdbc:derby:memory:t{uuid.uuid4().hex};create=true"
    task = (1, "t", "c", "s", "f", "x", "new", '{"sex":"male","sessionRatio":"0.05"}')
    jdbc_sinks.append_jdbc(spark.createDataFrame([task], schemas.TASK), url, "tb_task")
    jdbc_sinks.append_jdbc(cities(spark), url, "city_info")
    register_views(
        {
            "user_visit_action": log(spark),
            "user_info": users(spark, *PEOPLE),
            "product_info": spark.createDataFrame(
                [(7, "seven", '{"product_type":"1"}'), (8, "eight", "")], schemas.PRODUCT_INFO
            ),
        }
    )

    def table(name):
        return jdbc_sources.lower_case_columns(jdbc_sources.read_jdbc(spark, url, name))

    run_session_job(spark, 1, url, str(tmp_path))
    (statistics,) = rows(table(jdbc_sinks.STATISTICS_TABLE), "result_json")
    assert json.loads(statistics[0])["total_session_count"] == 2
    assert rows(table(jdbc_sinks.TOP_CATEGORY_TABLE)) == [(1, "3", 2, 1, 0), (1, "4", 0, 1, 0)]
    samples = rows(table(jdbc_sinks.SAMPLE_SESSION_TABLE), "session_id", "day", "hour")
    assert samples == [("a", "2024-01-01", 8), ("c", "2024-01-01", 9)]
    assert table(jdbc_sinks.CATEGORY_SESSION_TABLE).count() == 2
    sample_lines = spark.read.text(str(tmp_path / "session_sample" / "task_1"))
    assert sample_lines.count() == 3
    details = spark.read.text(str(tmp_path / "top10_category_session" / "task_1"))
    assert details.count() == 3

    main(["products", "1", "--url", url])
    assert rows(table(jdbc_sinks.AREA_PRODUCT_TABLE), "product_id", "product_type") == [
        ("7", "第三方商品"), ("8", "未知商品"),
    ]


def test_lazy_analysis_gives_the_same_figures(spark):
    frames = analyze_sessions(log(spark), users(spark, *PEOPLE), {"sex": "male"})
    assert rows(frames["top_categories"]) == [("3", 2, 1, 0), ("4", 0, 1, 0)]
    assert frames["sample"].count() == 2
    assert frames["sample_records"].count() == 3
    assert frames["sample_documents"].count() == 2
    assert frames["category_sessions"].count() == 2
    assert frames["top_session_records"].count() == 3
    assert json.loads(frames["statistics"].first()[0])["invalid_session_count"] == 1


@pytest.mark.parametrize(
    "arguments, error",
    [
        (["sessions", "1", "--url", "jdbc:x"], SystemExit),  # no output folder
        (["other", "1", "--url", "jdbc:x"], SystemExit),
        (["products", "first", "--url", "jdbc:x"], ValueError),
    ],
)
def test_command_line_errors(arguments, error):
    with pytest.raises(error):
        main(arguments)
