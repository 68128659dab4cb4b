import uuid
from types import SimpleNamespace

import pytest

from data import action, actions, rows, users
from sessionloom import schemas
from sessionloom.sinks import files as file_sinks
from sessionloom.sinks import jdbc as jdbc_sinks
from sessionloom.sources import files as file_sources
from sessionloom.sources import jdbc as jdbc_sources
from sessionloom.sources import tables
from sessionloom.workspace import (
    exists,
    fresh_path,
    materialize,
    removing_tables,
    shared_folder,
    temporary_tables,
)


@pytest.fixture
def url():
    """A database inside this process, gone with it; no server is involved."""
    return f"jdbc:derby:memory:t{uuid.uuid4().hex};create=true"


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_wrong_number_of_fields_is_dropped(spark):
    frame = file_sources.parse_lines(
        lines(
            spark,
            "1,u,n,20,p,c",
            "2,u,n,20,p,c,male",
            "3,u,n,20,p,c,male,more",
            "4,u,n,20,p,c,male,,",
            "",
        ),
        schemas.USER_INFO,
        ",",
    )
    assert rows(frame, "user_id", "sex") == [(2, "male"), (4, "male")]
    assert frame.schema == schemas.USER_INFO


def test_bad_number_fails(spark):
    frame = file_sources.parse_lines(lines(spark, "x,u,n,20,p,c,male"), schemas.USER_INFO, ",")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        frame.collect()


def test_product_line_keeps_its_json(spark):
    frame = file_sources.parse_lines(
        lines(spark, '1^a, b^{"product_type":"1","x":[1,2]}'), schemas.PRODUCT_INFO, "^"
    )
    assert rows(frame) == [(1, "a, b", '{"product_type":"1","x":[1,2]}')]


def test_delimited_round_trips(spark, tmp_path):
    people = users(spark, (1, 20, "医生", "上海", "male"), (2, 30, "教师", "北京", "female"))
    path = str(tmp_path / "users")
    for _ in range(2):  # the second write replaces the first
        file_sinks.write_delimited(people, path)
    assert rows(file_sources.read_user_info(spark, path)) == rows(people)
    log = actions(spark, action("a", search_keyword="火锅"), action("b", pay_category_ids="1|2"))
    path = str(tmp_path / "log")
    file_sinks.write_delimited(log, path)
    assert rows(file_sources.read_user_visit_action(spark, path)) == rows(log)
    products = spark.createDataFrame([(1, "a", "{}")], schemas.PRODUCT_INFO)
    path = str(tmp_path / "products")
    file_sinks.write_delimited(products, path, "^")
    assert rows(file_sources.read_product_info(spark, path)) == rows(products)


def test_null_is_written_as_a_word(spark):
    frame = spark.createDataFrame([(1, None)], "a int, b string")
    assert rows(file_sinks.delimited_lines(frame)) == [("1,null",)]


def test_record_lines_leave_null_fields_out(spark):
    (line,) = file_sinks.record_lines(actions(spark, action(search_keyword=None))).first()
    assert '"search_keyword"' not in line and line.startswith('{"date":"2024-01-01","user_id":1,')


def test_views_and_catalog(spark):
    tables.register_views({"some_view": spark.range(3)})
    assert tables.read_table(spark, "some_view").count() == 3


TASKS = [
    (1, "t", "c", "s", "f", "session", "new", '{"sex":"male"}'),
    (2, "t", "c", "s", "f", "session", "new", "{}"),
]


def test_tasks(spark, url):
    jdbc_sinks.append_jdbc(spark.createDataFrame(TASKS, schemas.TASK), url, "tb_task")
    assert jdbc_sources.load_task_params(spark, url, 1) == {"sex": "male"}
    with pytest.raises(ValueError, match="empty parameters"):
        jdbc_sources.load_task_params(spark, url, 2)
    with pytest.raises(ValueError, match="no task with id 3"):
        jdbc_sources.load_task_params(spark, url, 3)
    plan = jdbc_sources.find_task(spark, url, 1)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(task_id,1)" in plan


def test_partitioned_jdbc_read(spark, url):
    jdbc_sinks.append_jdbc(spark.range(10).toDF("id"), url, "numbers")
    frame = jdbc_sources.read_jdbc(
        spark, url, "numbers", partition_column="id", bounds=(0, 10), num_partitions=3
    )
    assert frame.rdd.getNumPartitions() == 3 and frame.count() == 10
    with pytest.raises(ValueError):
        jdbc_sources.read_jdbc(spark, url, "numbers", partition_column="id")


def test_appends_add_up(spark, url):
    categories = spark.createDataFrame(
        [("a", 1, 2, 3)],
        "category_id string, click_count bigint, order_count bigint, pay_count bigint",
    )
    for task in (1, 2):
        jdbc_sinks.append_top_categories(categories, task, url)
    assert rows(jdbc_sources.read_jdbc(spark, url, jdbc_sinks.TOP_CATEGORY_TABLE)) == [
        (1, "a", 1, 2, 3), (2, "a", 1, 2, 3),
    ]


def results(spark, url, table):
    return rows(jdbc_sources.lower_case_columns(jdbc_sources.read_jdbc(spark, url, table)))


def categories_of(spark, *rows):
    return spark.createDataFrame(list(rows), "category_id string, click_count long, order_count long, pay_count long")


def test_a_task_written_again_replaces_its_rows(spark, url):
    first = categories_of(spark, ("1", 5, 0, 0), ("2", 4, 1, 0), ("2", 4, 1, 0))
    jdbc_sinks.append_top_categories(first, 7, url)
    jdbc_sinks.append_top_categories(categories_of(spark, ("9", 1, 1, 1)), 8, url)
    jdbc_sinks.append_top_categories(first, 7, url)
    expected = [(7, "1", 5, 0, 0), (7, "2", 4, 1, 0), (7, "2", 4, 1, 0), (8, "9", 1, 1, 1)]
    assert results(spark, url, jdbc_sinks.TOP_CATEGORY_TABLE) == expected
    jdbc_sinks.append_top_categories(first.limit(0), 7, url)
    assert results(spark, url, jdbc_sinks.TOP_CATEGORY_TABLE) == expected[3:]


def test_a_repeated_task_counts_once_and_a_failed_job_changes_nothing(spark, url, monkeypatch):
    jdbc_sinks.append_statistics(spark.createDataFrame([("old",)], "result_json string"), 7, url)
    append, fail = jdbc_sinks.append_jdbc, []

    def twice(df, url, table, *options):
        append(df, url, table, *options)
        if table != jdbc_sinks.STATISTICS_TABLE:  # the staging table: its tasks are run again after their commit
            append(df, url, table, *options)
            if fail:
                raise RuntimeError("executor lost")

    monkeypatch.setattr(jdbc_sinks, "append_jdbc", twice)
    fail.append(True)
    new = spark.createDataFrame([("new",)], "result_json string")
    with pytest.raises(RuntimeError):
        jdbc_sinks.append_statistics(new, 7, url)
    assert results(spark, url, jdbc_sinks.STATISTICS_TABLE) == [(7, "old")]
    fail.clear()
    jdbc_sinks.append_statistics(new, 7, url)
    assert results(spark, url, jdbc_sinks.STATISTICS_TABLE) == [(7, "new")]


def test_workspace(spark, tmp_path):
    frame = spark.createDataFrame([(1, "a")], "a int, b string")
    assert rows(materialize(frame, "small")) == [(1, "a")]
    assert fresh_path(spark, "x") != fresh_path(spark, "x")
    empty = materialize(frame.where("a > 1"), "empty")
    assert empty.columns == ["a", "b"] and empty.count() == 0


def test_temporary_tables_are_removed(spark):
    with pytest.raises(RuntimeError), temporary_tables(spark) as keep:
        kept = keep(spark.range(5).toDF("id"), "five")
        assert kept.count() == 5
        path = kept.inputFiles()[0].rsplit("/", 1)[0]
        raise RuntimeError
    assert not exists(spark, path)


def test_tables_of_a_scope_are_removed(spark):
    with removing_tables(spark) as made:
        first = materialize(spark.range(3).toDF("id"), "first")
        last = materialize(first, "last")
        gone, kept = made
        made.remove(kept)
    assert not exists(spark, gone) and last.count() == 3


def test_shared_folder():
    def session(master, **settings):
        settings["spark.master"] = master
        return SimpleNamespace(conf=SimpleNamespace(get=settings.get))

    named = {"spark.checkpoint.dir": "store://folder/"}
    assert shared_folder(session("yarn", **named)) == "store://folder/sessionloom"
    assert shared_folder(session("local[2]", **named)) == "store://folder/sessionloom"
    assert "sessionloom-" in shared_folder(session("local[2]"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session("yarn"))
