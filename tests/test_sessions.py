import json

from data import action, actions, rows
from sessionloom.operators import sessions


def test_session_across_hours(spark):
    log = actions(
        spark, action("a", "2024-01-01 08:59:00"), action("a", "2024-01-01 09:02:00")
    )
    assert rows(sessions.session_lengths(log)) == [("a", 180_000)]
    assert rows(sessions.session_hour_lengths(log)) == [
        ("2024-01-01", 8, "a", 0), ("2024-01-01", 9, "a", 0),
    ]
    assert rows(sessions.hour_invalid_count(log)) == [("2024-01-01", 8, 1), ("2024-01-01", 9, 1)]


def test_day_comes_from_the_action_time(spark):
    log = actions(spark, action("a", "2024-01-02 00:01:00", date="2024-01-01"))
    assert rows(sessions.hour_session_count(log)) == [("2024-01-02", 0, 1)]


def small_log(spark):
    return actions(
        spark,
        action("a", "2024-01-01 08:00:00"),
        action("a", "2024-01-01 08:00:07"),
        action("b", "2024-01-01 08:00:00"),
        action("c", "2024-01-01 23:59:59"),
        action("c", "2024-01-02 00:01:00"),
        action("c", "2024-01-02 00:01:02"),
    )


def test_totals_levels_and_hours(spark):
    log = small_log(spark)
    assert rows(sessions.session_totals(log)) == [(3, 70.0, 1)]
    assert rows(sessions.session_length_levels(log)) == [("A", 1), ("B", 1), ("E", 1)]
    assert rows(sessions.hour_session_length(log)) == [
        ("2024-01-01", 8, 7), ("2024-01-01", 23, 0), ("2024-01-02", 0, 2),
    ]
    assert rows(sessions.hour_invalid_count(log)) == [("2024-01-01", 8, 1), ("2024-01-01", 23, 1)]


def test_statistics_json(spark):
    (line,) = sessions.session_statistics(small_log(spark)).first()
    assert json.loads(line) == {
        "total_session_count": 3,
        "total_session_length": "70",
        "invalid_session_count": 1,
        "pre_session_type_of_count": [
            {"type": "A", "count": 1}, {"type": "B", "count": 1}, {"type": "E", "count": 1},
        ],
        "pre_hour_of_session_count": [
            {"day": "2024-01-01", "hour": 8, "count": 2},
            {"day": "2024-01-01", "hour": 23, "count": 1},
            {"day": "2024-01-02", "hour": 0, "count": 1},
        ],
        "pre_hour_of_session_length": [
            {"day": "2024-01-01", "hour": 8, "length": 7},
            {"day": "2024-01-01", "hour": 23, "length": 0},
            {"day": "2024-01-02", "hour": 0, "length": 2},
        ],
        "pre_hour_of_invalid_session_count": [
            {"day": "2024-01-01", "hour": 8, "invalid": 1},
            {"day": "2024-01-01", "hour": 23, "invalid": 1},
        ],
    }


def test_no_sessions(spark):
    log = actions(spark)
    assert rows(sessions.session_totals(log)) == [(0, 0.0, 0)]
    (line,) = sessions.session_statistics(log).first()
    assert json.loads(line)["total_session_length"] == "0"
    assert json.loads(line)["pre_session_type_of_count"] == []
    assert sessions.session_ratios(log).first()["step_length_1_3_ratio"] is None


def test_ratios(spark):
    log = actions(
        spark,
        *[action("a", f"2024-01-01 08:00:{s:02d}") for s in (0, 1, 3)],
        *[action("b", f"2024-01-01 08:00:{s:02d}") for s in (0, 1, 2, 4)],
        action("c", "2024-01-01 08:00:00"),
    )
    row = sessions.session_ratios(log).first().asDict()
    assert row["session_count"] == 3
    filled = {name: value for name, value in row.items() if value and name != "session_count"}
    assert filled == {
        "visit_length_1s_4s_ratio": 0.33,
        "visit_length_4s_7s_ratio": 0.33,
        "step_length_1_3_ratio": 0.67,
        "step_length_4_6_ratio": 0.33,
    }
    assert len(row) == 1 + 9 + 6


def test_statistics_scan_once(spark, tmp_path):
    small_log(spark).write.parquet(str(tmp_path / "log"))
    frame = sessions.session_statistics(spark.read.parquet(str(tmp_path / "log")))
    frame.collect()
    final = frame._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("FileScan") == 1 and final.count("ReusedExchange") == 1


def test_bucketed_log_is_not_shuffled_for_session_figures(spark):
    small_log(spark).write.bucketBy(4, "session_id").saveAsTable("bucketed_log")
    log = spark.table("bucketed_log")
    for frame in (sessions.session_lengths(log), sessions.session_hours(log)):
        assert "Exchange" not in frame._jdf.queryExecution().executedPlan().toString()
    assert rows(sessions.session_totals(log)) == [(3, 70.0, 1)]
    spark.sql("DROP TABLE bucketed_log")
