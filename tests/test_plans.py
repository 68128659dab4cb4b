"""Plans: what reaches the scan of the log."""

import uuid
from contextlib import contextmanager

import pytest

from data import action, actions, rows, users
from sessionloom.operators import categories, filters, sampling, sessions
from sessionloom.sources.tables import write_log_days
from sessionloom.workspace import materialize

LARGE = {
    # As with a log of terabytes and ids beyond a broadcast.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
}


@contextmanager
def settings(spark, values):
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def optimized(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture
def log(spark, tmp_path):
    frame = actions(
        spark,
        *[action(f"s{k % 7}", f"2024-01-0{1 + k % 5} 0{k % 10}:00:00", user_id=k % 4, click_category_id=str(k % 3)) for k in range(60)],
    )
    frame.write.parquet(str(tmp_path / "log"))
    return spark.read.schema(frame.schema).parquet(str(tmp_path / "log"))


def test_large_id_sets_reach_the_scan_as_bloom_filters(spark, log):
    people = materialize(users(spark, (1, 20, "a", "x", "male"), (2, 30, "b", "y", "male"), (3, 30, "b", "y", "female")), "users")
    sample = materialize(sampling.sample_sessions(log, 0.1), "sample")
    top = materialize(categories.category_top_sessions(categories.category_session_ops(log), 1), "top")
    frames = {
        "users": lambda: filters.filter_actions(log, people, {"sex": "male"}),
        "sample": lambda: sampling.sampled_records(log, sample),
        "sampled members": lambda: sampling.top_sampled_records(log, sample),
        "sessions": lambda: categories.top_session_records(log, top),
    }
    expected = {name: rows(frame()) for name, frame in frames.items()}
    with settings(spark, LARGE):
        for name, frame in frames.items():
            assert "might_contain" in optimized(frame()), name
            assert rows(frame()) == expected[name], name


def test_kept_parts_answer_without_the_log(spark, log):
    parts = materialize(sessions.session_hours(log), "parts")
    ops = materialize(categories.category_session_ops(log), "ops")
    assert rows(sessions.statistics_of(parts)) == rows(sessions.session_statistics(log))
    assert rows(sampling.sample_of(parts, 0.1)) == rows(sampling.sample_sessions(log, 0.1))
    counts = categories.op_counts_of(ops)
    assert rows(counts) == rows(categories.category_op_counts(log))
    best = categories.top_categories(counts, 2)
    assert rows(categories.session_counts_of(ops, best)) == rows(categories.category_session_counts(log, best))


def test_a_day_table_is_read_by_its_days(spark, log):
    table = f"log_{uuid.uuid4().hex[:8]}"
    write_log_days(log, table)
    write_log_days(log.where("date = '2024-01-02'").limit(3), table)
    kept = spark.table(table)
    assert kept.where("date = '2024-01-02'").count() == 3
    assert kept.where("date <> '2024-01-02'").count() == log.where("date <> '2024-01-02'").count()
    some = filters.filter_actions(kept, None, {"startDate": "2024-01-03", "endDate": "2024-01-04"})
    assert all("date=2024-01-0" in f for f in some.inputFiles())
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    assert rows(some) == rows(filters.filter_actions(log, None, {"startDate": "2024-01-03", "endDate": "2024-01-04"}))
    # Dates that come from another table prune the scan while it runs.
    days = materialize(spark.createDataFrame([("2024-01-03", 7), ("2024-01-04", 8)], "date string, task_id int"), "days")
    joined = kept.join(days.where("task_id = 7"), "date")
    assert "dynamicpruning" in joined._jdf.queryExecution().executedPlan().toString()
    spark.sql(f"DROP TABLE {table}")
